"""Token counts of whole texts, encoded in batches of about equal bytes.

Arrow functions return lengths only. Long texts are cut before white space that follows other text:
no token of these vocabularies crosses such a place, so the parts' counts add up to the text's.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text encoded together, and of one part of a long text.
BATCH_CHARS = 1 << 18
PART_CHARS = 1 << 16
#: White-space runs from this length are encoded apart, as tiktoken's pattern matcher fails on very long ones.
RUN_CHARS = 100_000
#: The end of patterns that keep the last white character of a run for the text after it.
RUN_RULE = r"|\s+(?!\S)|\s+"

CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: White space as these patterns see it; Python's also holds the separators 1C to 1F.
RUNS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """Cut a text where a blank or line end follows a character that is no white space, about every ``most`` characters.

    A text without such a place stays whole.
    """
    at = 0
    while len(text) - at > most:
        found = CUT.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}


def rank_encoder(ranks: dict[bytes, int], pattern: str, special: dict[str, int] | None = None, run_chars: int = RUN_CHARS) -> Callable[[str], list[int]]:
    """A function from a text to its token ids; special strings count as their tokens.

    With patterns that end in ``RUN_RULE`` a white-space run is one piece, less its last character if
    other text follows. Runs of ``run_chars`` and more are merged as such a piece, past the matcher.
    """
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})
    names = tuple(special or ())

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        at = 0
        if len(text) >= run_chars and pattern.endswith(RUN_RULE):
            for run in RUNS.finditer(text):
                lo, hi = run.span()
                if hi - lo >= run_chars:
                    # A special string is taken out first, so a run before it ends like one at the text's end.
                    end = hi if hi == len(text) or text.startswith(names, hi) else hi - 1
                    ids += own.encode(text[at:lo], allowed_special="all")
                    ids += own._encode_single_piece(text[lo:end])
                    at = end
        return ids + own.encode(text[at:], allowed_special="all")

    return encode


def encoder(vocabulary: bytes, kind: str, pattern: str | None = None, special: dict[str, int] | None = None) -> Callable[[list[str]], list[int]]:
    """A function from texts to numbers of tokens.

    ``kind`` is ``ranks`` (byte-level BPE as base64 ranks, with the split pattern and special tokens),
    ``json`` for the tokenizers library or ``model`` for sentencepiece.
    """
    if kind == "ranks":
        encode = rank_encoder(ranks_of(vocabulary), pattern, special)
        return lambda texts: [len(encode(t)) for t in texts]
    if kind == "json":
        from tokenizers import Tokenizer

        tool = Tokenizer.from_str(vocabulary.decode())
        tool.no_truncation()
        tool.no_padding()
        return lambda texts: [len(x) for x in tool.encode_batch_fast(texts, add_special_tokens=False)]
    if kind == "model":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        return lambda texts: [len(pieces.encode(t)) for t in texts]
    raise ValueError(f"unknown vocabulary kind {kind}")


def token_counts(
    docs: DataFrame,
    path: str,
    pattern: str | None = None,
    special: dict[str, int] | None = None,
    text: str = "text",
    limit: int = 512,
    batch_chars: int = BATCH_CHARS,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """All other columns of ``docs`` with ``n_bytes, n_tokens, over_limit`` in place of the text.

    ``path`` names a ``.json``, ``.model`` or ``.tiktoken`` file that the driver can read; its bytes
    go to the executors. The text's special strings count as the library counts them by default. A
    null text is empty and has no tokens. sentencepiece sees whole texts, as it marks their starts.
    """
    kind = {"json": "json", "model": "model", "tiktoken": "ranks"}[path.rsplit(".", 1)[-1]]
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        count = encoder(shared.value, kind, pattern, special)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sums = [0] * len(texts)
            waiting: list[str] = []
            owners: list[int] = []
            size = 0

            def flush() -> None:
                for i, n in zip(owners, count(waiting), strict=True):
                    sums[i] += n
                waiting.clear()
                owners.clear()

            for i, x in enumerate(texts):
                for part in [x.as_py()] if kind == "model" else parts_of(x.as_py(), part_chars):
                    waiting.append(part)
                    owners.append(i)
                    size += len(part)
                    if size >= batch_chars:
                        flush()
                        size = 0
            flush()
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sums, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1]) + ", n_tokens long"
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
