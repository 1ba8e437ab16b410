"""SentencePiece encoding with the bytes of the source text that each piece stands for.

The text is normalised first, as the model's compiled character map says: at each place the longest
prefix that the map holds is replaced, and for every byte of the result the source byte it came from
is kept. Pieces follow one another over the normalised bytes, so their lengths give their places
there and the kept alignment gives their spans in the source.

A model in which no piece has a space mark after another character never joins over such a mark.
The text is then cut before each one, and the pieces of words seen before are taken from a table of
bounded size. Other models get whole texts.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words whose pieces are remembered in a task.
REMEMBERED = 200_000
#: Characters encoded together.
TOGETHER = 1 << 18


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + n]
            at += n


class CharacterMap:
    """The compiled map: a double array of byte transitions and the replacement strings."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at a byte, and what replaces it."""
        found = None
        node = 0
        unit = self.units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if (unit & 0x800000FF) != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if (unit >> 8) & 1:
                found = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]


class Normalizer:
    """Normalised bytes of a text and, for each of them and the end, its place in the source."""

    def __init__(self, model: bytes) -> None:
        # A message that comes more than once is merged, which its bytes in a row mean.
        spec = dict(_fields(b"".join(v for k, v in _fields(model) if k == 3)))
        trainer = dict(_fields(b"".join(v for k, v in _fields(model) if k == 2)))
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        self.suffix = bool(trainer.get(24, 0))
        self.plain = not self.map.units and not self.squeeze and self.escape and not self.suffix

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if self.plain:
            return self._plain(data)
        out, source = bytearray(), []
        mark = MARK.encode() if self.escape else b" "

        def put(chars: bytes, at: int) -> None:
            for c in chars.replace(b" ", mark):
                out.append(c)
                source.append(at)

        at, pieces = 0, []
        while at < len(data):
            hit = self.map.longest(data, at) if self.map.units else None
            if hit is None:
                n = 1
                while at + n < len(data) and data[at + n] & 0xC0 == 0x80:
                    n += 1
                hit = n, data[at : at + n]
            pieces.append((hit[1], at))
            at += hit[0]
        end = len(data)
        if self.squeeze:
            while pieces and not pieces[0][0].strip(b" "):
                pieces.pop(0)
            while pieces and not pieces[-1][0].strip(b" "):
                end = pieces.pop()[1]
        if not pieces:
            return b"", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            put(b" ", pieces[0][1])
        spaced = self.squeeze
        for chars, place in pieces:
            if self.squeeze:
                if spaced:
                    chars = chars.lstrip(b" ")
                if not chars:
                    continue
                chars = re.sub(rb" +", b" ", chars)
                spaced = chars.endswith(b" ")
            put(chars, place)
        if self.squeeze:
            while out.endswith(mark):
                end = source[-len(mark)]
                del out[-len(mark) :], source[-len(mark) :]
        if self.dummy and self.suffix:
            put(b" ", end)
        return bytes(out), np.array([*source, end], np.int64)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map or squeezing only spaces change, to a mark of three bytes."""
        if not data:
            return b"", np.zeros(1, np.int64)
        own = np.frombuffer(data, np.uint8)
        times = np.where(own == 32, 3, 1)
        source = np.r_[np.repeat(np.arange(len(own)), times), len(own)]
        out = data.replace(b" ", MARK.encode())
        if self.dummy:
            return MARK.encode() + out, np.r_[np.zeros(3, np.int64), source]
        return out, source


class Codec:
    """Encodes texts to ids with source spans, and decodes ids."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(model)
        ids = range(self.library.get_piece_size())
        pieces = [self.library.id_to_piece(i) for i in ids]
        self.lengths = np.array([1 if self.library.is_byte(i) else len(p.encode()) for i, p in zip(ids, pieces, strict=True)])
        #: Source bytes of a piece whose marks are single spaces there.
        self.sizes = self.lengths - 2 * np.array([0 if self.library.is_byte(i) else p.count(MARK) for i, p in zip(ids, pieces, strict=True)])
        self.names = [str(i) for i in ids]
        self.unknown = self.library.unk_id()
        inner = any(MARK in p.lstrip(MARK) for p in pieces)
        fallback = any(self.library.is_byte(i) for i in ids)
        self.by_word = self.normalizer.plain and self.normalizer.dummy and fallback and not inner
        self.remembered = remembered
        self.table: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of mark-led words. The library puts the first mark itself."""
        found = self.library.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1)
        # A lone mark is empty text to the library.
        lone = [self.library.piece_to_id(MARK)]
        found = [ids or lone for ids in found]
        every = np.fromiter(chain.from_iterable(found), np.int32).tobytes()
        table, at = self.table, 0
        for w, ids in zip(words, found, strict=True):
            end = at + 4 * len(ids)
            table[w] = every[at:end]
            at = end

    def encode(self, texts: list[str]) -> list[tuple[str, np.ndarray, bytes, np.ndarray]]:
        """For each text its ids in decimal with commas, the ids, the decoded bytes, and the spans: start and
        end byte in the source of each piece."""
        if not self.by_word:
            return [self._whole(t) for t in texts]
        # Each part is a run of marks with what follows up to the next one.
        parts = [re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.table) > self.remembered:
            self.table.clear()
        self._learn(list({p for own in parts for p in own if p not in self.table}))
        names, table = self.names, self.table
        coded = [np.frombuffer(b"".join([table[p] for p in own]), np.int32) for own in parts]
        listed = [ids.tolist() for ids in coded]
        out = []
        for t, ids, own, decoded in zip(texts, coded, listed, self.library.decode(listed, num_threads=1), strict=True):
            if MARK in t or not own:
                # Marks of the text itself have three bytes in the source, unlike spaces.
                spans = self.spans(t.encode(), own)
            else:
                size = self.sizes[ids]
                size[0] -= 1
                ends = np.cumsum(size)
                spans = np.stack([ends - size, ends], axis=1)
            out.append((",".join([names[i] for i in own]), ids, decoded.encode(), spans))
        return out

    def _whole(self, text: str) -> tuple[str, np.ndarray, bytes, np.ndarray]:
        ids = self.library.encode(text)
        return ",".join(map(str, ids)), np.array(ids, np.int32), self.library.decode(ids).encode(), self.spans(text.encode(), ids)

    def spans(self, data: bytes, ids: list[int]) -> np.ndarray:
        """Start and end byte in the source of each piece, of a text encoded as UTF-8, through the normaliser."""
        normal, source = self.normalizer(data)
        own = np.array(ids, np.int64)
        size = self.lengths[own] if len(own) else np.zeros(0, np.int64)
        if (own == self.unknown).any():
            size = self._with_unknown(normal, own, size)
        ends = np.cumsum(size)
        if len(normal) != (int(ends[-1]) if len(ends) else 0):
            raise ValueError("pieces do not cover the normalised text")
        first = source[ends - size]
        return np.stack([first, np.maximum(first, source[ends])], axis=1)

    def _with_unknown(self, normal: bytes, own: np.ndarray, size: np.ndarray) -> np.ndarray:
        """An unknown piece covers the characters up to where the next known one fits."""
        size, at = size.copy(), 0
        for i, x in enumerate(own.tolist()):
            if x == self.unknown:
                follow = self.library.id_to_piece(int(own[i + 1])).encode() if i + 1 < len(own) else b""
                end = normal.index(follow, at + 1) if follow else len(normal)
                size[i] = end - at
            at += int(size[i])
        return size


def encoded(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """All other columns of ``docs`` with ``n_tokens, n_covered, ids_sha256, decoded_sha256, spans_sha256`` and,
    if ``with_ids``, ``ids, starts, ends``: the pieces and the source bytes that each stands for.

    ``n_covered`` is the number of source bytes under the pieces, ``spans_sha256`` the digest of all
    starts and then all ends as 64-bit little-endian numbers. A null text is empty: no ids, and the
    digests of nothing. Columns of ``docs`` with a result's name give way to the result. ``path`` names a
    model file that the driver can read.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    results = ["n_tokens", "n_covered", "ids_sha256", "decoded_sha256", "spans_sha256", *["ids", "starts", "ends"][: 3 * with_ids]]
    names = [c for c in docs.columns if c != text and c not in results]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())][: 3 * with_ids]]

    def coded(codec: Codec, column: pa.Array) -> Iterator[tuple[str, np.ndarray, bytes, np.ndarray]]:
        waiting: list[str] = []
        size = 0
        for x in column:
            waiting.append(x.as_py())
            size += len(waiting[-1])
            if size >= TOGETHER:
                yield from codec.encode(waiting)
                waiting, size = [], 0
        yield from codec.encode(waiting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            for shown, ids, decoded, spans in coded(codec, batch.column(batch.num_columns - 1)):
                gone = np.maximum.accumulate(np.r_[0, spans[:-1, 1]]) if len(ids) else 0
                covered = int(np.maximum(0, spans[:, 1] - np.maximum(spans[:, 0], gone)).sum())
                places = np.ascontiguousarray(spans.T, np.int64)
                made = [len(ids), covered, sha(shown.encode()), sha(decoded), sha(places)]
                for c, v in zip(cols, [*made, ids, places[0], places[1]] if with_ids else made, strict=True):
                    c.append(v)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            made = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*batch.schema.names[:-1], *results])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.col(text), F.lit("")).alias("text"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    extra = ", ids array<int>, starts array<long>, ends array<long>" if with_ids else ""
    out = rows.mapInArrow(run, f"{kept}n_tokens long, n_covered long, ids_sha256 string, decoded_sha256 string, spans_sha256 string{extra}")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *results)
