"""Piece encoding against the library: remembered words, and a model with a compiled character map."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece


def model_with_map():
    """The public model with the library's own NFKC map, squeezing included, in its normaliser."""
    from tallyloom.llm.piece_codec import _fields

    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    mapped = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    spec = next(v for k, v in _fields(mapped) if k == 3)
    size, head = len(spec), bytearray([3 << 3 | 2])
    while size:
        head.append(size & 127 | (128 if size > 127 else 0))
        size >>= 7
    # The last one of a field that occurs twice is merged over the first.
    return model + bytes(head) + spec


WORDS = ["a", "the", "  ", "é", "Ａ①", "ﬀ", "\t", "\n", "▁", "日本", "ｶﾞ", "🙂", "x" * 30, ".", "é", "​", "<0x41>", "<s>", "�", "\x00"]


@pytest.mark.parametrize("mapped", [False, True])
def test_codec_equals_the_library(mapped):
    from tallyloom.llm.piece_codec import Codec

    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        model = model_with_map() if mapped else f.read()
    codec = Codec(model)
    assert codec.by_word != mapped and bool(codec.normalizer.map.units) == mapped
    tool = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(4)
    texts = ["", " ", "  ", "   a", "a  ", "▁", " ▁a", *["".join(rng.choice([w, w + " "]) for w in rng.choices(WORDS, k=rng.randrange(1, 25))) for _ in range(400)]]
    for text, (shown, ids, decoded, spans) in zip(texts, codec.encode(texts), strict=True):
        want = tool.encode(text)
        assert ids.tolist() == want and shown == ",".join(map(str, want)) and decoded.decode() == tool.decode(want), text
        assert np.array_equal(spans, codec.spans(text.encode(), want)), text
        normal, places = codec.normalizer(text.encode())
        assert normal.decode() == tool.normalize(text)
        assert len(places) == len(normal) + 1 and places[-1] <= len(text.encode())
        if not mapped:
            assert "".join(text.encode()[s:e].decode(errors="ignore") for s, e in spans) in (text, text.encode().decode()) or any(map(tool.is_byte, want))


def test_digest_of_spans_and_clashing_names(spark):
    from tallyloom.llm.piece_codec import encoded

    docs = spark.createDataFrame([(1, "two words", 5, "x"), (2, None, 6, "y")], "doc_id long, text string, n_tokens long, ids string")
    rows = encoded(docs, P.path("piece_bpe_32k.model"))
    assert rows.columns == ["doc_id", "n_tokens", "n_covered", "ids_sha256", "decoded_sha256", "spans_sha256", "ids", "starts", "ends"]
    for r in rows.collect():
        assert r["spans_sha256"] == hashlib.sha256(np.array([*r["starts"], *r["ends"]], "<i8").tobytes()).hexdigest()
        assert r["n_covered"] == (9 if r["doc_id"] == 1 else 0)
