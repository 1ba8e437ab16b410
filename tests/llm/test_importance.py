"""Importance draws against brute force: buckets, weights, scores and ranks."""

import collections
import hashlib
import math
import re
import string
import zlib

import pyarrow as pa
import pytest

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LINE = "A line that many documents share, with ÜBER and über in it"
TEXTS = [
    (1, None), (2, ""), (3, " .\n\n. "), (4, "one"), (5, LINE + "\n" + LINE + "\n\n" + LINE), (6, "x" * 700 + " y" * 40), (7, "long " * 9000 + "é" * 500),
    *[(10 + k, "\n".join([LINE, f"own words number {k} of {k % 7}", LINE, "quantum flux capacitor " * (k % 5)])) for k in range(60)],
    (None, LINE + "\n" + LINE), (12, "\n".join([LINE, "own words number 2 of 2", LINE, "quantum flux capacitor " * 2])), (12, "another text under one id " * 5),
]
TARGET = ["quantum flux capacitor in the lab", "flux\ncapacitor", None, ""]


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(f.encode()) % 10_000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def by_force(rows, target):
    s = collections.Counter(b for _, t in rows for b in features(t)[1])
    t = collections.Counter(b for x in target for b in features(x)[1])
    big_s, big_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000.0) / ((s[b] + 1.0) * (big_t + 10000.0))))
    out = []
    for i, text in rows:
        w, own = features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: len(able) * 25 // 100])}
    return collections.Counter((*r[:4], ranks.get(id(r))) for r in out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", 2) for i, t in rows], "doc_id long, text string, rank int, key string, score int")


def test_ranks(spark):
    from tallyloom.llm.importance import importance_ranks

    docs, target = frame(spark, TEXTS).repartition(3), spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = collections.Counter(map(tuple, importance_ranks(docs, target).drop("digest").collect()))
    assert got == by_force(TEXTS, TARGET)


def test_empty_tables_and_draws(spark):
    from tallyloom.llm.importance import importance_ranks, resampled

    docs, target = frame(spark, TEXTS), spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert importance_ranks(docs.limit(0), target).count() == 0
    assert collections.Counter(map(tuple, importance_ranks(docs, target.limit(0)).drop("digest").collect())) == by_force(TEXTS, [])
    drawn = resampled(docs, target)
    assert drawn.columns == docs.columns
    ids = {k[0] for k in by_force(TEXTS, TARGET) if k[4]}
    assert {r["doc_id"] for r in drawn.collect()} == ids


@pytest.mark.parametrize("most", [1 << 20, 50, 7])
def test_features_of_cut_texts(most):
    from tallyloom.llm.importance import Words, _lowered, pieces

    data, offsets = _lowered(pa.array([t for _, t in TEXTS if len(t or "") < 2000]))
    got = collections.defaultdict(list)
    for own, starts, row, again in pieces(data, offsets, most):
        words = Words(own, starts, 10_000)
        for r, b in [*zip(words.row[again:], words.single[again:], strict=True), *zip(words.row[words.led], words.double, strict=True)]:
            got[int(r) + row].append(int(b))
    assert [sorted(got[k]) for k in range(len(offsets) - 1)] == [sorted(features(t)[1]) for _, t in TEXTS if len(t or "") < 2000]
