"""A quality classifier: gradient-boosted trees over statistics of whole texts.

Features are cut into histogram bins by quantiles of a training sample. Trees grow level by level; a
level's gradient sums per node, feature and bin come from one pass of counts. A finished tree is three
arrays (feature, threshold, leaf value) in heap order, so scoring walks all rows of a batch down one
level at a time with numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Labelled rows that a model is trained on at most, those with the lowest hash of the id.
TRAIN_ROWS = 20_000
FEATURES = (
    "log_bytes", "log_words", "mean_word", "blank_share", "upper_share", "digit_share", "symbol_share", "pipe_share",
    "bang_share", "stop_share", "comma_share", "high_share", "entropy", "distinct_words", "top_word", "repeated_next",
    "distinct_lines", "words_per_line", "log_lines", "short_word_share", "capital_words", "longest_word", "pair_distinct",
)


def statistics(text: str) -> list[float]:
    """The features of one text, all finite; an empty text gives zeros."""
    data = text.encode()
    if not data:
        return [0.0] * len(FEATURES)
    bins = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    words = data.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = bins[bins > 0] / n
    sizes = list(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        sum(sizes) / w,
        float(bins[[9, 10, 11, 12, 13, 32]].sum()) / n,
        float(bins[65:91].sum()) / n,
        float(bins[48:58].sum()) / n,
        float(bins[[35, 36, 37, 38, 42, 60, 62]].sum()) / n,
        float(bins[124]) / n,
        float(bins[33]) / n,
        float(bins[46]) / n,
        float(bins[44]) / n,
        float(bins[128:].sum()) / n,
        float(-(share * np.log2(share)).sum()),
        len(seen) / w,
        max(seen.values(), default=0) / w,
        sum(map(bytes.__eq__, words[1:], words[:-1])) / w,
        len(set(lines)) / max(1, len(lines)),
        len(words) / max(1, len(lines)),
        float(np.log1p(len(lines))),
        sum(s <= 3 for s in sizes) / w,
        sum(map(bytes.isupper, words)) / w,
        float(np.log1p(max(sizes, default=0))),
        len(set(zip(words[1:], words[:-1]))) / w,
    ]


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold``: trees x inner nodes; ``leaf``: trees x leaves; ``start``: the
    score before any tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for f, t, v in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 1.0) -> Trees:
    """Trees for labels 0 and 1 by second-order boosting of the logistic loss.

    Without rows the score is 0.5, with one label it is near that label.
    """
    n, m = x.shape
    rate_of = (y.sum() + 0.5) / (n + 1.0)
    start = float(np.log(rate_of / (1 - rate_of)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    total = np.full(n, start)
    features, thresholds, values = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for k in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.full(width, 1e-9)
            at = node - first
            for j in range(m):
                cell = at * bins + binned[:, j]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins)
                gl, hl = gs.cumsum(1), hs.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                gain[:, len(edges[j]) :] = -1
                cut = gain.argmax(1)
                better = gain[np.arange(width), cut] > best
                best = np.where(better, gain[np.arange(width), cut], best)
                for i in np.flatnonzero(better):
                    features[k, first + i], thresholds[k, first + i] = j, edges[j][cut[i]]
            f, t = features[k, node], thresholds[k, node]
            node = 2 * node + 1 + (x[np.arange(n), f] > t)
        leaf = node - inner
        values[k] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + smooth)
        total += values[k][leaf]
    return Trees(features, thresholds, values, start)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned. A null id has no labels and is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """A model of ``label`` from the statistics of labelled texts outside the held-out third.

    Labels are sampled down to about ``train_rows`` by a hash of the id, which bounds both what is
    broadcast and what comes to the driver. An id with two different labels teaches nothing, and one
    with several rows teaches one of them, the text with the smallest digest.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("other"))
    known = known.filter("y = other").filter(~held_out())
    n = known.count()
    if n > train_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.lit(int((1 << 32) * train_rows / n)))
    chosen = known.select("doc_id", F.col("y").cast("double").alias("y"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = [statistics(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "y": frame["y"], "x": x})

    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "y", text_or_empty().alias("text"))
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.sha2("text", 256).alias("digest"), "text"))["text"].alias("text"))
    sample = rows.mapInPandas(run, "doc_id long, y double, x array<double>").toPandas().sort_values("doc_id")
    x = np.array(sample["x"].to_list(), float).reshape(len(sample), len(FEATURES))
    return fit_trees(x, sample["y"].to_numpy(float))


def scored(docs: DataFrame, model: Trees, keep_text: bool = False, prefix: str = "") -> DataFrame:
    """The columns of ``docs(doc_id, text, ...)``, the text only if kept, with ``held_out, score,
    predicted``, whose names begin with ``prefix``. A column of ``docs`` with one of these names gives way.
    Only the statistics of the whole text enter a score; a null text counts as empty."""
    feature, threshold, leaf, start = model.feature, model.threshold, model.leaf, model.start
    results = [prefix + c for c in ("held_out", "score", "predicted")]
    names = [c for c in docs.columns if (keep_text or c != "text") and c not in results]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(feature, threshold, leaf, start)
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(batch.num_columns - 1).to_pylist()], float).reshape(batch.num_rows, len(FEATURES))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(trees.scores(x))], names=[*batch.schema.names[:-1], "score"])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], text_or_empty().alias("text"))
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema[:-1]) + "score double"
    out = rows.mapInArrow(run, schema)
    held, score = held_out(f"c{names.index('doc_id')}"), F.col("score")
    made = [held.alias(results[0]), score.alias(results[1]), (score >= 0.5).cast("int").alias(results[2])]
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *made)
