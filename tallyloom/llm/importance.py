"""Documents drawn by importance towards a target, with n-gram counts taken over distinct lines.

Features are runs of one and two words in hashed buckets. Line ends cut texts into segments; equal
lines meet in one shuffle, the features of each are counted once and multiplied by how often the line
occurs. Pairs of words that stand on both sides of a line end are counted where texts are cut and
added to the rest.

What is sent to the driver are the gains of the buckets, whose number is fixed. Documents are weighed
in one pass over the texts, and ranks come from ranges of the sorted scores.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranges import running_total
from .common import id_key, stage, text_or_empty, utf8

BUCKETS = 10_000
#: Words that a document must have to be drawn, and the share of such documents that is.
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of text whose words are laid out together.
PIECE = 1 << 20
#: Bytes of a word that are hashed side by side with other words'.
ABREAST = 48

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The table of zlib's CRC-32, from its polynomial.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)
_ALL = np.uint32(0xFFFFFFFF)


def _advanced(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of one word each."""
    order = np.argsort(-sizes, kind="stable")
    at, state = starts[order], state[order]
    longer = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(ABREAST), "right")
    for j, k in enumerate(longer.tolist()):
        if not k:
            break
        state[:k] = _CRC[(state[:k] ^ data[at[:k] + j]) & 255] ^ (state[:k] >> 8)
    for i in range(int((sizes > ABREAST).sum())):
        rest = data[at[i] + ABREAST : at[i] + sizes[order[i]]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i] ^ _ALL)) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state
    return out


class Words:
    """The words of lower-cased texts laid end to end: bucket of each, of each with the next one, and rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int) -> None:
        letter = _LETTER[data]
        joined = np.r_[False, letter[:-1]] if len(data) else letter
        joined[offsets[:-1][offsets[:-1] < len(data)]] = False
        starts = np.flatnonzero(letter & ~joined)
        ends = np.flatnonzero(letter & ~np.r_[joined[1:] & letter[1:], False]) + 1 if len(data) else starts
        self.starts, self.ends = starts, ends
        self.row = np.searchsorted(offsets, starts, "right") - 1
        state = _advanced(np.full(len(starts), _ALL), data, starts, ends - starts)
        self.single = ((state ^ _ALL) % np.uint32(buckets)).astype(np.int64)
        #: Places of words that the next word of the same row follows.
        self.led = np.flatnonzero(self.row[:-1] == self.row[1:])
        spaced = _CRC[(state[self.led] ^ np.uint32(32)) & 255] ^ (state[self.led] >> 8)
        state = _advanced(spaced, data, starts[self.led + 1], (ends - starts)[self.led + 1])
        self.double = ((state ^ _ALL) % np.uint32(buckets)).astype(np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """Cut lower-cased texts into ``(bytes, offsets, first row, goes on)`` of about ``most`` bytes.

    A longer text is cut in front of a word, and each part after its first begins with the last
    word of the one before, which ``goes on`` says: that word was counted already.
    """
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        a, b = int(offsets[row]), int(offsets[last])
        if b - a <= most:
            yield data[a:b], offsets[row : last + 1] - a, row, False
        else:
            at, again = a, False
            while at < b:
                end = min(b, at + most)
                gap = None
                while end < b:
                    # The part ends behind the last separator at hand, or else behind the next one.
                    gaps = np.flatnonzero(~_LETTER[data[at:end]])
                    words = np.flatnonzero(_LETTER[data[at:end]])
                    if len(gaps) and len(words) and gaps[-1] > words[0] and (not again or _words_in(data[at : at + gaps[-1]]) > 1):
                        gap = at + int(gaps[-1])
                        break
                    end = min(b, end + most)
                stop = b if gap is None else gap
                yield data[at:stop], np.array([0, stop - at]), row, again
                if gap is None:
                    break
                letters = _LETTER[data[at:stop]]
                final = int(np.flatnonzero(letters)[-1])
                before = np.flatnonzero(~letters[:final])
                at, again = at + (int(before[-1]) + 1 if len(before) else 0), True
        row = last


def _words_in(data: np.ndarray) -> int:
    letter = _LETTER[data]
    return int(letter[:1].sum() + (letter[1:] & ~letter[:-1]).sum())


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    return np.frombuffer(data.tobytes().translate(_LOWER), np.uint8), offsets


def _bucket_rows(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])


def feature_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, piece: int = PIECE) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any.

    A null text is empty; empty tables give no rows. Texts are cut at line ends, and lines that
    are equal after A-Z became a-z are looked at once.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = np.zeros(buckets, np.int64)
        kinds = pa.schema([("line", pa.binary()), ("bucket", pa.int32()), ("n", pa.int64())])
        for batch in batches:
            data, offsets = _lowered(batch.column(0))
            lines: Counter[bytes] = Counter()
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                lines.update(data[a:b].tobytes().split(b"\n"))
            yield pa.RecordBatch.from_arrays([pa.array(lines.keys(), pa.binary()), pa.nulls(len(lines), pa.int32()), pa.array(lines.values(), pa.int64())], schema=kinds)
            for own, starts, _, _ in pieces(data, offsets, piece):
                ends = np.flatnonzero(own == 10)
                words = Words(own, starts, buckets)
                line = np.searchsorted(ends, words.starts)
                over = line[words.led] != line[words.led + 1]
                across += np.bincount(words.double[over], minlength=buckets)
        made = _bucket_rows(across)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(made), pa.binary()), made.column(0), made.column(1)], schema=kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            times = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            crossing = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            # Line ends became part of no line, so a pair of words of one row stands on one line.
            np.add.at(sums, batch.column(1).drop_null().to_numpy(zero_copy_only=False), times[crossing])
            data, offsets = utf8(batch.column(0).cast(pa.large_binary()).fill_null(b"").view(pa.large_string()))
            for own, starts, row, again in pieces(data, offsets, piece):
                words = Words(own, starts, buckets)
                n = times[row : row + len(starts) - 1]
                np.add.at(sums, words.single[again:], n[words.row[again:]])
                np.add.at(sums, words.double, n[words.row[words.led]])
        yield _bucket_rows(sums)

    rows = texts.select(text_or_empty(text).alias("text"))
    lines = rows.mapInArrow(cut, "line binary, bucket int, n long").groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    return lines.select("line", "bucket", "n").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: in thousandths, the log ratio of its smoothed share in the target to that
    in ``docs``. Only the sums of the buckets, at most one row each, come to the driver."""
    sums = []
    for texts in (docs, target):
        own = np.zeros(buckets, np.int64)
        for r in feature_counts(texts, buckets=buckets).collect():
            own[r["bucket"]] = r["n"]
        sums.append(own.astype(float))
    s, t = sums
    ratio = (t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets))
    return np.array([math.floor(1000.0 * math.log(x)) for x in ratio.tolist()], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, piece: int = PIECE) -> DataFrame:
    """``doc_id, digest, n_words, n_features, weight`` of each row: the floored mean of its features' gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            data, offsets = _lowered(batch.column(2))
            n_words, sums, double = (np.zeros(len(batch), np.int64) for _ in range(3))
            for own, starts, row, again in pieces(data, offsets, piece):
                words = Words(own, starts, len(gain))
                single, led = words.row[again:] + row, words.row[words.led] + row
                np.add.at(n_words, single, 1)
                np.add.at(double, led, 1)
                np.add.at(sums, single, gain[words.single[again:]])
                np.add.at(sums, led, gain[words.double])
            n = n_words + double
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words), pa.array(n), pa.array(weight)], names=["doc_id", "digest", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"doc_id {kind}, digest long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A document's own random number, in thousandths, from the digest of its id; a null id is the empty string."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_ranks(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """``doc_id, digest, n_features, weight, score, rank`` for each row of ``docs(doc_id, text, ...)``.

    Of the documents with ``least_words`` or more, ``percent`` in a hundred (rounded down) with the
    highest scores are drawn and ranked from 1; ties go to the smaller id, null last, then to fewer
    features. Null texts are empty: no features, weight 0. Rows that repeat are ranked each. Ids are
    whole numbers. Other columns are not looked at; ``digest`` tells texts of one id apart.
    """
    rows = weighed(docs, bucket_gains(docs, target, buckets)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # The serial number parts rows that repeat, so that equal rows can fall into several ranges.
    rows = stage(rows.withColumns({"key": id_key(), "serial": F.monotonically_increasing_id()}), "scores")
    able = F.col("n_words") >= least_words
    drawn = rows.filter(able).count() * percent // 100
    ranked = running_total(rows.filter(able).withColumns({"falling": -F.col("score"), "one": F.lit(1).cast("long")}), "one", "falling", ["key", "n_features", "serial"], out="place", total="all")
    names = ["doc_id", "digest", "n_features", "weight", "score"]
    ranked = ranked.select(*names, F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
    return ranked.union(rows.filter(~able).select(*names, F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """The drawn documents with all their columns. Where the draw ends among rows that repeat, all of them come."""
    ranks = importance_ranks(docs, target, percent, least_words, seed, buckets).filter("rank is not null")
    ranks = ranks.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("__row"), F.col("doc_id").alias("__own"), F.xxhash64("text").alias("__h"))
    kept = own.join(ranks, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__digest")), "left_semi")
    return kept.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
