"""Context-triggered piecewise hashing: fingerprints that stay alike where texts stay alike.

A rolling hash over the last seven bytes ends a chunk wherever it meets a trigger, so chunk borders
depend on nearby bytes only and survive edits elsewhere. Each chunk leaves one character, and the
characters in order are the signature. The trigger's rarity is the block size. A fingerprint holds two
signatures, at a block size that suits the length and at twice that, so that texts of up to about four
times the length can be compared: signatures of equal block size are likened by edit distance. The block
size grows while it has more triggers than digits. Where the same few bytes make nearly all triggers, no
block size suits; then every second, fourth, ... of them ends a chunk. So the digits cover the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, id_back, id_key, mixed, stage, text_or_empty, utf8

#: Characters of a chunk's digit. The base64 alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW = 7
LEAST_BLOCK = 2
#: Chunks that a signature has at most.
CHUNKS = 64
#: Signatures count as alike only if they share this many characters in a row.
COMMON = 3
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; shorter texts are put together up to it.
PIECE = 1 << 17


def _letters() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _levels(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each byte the trailing zeros of the rolling hash of the last seven bytes of its text: the
    power of two up to which block sizes it is a trigger. ``place`` counts from the text's start."""
    letters = _letters()[data]
    out = letters.copy()
    for k in range(1, WINDOW):
        out[k:] += np.where(place[k:] >= k, letters[:-k] * np.uint64(pow(_BASE, k, 1 << 64)), np.uint64(0))
    out = mixed(out)
    return np.bitwise_count((out & (~out + np.uint64(1))) - np.uint64(1))


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square), out)
        square = square * square % (1 << 64)
        left = left >> np.uint64(1)
    return out


def _digits(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One character per chunk, as bytes; chunks follow one another and stop at ``ends``."""
    starts = np.r_[0, ends[:-1]]
    sums = np.zeros(len(ends), np.uint64)
    letters = _letters()
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(min(PIECE, len(data)) - 1, _BASE, np.uint64)])
    for lo in range(0, len(data), PIECE):
        part = data[lo : lo + PIECE]
        run = np.r_[np.uint64(0), np.cumsum(letters[part] * (power[: len(part)] * np.uint64(pow(_BASE, lo, 1 << 64))))]
        own = slice(int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(starts, lo + len(part))))
        a, b = (np.clip(x[own] - lo, 0, len(part)) for x in (starts, ends))
        sums[own] += run[b] - run[a]
    # The sum of a chunk moved to its own start.
    digit = mixed(sums * _power(_INVERSE, starts) + (ends - starts).astype(np.uint64)) >> np.uint64(58)
    return np.frombuffer(ALPHABET.encode(), np.uint8)[digit.astype(np.int64)]


def _signatures(data: np.ndarray, stops: np.ndarray, of: np.ndarray, level: np.ndarray, at: np.ndarray, least: np.ndarray, every: np.ndarray) -> list[str]:
    """Signatures of texts that end at ``stops``. ``at`` are places just after a trigger, with their
    text ``of`` and ``level``; of those of the text's ``least`` level one in ``every`` counts."""
    met = level >= least[of]
    ends, own = at[met], of[met]
    first = np.searchsorted(own, np.arange(len(stops)))
    ends = np.union1d(ends[(np.arange(1, len(ends) + 1) - first[own]) % every[own] == 0], stops)
    shown = _digits(data, ends).tobytes().decode()
    cuts = np.searchsorted(ends, stops, "right").tolist()
    return [shown[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def _together(texts: list[np.ndarray]) -> list[str]:
    data, size = np.concatenate(texts), np.array([len(x) for x in texts], np.int64)
    stops = np.cumsum(size)
    at, of, level = [], [], []
    for lo in range(0, len(data), PIECE):
        back = max(0, lo - WINDOW + 1)
        place = np.arange(back, min(len(data), lo + PIECE))
        text = np.searchsorted(stops, place, "right")
        own = _levels(data[back : lo + PIECE], place - (stops - size)[text])[lo - back :]
        # Odd hashes are triggers of no block size.
        hit = np.flatnonzero(own > 0)
        at.append(hit + lo + 1)
        of.append(text[lo - back :][hit])
        level.append(own[hit])
    at, of, level = np.concatenate(at), np.concatenate(of), np.concatenate(level)
    # A trigger stays one at every smaller block size.
    met = np.bincount(of * 66 + level, minlength=66 * len(texts)).reshape(-1, 66)[:, ::-1].cumsum(axis=1)[:, ::-1]
    least_level = LEAST_BLOCK.bit_length() - 1
    least = np.array([max(least_level, (-(-n // CHUNKS) - 1).bit_length()) for n in size.tolist()])
    while (low := (least > least_level) & (met[np.arange(len(texts)), least] < CHUNKS // 2)).any():
        least = least - low
    # Repetitive texts can have more triggers than digits. No hash has a level of 65, so this ends.
    while (high := met[np.arange(len(texts)), least] >= CHUNKS).any():
        least = least + high
    before = met[np.arange(len(texts)), least - 1]
    thinned = (least > least_level) & (met[np.arange(len(texts)), least] < CHUNKS // 4) & (before >= CHUNKS)
    least = least - thinned
    every = np.array([1 << (n // CHUNKS).bit_length() if t else 1 for n, t in zip(before.tolist(), thinned, strict=True)])
    first = _signatures(data, stops, of, level, at, least, every)
    second = _signatures(data, stops, of, level, at, least + ~thinned, every * (1 + thinned))
    return [f"{m << e}:{x}:{y}" for e, m, x, y in zip(least.tolist(), every.tolist(), first, second, strict=True)]


def fingerprints(texts: list[np.ndarray]) -> list[str]:
    """``block:signature:signature at twice the block`` of each text's bytes; ``1::`` of an empty one."""
    out = ["1::"] * len(texts)
    waiting: list[int] = []
    size = 0
    for i, x in enumerate([*texts, None]):
        if waiting and (x is None or size + len(x) > PIECE):
            for j, f in zip(waiting, _together([texts[j] for j in waiting]), strict=True):
                out[j] = f
            waiting, size = [], 0
        if x is not None and len(x):
            waiting.append(i)
            size += len(x)
    return out


def fingerprint(data: np.ndarray) -> str:
    return fingerprints([data])[0]


def _codes(signatures: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in signatures], np.int64)
    out = np.zeros((len(signatures), max(1, int(size.max()) if len(size) else 1)), np.uint8)
    for i, s in enumerate(signatures):
        out[i, : len(s)] = np.frombuffer(s.encode(), np.uint8)
    return out, size


def signature_likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 less the edit distance over the joint length, for each pair; inserting and deleting cost 1,
    replacing 2. Pairs without ``COMMON`` characters in a row in common are 0, unless equal."""
    (a, la), (b, lb) = _codes(left), _codes(right)
    m, n, rows = a.shape[1], b.shape[1], len(left)
    # Cells of one anti-diagonal depend on the two before it only.
    big = np.int16(m + n + 5)
    two, one = np.full((rows, m + 1), big, np.int16), np.full((rows, m + 1), big, np.int16)
    run_two = np.zeros((rows, m + 1), np.int16)
    run_one = np.zeros((rows, m + 1), np.int16)
    longest = np.zeros(rows, np.int16)
    distance = np.zeros(rows, np.int64)
    for d in range(m + n + 1):
        now, run = np.full((rows, m + 1), big, np.int16), np.zeros((rows, m + 1), np.int16)
        lo, hi = max(0, d - n), min(m, d)
        i = np.arange(lo, hi + 1)
        if lo == 0:
            now[:, 0] = d
        if d <= m:
            now[:, d] = d
        inner = i[(i > 0) & (d - i > 0)]
        if len(inner):
            s = slice(int(inner[0]), int(inner[-1]) + 1)
            p = slice(s.start - 1, s.stop - 1)
            j = d - inner
            same = a[:, p] == b[:, j - 1]
            now[:, s] = np.minimum(np.minimum(one[:, p], one[:, s]) + 1, two[:, p] + np.where(same, 0, 2).astype(np.int16))
            run[:, s] = np.where(same, run_two[:, p] + 1, 0)
            inside = (inner[None, :] <= la[:, None]) & (j[None, :] <= lb[:, None])
            longest = np.maximum(longest, np.where(inside, run[:, s], 0).max(axis=1))
        done = np.flatnonzero(la + lb == d)
        distance[done] = now[done, la[done]]
        two, one, run_two, run_one = one, now, run_one, run
    joint = la + lb
    like = np.where(joint > 0, 1 - distance / np.maximum(joint, 1), 1.0)
    equal = np.array([x == y for x, y in zip(left, right, strict=True)], bool)
    return np.where(equal, 1.0, np.where(longest >= COMMON, like, 0.0))


def likeness(left: list[str], right: list[str], together: int = 2048) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: the larger likeness of signatures of equal block size,
    0 where there are none. Equal fingerprints are 1."""
    out = np.zeros(len(left))
    for lo in range(0, len(left), together):
        pairs: list[tuple[int, str, str]] = []
        for i, (x, y) in enumerate(zip(left[lo : lo + together], right[lo : lo + together], strict=True), lo):
            if x == y:
                out[i] = 1.0
                continue
            (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
            own = {int(bx): x1, 2 * int(bx): x2}
            for b, s in ((int(by), y1), (2 * int(by), y2)):
                if b in own and own[b] and s:
                    pairs.append((i, own[b], s))
        if pairs:
            at = np.array([p[0] for p in pairs])
            np.maximum.at(out, at, signature_likeness([p[1] for p in pairs], [p[2] for p in pairs]))
    return out


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_likeness(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text of a document is its own with the last half of its characters replaced by as
    many first ones of the next document by id (or all it has); the last document's next is the
    first. Rows with equal ids follow one another by a hash of the text, null ids come last, a null
    text is empty. A table of one row is followed by itself.

    Ids and hashes alone are sorted first, which gives each row its next row. Texts are then shuffled
    once, by blocks of that order, and the first row of a block is also sent to the block before it.
    """
    base = docs.select(id_key().alias("key"), text_or_empty().alias("text")).withColumn("h", F.xxhash64("text"))
    blocks = block_count(base, F.octet_length("text"))
    ids = base.select("key", "h").repartitionByRange(blocks, "key", "h").withColumn("block", F.spark_partition_id())
    firsts = stage(ids.groupBy("block").agg(F.min(F.struct("key", "h")).alias("low")), "block-starts")
    lows = [(r["low"]["key"], r["low"]["h"]) for r in firsts.orderBy("low").collect()]
    if not lows:
        return docs.sparkSession.createDataFrame([], RESULT)
    n = len(lows)
    low_keys, low_hashes = np.array([x[0] for x in lows], np.int64), np.array([x[1] for x in lows], np.int64)

    def place(batches):
        """Block of each row, and for a block's first rows once more the block before."""
        for batch in batches:
            key, h = (np.array(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("key", "h"))
            lo, hi = np.searchsorted(low_keys, key, "left"), np.searchsorted(low_keys, key, "right")
            block = hi - 1
            for i in np.flatnonzero(hi - lo > 0):
                # Blocks that start within one id are told apart by the hash.
                block[i] = lo[i] - 1 + np.searchsorted(low_hashes[lo[i] : hi[i]], h[i], "right")
            opens = np.flatnonzero((low_keys[block] == key) & (low_hashes[block] == h))
            for rows, where, guest in ((None, block, False), (opens, (block[opens] - 1) % n, True)):
                part = batch if rows is None else batch.take(pa.array(rows))
                if part.num_rows:
                    more = [pa.array(where, pa.int32()), pa.array(np.full(part.num_rows, guest))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "block", "guest"])

    def likened(key: tuple, table: pa.Table) -> pa.Table:
        import hashlib

        keys, hs, guest = (table[c].to_pylist() for c in ("key", "h", "guest"))
        own = sorted((i for i in range(len(keys)) if not guest[i]), key=lambda i: (keys[i], hs[i]))
        # Rows that repeat a block's first row are all sent; any of them is the next one.
        after = min((i for i in range(len(keys)) if guest[i]), key=lambda i: (keys[i], hs[i]))
        texts, offsets = utf8(table["text"])
        order = [*own, after]
        bytes_of = [texts[offsets[i] : offsets[i + 1]] for i in order]
        text_of = [x.tobytes().decode() for x in bytes_of]
        edited = []
        for x, y in zip(text_of[:-1], text_of[1:], strict=True):
            half = len(x) // 2
            edited.append((x[: len(x) - half] + y[:half]).encode())
        digests = [hashlib.sha256(x).hexdigest() for x in edited]
        prints, edited = fingerprints(bytes_of), fingerprints([np.frombuffer(x, np.uint8) for x in edited])
        cols = [[keys[i] for i in own], [len(x) for x in text_of[:-1]], digests, prints[:-1], edited, likeness(prints[:-1], edited), likeness(prints[:-1], prints[1:])]
        return pa.table(cols, names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    sent = base.select("key", "h", "text").mapInArrow(place, "key long, h long, text string, block int, guest boolean")
    out = sent.groupBy("block").applyInArrow(likened, RESULT.replace("doc_id", "key"))
    return out.select(id_back("key").alias("doc_id"), *out.columns[1:])
