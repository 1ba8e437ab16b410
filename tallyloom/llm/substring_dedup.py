"""Removal of byte strings that a document with a smaller id holds too, by a column-wise construction
of the collection's Burrows-Wheeler transform and common prefixes.

A repeated string of ``width`` bytes can start at any byte. To bring its copies together, each window
of that width is named by its minimizer: the k-gram in it with the lowest hash, the first of equals.
Equal windows have the same minimizer at the same place. Windows of one minimizer occurrence follow
one another and are carried together as a segment. Segments whose minimizer occurs once in the corpus
hold no repeat and stay where they are; the rest are sent to the task of their minimizer's hash. Later
copies of a whole text take no part: all they hold, their first one holds too.

A task lines its segments up at the minimizer, so that equal windows start in the same column, and
writes them column by column to an external file. It reads that file from the last column to the
first: each round puts one symbol in front of every segment's suffix, which reorders the suffixes
stably by that symbol and yields the transform's column, and updates the common prefix length of
neighbours by a range minimum. Runs of neighbours that share ``width`` symbols are the equal windows;
their smallest document id goes back to where they came from. Memory holds one column, the order and
the lengths.

A minimizer in more than ``often`` places (a passage that many documents share, with as many different
surroundings) has its windows sent one by one, spread by their bytes and each once per block.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    HASHES,
    NO_ID,
    block_count,
    copies_of,
    hash_classes,
    hash_rows,
    id_back,
    id_key,
    joined_codes,
    mixed,
    text_or_empty,
    utf8,
)

GRAM = 20
#: Bytes of text in a block; its arrays take some fifty times as much in a worker.
BLOCK = 2 << 20
#: Window starts looked at together; the minimizer's place must fit 24 bits.
PIECE = 1 << 18
#: Places of a minimizer above which its windows go one by one.
OFTEN = 4096
ABSENT = 256
SEGMENTS = "block int, bucket int, n binary, at binary, key binary, body binary"


def minimizers(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Segments of the windows of all texts: text, first start, number of starts, place of the
    minimizer after the first start, and its hash."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    starts = max(0, len(data) - width + 1)
    valid = np.ones(starts, bool)
    for end in offsets[1:].tolist():
        valid[max(0, end - width + 1) : end] = False
    if len(offsets) > 1 and offsets[-1] == len(data) and starts:
        valid[max(0, len(data) - width + 1) :] = False
    base = 0x9E3779B97F4A7C15
    powers = {k: np.uint64(pow(base, k, 1 << 64)) for k in (1, 2, 4, 8, GRAM - 16)}
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * powers[1])
    for lo in range(0, starts, PIECE):
        hi = min(lo + PIECE, starts)
        ok = valid[lo:hi]
        if not ok.any():
            continue
        # Hashes of grams of 1, 2, 4, 8 and 16 bytes, then of 20.
        g = letters[data[lo : hi + width - 1]]
        length, four = 1, None
        while length < 16:
            g = g[:-length] * powers[length] + g[length:]
            length *= 2
            four = g if length == 4 else four
        rest = GRAM - 16
        g = g[:-rest] * powers[rest] + four[16 : 16 + len(g) - rest]
        g = mixed(g)
        low = (g & ~np.uint64(0xFFFFFF)) | np.arange(len(g), dtype=np.uint64)
        span, length = width - GRAM + 1, 1
        while 2 * length <= span:
            low = np.minimum(low[:-length], low[length:])
            length *= 2
        low = np.minimum(low[: hi - lo], low[span - length : span - length + hi - lo])
        place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        first = ok.copy()
        first[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
        a = np.flatnonzero(first)
        ends = ok.copy()
        ends[:-1] &= first[1:] | ~ok[1:]
        n = np.flatnonzero(ends) - a + 1
        for c, v in zip(out, (a + lo, n, place[a] - a, g[place[a]]), strict=True):
            c.append(v)
    if not out[0]:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    a, n, at, f = (np.concatenate(x) for x in out)
    return np.searchsorted(offsets, a, "right") - 1, a, n, at, f


def range_minimum(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of ``values[lo..hi]`` for each pair, by a table of minima of doubling ranges."""
    table, step = [values], 1
    longest = int((hi - lo).max()) + 1 if len(lo) else 1
    while 2 * step <= longest:
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        step *= 2
    level = np.zeros(len(lo), np.int64)
    size = hi - lo + 1
    for k in range(1, len(table)):
        level += size >= (1 << k)
    out = np.empty(len(lo), values.dtype)
    for k, row in enumerate(table):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(row[lo[own]], row[hi[own] - (1 << k) + 1])
    return out


def smallest_owner(n: np.ndarray, at: np.ndarray, key: np.ndarray, body: np.ndarray, width: int) -> np.ndarray:
    """For each window of the segments, in order, the smallest key of a segment that holds the same
    bytes at the same distance from its minimizer."""
    m = len(n)
    size = n + width - 1
    body_at = np.r_[0, np.cumsum(size)]
    out_at = np.r_[0, np.cumsum(n)]
    out = np.repeat(key, n)
    if m < 2:
        return out
    left, right = -int(at.max()), int((size - at).max())
    with tempfile.TemporaryFile() as columns:
        # Column-major, some columns at a time.
        for c0 in range(left, right, 16):
            cs = np.arange(c0, min(c0 + 16, right))
            place = cs[:, None] + at[None, :]
            inside = (place >= 0) & (place < size[None, :])
            symbols = np.full(place.shape, ABSENT, np.uint16)
            symbols[inside] = body[(place + body_at[:-1][None, :])[inside]]
            columns.write(symbols.tobytes())
        order = np.arange(m)
        common = np.zeros(m, np.uint8)
        for c in range(right - 1, left - 1, -1):
            columns.seek((c - left) * m * 2)
            symbol = np.frombuffer(columns.read(m * 2), np.uint16)[order]
            turn = np.argsort(symbol, kind="stable")
            # The transform's column, in the order of the suffixes that it extends.
            column = symbol[turn]
            new = np.zeros(m, np.uint8)
            same = np.flatnonzero((column[1:] == column[:-1]) & (column[1:] != ABSENT)) + 1
            if len(same):
                new[same] = np.minimum(range_minimum(common, turn[same - 1] + 1, turn[same]), width - 1) + 1
            order, common = order[turn], new
            equal = common >= width
            if equal.any():
                run = np.flatnonzero(~equal)
                least = np.minimum.reduceat(key[order], run)
                lengths = np.diff(np.r_[run, m])
                hit = np.repeat(lengths > 1, lengths)
                who = order[hit]
                out[out_at[who] + at[who] + c] = np.repeat(least, lengths)[hit]
    return out


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def _unpack(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), kind)


def remove_repeats(docs: DataFrame, width: int = 50, often: int = OFTEN, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)`` with what is left of its text.

    Columns: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept`` and the columns named
    in ``keep``. ``spans`` lists the removed runs as (start, end) in bytes, ``kept`` is the remaining
    bytes as text, without characters that a cut has broken. A byte goes if a string of ``width``
    bytes over it also starts in a document with a smaller id; equal ids are the same document. A
    null text is empty; a null id comes after all others.
    """
    if width < GRAM + 12:
        raise ValueError(f"width must be {GRAM + 12} at least")
    base = docs.select(id_key().alias("key"), text_or_empty().alias("text"), *[F.col(f"`{c}`").alias(f"rest_{i}") for i, c in enumerate(keep)])
    blocks = buckets = block_count(base, F.octet_length("text"), BLOCK)
    base = base.withColumn("h", F.sha2("text", 256))
    base = base.withColumn("block", F.pmod(F.xxhash64("key", "h"), F.lit(blocks)).cast("int"))
    rest = [f"rest_{i}" for i in range(len(keep))]
    grouped = base.select("block", "key", "h", "text", *rest).groupBy("block")
    _, copies = copies_of(base)

    def originals(table: pa.Table, side: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Table]:
        """The block in a fixed order, which rows are no copies of a smaller id's text, and those rows.

        Rows arrive in any order, but each pass over a block must cut it into the same segments."""
        table = table.sort_by([("key", "ascending"), ("h", "ascending")])
        later = {x for x in zip(side["key"].to_pylist(), side["h"].to_pylist(), strict=True) if x[1] is not None}
        own = np.array([x not in later for x in zip(table["key"].to_pylist(), table["h"].to_pylist(), strict=True)], bool)
        return table, own, table.filter(pa.array(own))

    def named(table: pa.Table) -> tuple:
        data, offsets = utf8(table["text"])
        key = np.array(table["key"].to_pylist(), np.int64)
        return data, offsets, key, minimizers(data, offsets, width)

    def count(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        _, _, keys, (doc, _, _, _, f) = named(originals(table, side)[2])
        own = keys[doc]
        order = np.lexsort((own, f))
        own, f = own[order], f[order]
        new = np.r_[True, f[1:] != f[:-1]] if len(f) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        other = new | np.r_[True, own[1:] != own[:-1]] if len(f) else new
        counts = np.add.reduceat(other.astype(np.int64), first) if len(f) else np.zeros(0, np.int64)
        return hash_rows(key[0].as_py(), f[first], counts, buckets)

    def repeats(table: pa.Table, side: pa.Table) -> tuple:
        """The block's distinct segments by bucket, and which of them each segment of a text is."""
        data, offsets, keys, (doc, a, n, at, f) = named(table)
        side = side.filter(pc.is_valid(side["codes"]))
        codes = joined_codes(side["bucket"].to_pylist(), side["codes"].to_pylist())
        seen = codes[np.unique(f, return_inverse=True)[1]]
        hot = np.flatnonzero(seen == 2)
        cold = np.flatnonzero(seen == 1)
        single = np.repeat(hot, n[hot])
        step = np.arange(len(single)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
        which = np.r_[cold, single]
        a = np.r_[a[cold], a[single] + step]
        n = np.r_[n[cold], np.ones(len(single), np.int64)]
        at = np.r_[at[cold], at[single] - step]
        bucket = ((f[which] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        raw = data.tobytes()
        owner = keys[doc[which]]
        names: dict[tuple, int] = {}
        mine = np.empty(len(a), np.int64)
        least: list[int] = []
        for i, (s, k, o, b, w) in enumerate(zip(a.tolist(), n.tolist(), at.tolist(), bucket.tolist(), owner.tolist(), strict=True)):
            body = raw[s : s + k + width - 1]
            if i >= len(cold):
                b = int.from_bytes(hashlib.blake2b(body, digest_size=4).digest(), "little") * buckets >> 32
            x = names.setdefault((b, body, o), len(names))
            if x == len(least):
                least.append(w)
            elif w < least[x]:
                least[x] = w
            mine[i] = x
        rank = sorted(names)
        new = np.empty(len(names), np.int64)
        new[[names[x] for x in rank]] = np.arange(len(rank))
        least_of = np.array(least, np.int64)
        ordered = np.empty(len(least), np.int64)
        ordered[new] = least_of
        return rank, ordered, new[mine] if len(mine) else mine, doc[which], a, n, keys, data, offsets

    def segments(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        rank, least, *_ = repeats(originals(table, side)[2], side)
        cols: list[list] = [[] for _ in range(6)]
        lo = 0
        while lo < len(rank):
            hi = lo
            while hi < len(rank) and rank[hi][0] == rank[lo][0]:
                hi += 1
            part = rank[lo:hi]
            n = np.array([len(x[1]) - width + 1 for x in part], np.uint8)
            at = np.array([x[2] for x in part], np.uint8)
            body = zstandard.compress(b"".join(x[1] for x in part), 1)
            for c, v in zip(cols, (key[0].as_py(), part[0][0], _pack(n), _pack(at), _pack(least[lo:hi]), body), strict=True):
                c.append(v)
            lo = hi
        kinds = [("block", pa.int32()), ("bucket", pa.int32())] + [(x, pa.binary()) for x in ("n", "at", "key", "body")]
        return pa.table(cols, schema=pa.schema(kinds))

    def owners(key: tuple, table: pa.Table) -> pa.Table:
        parts = [[_unpack(x, kind) for x in table[c].to_pylist()] for c, kind in (("n", np.uint8), ("at", np.uint8), ("key", np.int64), ("body", np.uint8))]
        n, at, own, body = (np.concatenate(x) for x in parts)
        n = n.astype(np.int64)
        least = smallest_owner(n, at.astype(np.int64), own, body, width)
        cuts = np.r_[0, np.cumsum([int(x.astype(np.int64).sum()) for x in parts[0]])]
        rows = [_pack(least[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table([table["block"], table["bucket"], pa.array(rows, pa.binary())], names=["block", "bucket", "least"])

    def cut(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        back = side.filter(pc.is_valid(side["least"]))
        table, own, first = originals(table, side)
        rank, _, mine, doc, a, n, keys, data, offsets = repeats(first, side)
        by_bucket = sorted(zip(back["bucket"].to_pylist(), back["least"].to_pylist(), strict=True))
        least = np.concatenate([_unpack(x, np.int64) for _, x in by_bucket]) if by_bucket else np.zeros(0, np.int64)
        size = np.array([len(x[1]) - width + 1 for x in rank], np.int64)
        begin = np.cumsum(size) - size
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        smaller = least[np.repeat(begin[mine], n) + step] < np.repeat(keys[doc], n) if len(mine) else np.zeros(0, bool)
        hit = (np.repeat(a, n) + step)[smaller]
        cover = np.zeros(len(data) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + width, -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        touched = np.bincount(np.searchsorted(offsets, hit, "right") - 1, minlength=len(keys)) > 0
        cols: list[list] = [[] for _ in range(6)]
        all_data, all_offsets = utf8(table["text"])
        place = np.cumsum(own) - 1
        for r, (lo, hi) in enumerate(zip(all_offsets[:-1].tolist(), all_offsets[1:].tolist(), strict=True)):
            body, spans, removed, i = all_data[lo:hi].tobytes(), [], 0, place[r]
            if not own[r]:
                if hi - lo >= width:
                    body, spans, removed = b"", [{"start": 0, "end": hi - lo}], hi - lo
            elif touched[i]:
                hit = gone[offsets[i] : offsets[i + 1]]
                edges = np.flatnonzero(np.diff(np.r_[False, hit, False])).tolist()
                spans = [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)]
                removed = int(hit.sum())
                body = all_data[lo:hi][~hit].tobytes()
            for c, v in zip(cols, (hi - lo, removed, len(spans), hashlib.sha256(body).hexdigest(), spans, body.decode("utf-8", "ignore")), strict=True):
                c.append(v)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.string())
        made = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
        names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", *rest]
        return pa.table([table["key"], *made, *[table[c] for c in rest]], names=names)

    def beside(rows: DataFrame, **own: str) -> DataFrame:
        kinds = {"b": "int", "key": "long", "h": "string", "bucket": "int", "codes": "binary", "least": "binary"}
        return rows.select(*[F.col(own[c]).alias(c) if c in own else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])

    side = beside(copies, b="b", key="key", h="h")
    classes = hash_classes(grouped.cogroup(side.groupBy("b")).applyInArrow(count, HASHES), often)
    side = side.union(beside(classes, b="block", bucket="bucket", codes="codes"))
    sent = grouped.cogroup(side.groupBy("b")).applyInArrow(segments, SEGMENTS)
    least = sent.groupBy("bucket").applyInArrow(owners, "block int, bucket int, least binary")
    side = side.union(beside(least, b="block", bucket="bucket", least="least"))
    schema = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept string"
    schema += "".join(f", {c} {base.schema[c].dataType.simpleString()}" for c in rest)
    out = grouped.cogroup(side.groupBy("b")).applyInArrow(cut, schema)
    return out.select(
        id_back("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", *[F.col(r).alias(c) for r, c in zip(rest, keep, strict=True)]
    )


__all__ = ["NO_ID", "remove_repeats"]
