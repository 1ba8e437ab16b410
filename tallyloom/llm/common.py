"""Blocks of documents, Arrow text as numpy bytes, multiplicities of hashes and linked groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize

#: Bytes of text that one block of documents holds about.
BLOCK_BYTES = 4 << 20
#: Stands for a null document id inside an operator: larger than all others.
NO_ID = (1 << 63) - 1
#: ASCII white space of the contracts, as a Java and RE2 class.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def stage(df: DataFrame, label: str) -> DataFrame:
    """A frame written to the shared folder and read back, so that lost executors cost no rework."""
    return materialize(df, label)


def id_key(c: str = "doc_id") -> Column:
    return F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))


def id_back(c: str) -> Column:
    return F.when(F.col(c) != NO_ID, F.col(c))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_count(df: DataFrame, size: Column, target: int = BLOCK_BYTES) -> int:
    """Number of blocks of about ``target`` bytes; one pass over the sizes only."""
    total = df.agg(F.sum(size).alias("s")).first()["s"] or 0
    return max(shuffle_partitions(df), -(-int(total) // target))


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks] or [pa.array([], pa.large_string())])
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return body[:0], np.zeros(1, np.int64)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def bucket_slices(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Cut sorted hashes into equal ranges of their high 32 bits."""
    edges = np.array([-(-(b << 32) // buckets) for b in range(buckets + 1)], np.uint64)
    cuts = np.searchsorted(hashes >> np.uint64(32), edges)
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(int(cuts[b]), int(cuts[b + 1]))


HASHES = "block int, bucket int, hashes binary, counts binary"
FOUND = "block int, hashes binary, counts binary"


def hash_rows(block: int, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """One row per bucket: the block's sorted distinct hashes there and how often each occurs."""
    cols: list[list] = [[], [], [], []]
    for b, part in bucket_slices(hashes, buckets):
        for c, v in zip(cols, (block, b, hashes[part].tobytes(), counts[part].astype(np.uint32).tobytes()), strict=True):
            c.append(v)
    return pa.table(cols, schema=pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]))


def _totals(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """The hash arrays of a bucket's rows and, for all their entries in order, the total count."""
    parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
    totals = np.empty(len(hashes), np.int64)
    totals[order] = np.repeat(np.add.reduceat(counts[order], first), np.diff(np.r_[first, len(hashes)]))
    return parts, totals


CLASSES = "block int, bucket int, codes binary"


def hash_classes(rows: DataFrame, often: int) -> DataFrame:
    """From ``HASHES`` rows: for each of them one code per hash, 0 if its count over all blocks is 1,
    2 if it is above ``often``, else 1. A block puts its rows together by bucket and has the codes of
    its sorted hashes; they take a small part of what the hashes would."""

    def classify(key: tuple, table: pa.Table) -> pa.Table:
        parts, totals = _totals(table)
        code = ((totals > 1).astype(np.uint8) + (totals > often)).astype(np.uint8)
        cuts = np.cumsum([0, *map(len, parts)])
        packed = [zstandard.compress(code[a:b].tobytes(), 3) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table([table["block"], table["bucket"], pa.array(packed, pa.binary())], names=["block", "bucket", "codes"])

    return rows.groupBy("bucket").applyInArrow(classify, CLASSES)


def joined_codes(buckets: list[int], codes: list[bytes]) -> np.ndarray:
    """The codes of a block's sorted hashes from its ``CLASSES`` rows."""
    parts = [np.frombuffer(zstandard.decompress(c), np.uint8) for _, c in sorted(zip(buckets, codes, strict=True))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def copies_of(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``base(block, key, h)`` with a text's digest ``h``: all rows with the smallest key of their
    text as ``first``, and the distinct rows that are later copies as ``(b, key, h)``."""
    ids = base.select("block", "key", "h")
    ids = ids.join(ids.groupBy("h").agg(F.min("key").alias("first")), "h")
    return ids, ids.filter("key != first").select(*[F.col(c).alias(a) for c, a in (("block", "b"), ("key", "key"), ("h", "h"))]).distinct()


def repeated_hashes(rows: DataFrame) -> DataFrame:
    """From ``HASHES`` rows of all blocks: each block's hashes whose count over all blocks is two or
    more, with that count. A block names a hash once, so a frequent hash has one entry per block."""

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        parts, totals = _totals(table)
        cols: list[list] = [[], [], []]
        at = 0
        for block, part in zip(table["block"].to_pylist(), parts, strict=True):
            own = totals[at : at + len(part)]
            at += len(part)
            if (keep := own >= 2).any():
                for c, v in zip(cols, (block, part[keep].tobytes(), np.minimum(own[keep], 0xFFFFFFFF).astype(np.uint32).tobytes()), strict=True):
                    c.append(v)
        return pa.table(cols, schema=pa.schema([("block", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    return rows.groupBy("bucket").applyInArrow(add_up, FOUND)


def lookup(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The count of each hash in sorted ``known``, 0 where it is not there."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, counts[at].astype(np.int64), 0)


def joined_found(hashes: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Several ``FOUND`` rows of one block as sorted arrays."""
    known = np.concatenate([np.frombuffer(x, np.uint64) for x in hashes]) if hashes else np.zeros(0, np.uint64)
    times = np.concatenate([np.frombuffer(x, np.uint32) for x in counts]) if counts else np.zeros(0, np.uint32)
    order = np.argsort(known)
    return known[order], times[order]


#: Edges that a task gathers before it reduces them to a forest.
FOREST_EDGES = 1 << 20


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the smallest of its connected group, and that smallest node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if not (apart := low != high).any():
            break
        a, b = low[apart], high[apart]
        np.minimum.at(root, b, a)
        while (further := root[root] != root).any():
            root[further] = root[root[further]]
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as forests: each of its nodes goes to the smallest it reaches there."""
    own, held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        return forest(np.concatenate([u for u, _ in own]), np.concatenate([v for _, v in own]))

    for batch in batches:
        own.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        held += len(batch)
        if held >= FOREST_EDGES:
            u, v = reduced()
            if len(u) >= FOREST_EDGES // 2:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                u, v = u[:0], v[:0]
            own, held = [(u, v)], len(u)
    if held:
        u, v = reduced()
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def linked_groups(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected groups of an edge list: ``(node, group)`` with the smallest node as group.

    Each task first ties the nodes of its own edges to the smallest they reach. While that leaves a
    node with two smaller ones, or one that is both tied and tied to, the large-star and small-star
    steps bring edges of a node together; each step is written to the shared folder. No group is
    gathered: a node meets only the minimum of its neighbours, which Spark combines before it shuffles.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        near = both.join(low, "u").filter(F.col("v") > F.col("u")) if large else both.join(low, "u")
        to_low = near.filter(F.col("v") != F.col("w")).select(F.col("v").alias("u"), F.col("w").alias("v"))
        return to_low if large else to_low.union(low.select("u", F.col("w").alias("v")))

    def tied(e: DataFrame, label: str) -> DataFrame:
        """Stored edges, read back as forests."""
        return stage(e, label).mapInArrow(_forests, "u long, v long")

    def done(e: DataFrame) -> bool:
        ends = e.select(F.col("u").alias("x"), "v").union(e.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("v")))
        ends = ends.groupBy("x").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count_if(F.col("v").isNull()).alias("as_group"))
        return ends.filter("low < high OR low IS NOT NULL AND as_group > 0").isEmpty()

    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u != v")
    e = tied(e, "edges")
    while not done(e):
        e = tied(star(e, large=True), "large-star")
        e = tied(star(e, large=False), "small-star")
    e = e.select(F.col("u").alias("node"), F.col("v").alias("group")).union(e.select(F.col("v").alias("node"), F.col("v").alias("group")))
    return e.distinct()
