"""Token sequences in a keyed random order, as shards of fixed stride.

Texts are encoded once and cut into sequences, which the stored table numbers from 0. A Feistel
network permutes the next power of four; numbers that fall outside the count walk along their cycle
until they are inside, so every sequence gets one slot and every slot one sequence. The order needs no
sort, only the key, and can be inverted: a reader that resumes at a slot knows what it must find there.

Slots are cut into shards. Sequences are range-partitioned by shard, and each shard becomes one row
whose payload holds its slots one after another, each of ``stride`` bytes: slot ``s`` begins at
``(s - first_slot) * stride``. Rows are a few hundred kilobytes, so any store that Spark writes to holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mixed, shuffle_partitions, stage, text_or_empty
from .token_count import parts_of, rank_encoder, ranks_of

SEQUENCE = 1024
SLOTS = 256
ROUNDS = 6


def _round_keys(key: int) -> list[np.uint64]:
    return [np.uint64(x) for x in mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))]


def _half_bits(n: int) -> int:
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def slots_of(numbers: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of each number below ``n``, or with ``back`` the number in each slot."""
    bits = np.uint64(_half_bits(n))
    low = np.uint64((1 << int(bits)) - 1)
    keys = _round_keys(key)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & low
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (mixed(left + k) & low), left
            else:
                left, right = right, left ^ (mixed(right + k) & low)
        return (left << bits) | right

    out = once(numbers.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def slot_column(number: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slot(x: pd.Series) -> pd.Series:
        return pd.Series(slots_of(x.to_numpy(), n, key))

    return slot(number)


def id_width(path: str) -> int:
    """Bytes of one stored id: 2, or 4 for a vocabulary with ids of 65,536 and more."""
    with open(path, "rb") as f:
        return 2 if max(ranks_of(f.read()).values()) < 1 << 16 else 4


def sequences(docs: DataFrame, path: str, pattern: str, length: int = SEQUENCE) -> DataFrame:
    """``part, place, doc_id, piece, n_tokens, ids`` of the texts' tokens in sequences of ``length``.

    ``ids`` are little-endian 16-bit numbers, or 32-bit ones for vocabularies that need them, each
    sequence compressed, as the stored table and the shuffle both hold every token. Long texts are
    encoded in parts that no token crosses. Special strings in a text are ordinary text. A text without tokens has no sequence. ``part`` and ``place``
    are the task and the row in it; the frame must be stored before they are used.
    """
    size = id_width(path)
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ranks = ranks_of(shared.value)
        kind = f"<u{size}"
        ids_of = rank_encoder(ranks, pattern)
        pack = zstandard.ZstdCompressor(level=1).compress
        part, place = TaskContext.get().partitionId(), 0

        def encode(text: str) -> bytes:
            ids = (ids_of(piece) for piece in parts_of(text))
            return b"".join(np.fromiter(x, kind, len(x)).tobytes() for x in ids)

        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py())
                for i, at in enumerate(range(0, len(ids), length * size)):
                    body = ids[at : at + length * size]
                    for c, v in zip(cols, (part, place, doc, i, len(body) // size, pack(body)), strict=True):
                        c.append(v)
                    place += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["part", "place", "doc_id", "piece", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "part int, place long, doc_id long, piece int, n_tokens int, ids binary")


def shards(stored: DataFrame, key: int, length: int = SEQUENCE, width: int = 2, slots: int = SLOTS) -> DataFrame:
    """``shard, first_slot, n_slots, stride, width, payload, doc_ids, pieces, n_tokens`` of a stored
    ``sequences`` frame, range-partitioned and sorted by shard. Lists and payload are in slot order;
    a short sequence is filled up with zeros and its length is in ``n_tokens``. ``width`` is the
    ``id_width`` that the sequences were stored with."""
    counts = stored.groupBy("part").agg(F.count("*").alias("n"))
    n = stored.count()
    stride = length * width
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per task of the encoding.
    starts = counts.select(F.col("part").alias("p"), before.alias("start"))
    rows = stored.join(starts, F.col("part") == F.col("p"))
    rows = rows.select(slot_column(F.col("start") + F.col("place"), n, key).alias("slot"), "doc_id", "piece", "n_tokens", "ids")
    rows = rows.withColumn("shard", F.floor(F.col("slot") / slots))

    def fill(group: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        unpack = zstandard.ZstdDecompressor().decompress
        payload = b"".join(unpack(x).ljust(stride, b"\0") for x in table["ids"].to_pylist())
        first, count = table["slot"][0].as_py(), table.num_rows
        one = [pa.array([v], k) for v, k in ((group[0].as_py(), pa.int64()), (first, pa.int64()), (count, pa.int32()), (stride, pa.int32()), (width, pa.int32()), (payload, pa.binary()))]
        lists = [pa.array([table[c].to_pylist()], pa.list_(k)) for c, k in (("doc_id", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int32()))]
        return pa.table([*one, *lists], names=["shard", "first_slot", "n_slots", "stride", "width", "payload", "doc_ids", "pieces", "n_tokens"])

    cut = rows.repartitionByRange(shuffle_partitions(stored), "shard")
    schema = "shard long, first_slot long, n_slots int, stride int, width int, payload binary, doc_ids array<long>, pieces array<int>, n_tokens array<int>"
    return cut.groupBy("shard").applyInArrow(fill, schema)


def training_shards(docs: DataFrame, path: str, pattern: str, key: int, length: int = SEQUENCE, slots: int = SLOTS) -> DataFrame:
    return shards(stage(sequences(docs, path, pattern, length), "sequences"), key, length, id_width(path), slots)


def write_shards(frame: DataFrame, path: str) -> None:
    frame.write.parquet(path)


def read_slots(spark, path: str, first: int, count: int) -> DataFrame:
    """``slot, doc_id, piece, ids`` of some slots in order. Only the files of their shards are read."""
    rows = spark.read.parquet(path).filter((F.col("first_slot") < first + count) & (F.col("first_slot") + F.col("n_slots") > first))
    at = F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1))
    rows = rows.select("*", at.alias("at")).withColumn("slot", F.col("first_slot") + F.col("at")).filter((F.col("slot") >= first) & (F.col("slot") < first + count))
    body = F.substring(F.col("payload"), F.col("at") * F.col("stride") + 1, F.get("n_tokens", "at") * F.col("width"))
    return rows.select("slot", F.get("doc_ids", "at").alias("doc_id"), F.get("pieces", "at").alias("piece"), body.alias("ids")).orderBy("slot")
