"""Ingest new release files once, gate them, and promote or quarantine each release."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.gates import Gate
from ..operators.ledger import Ledger


def release_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """New files of a folder as a stream; each file is taken once per checkpoint.

    All files that are there when a run starts make one batch: a limit on files would cut a release
    into batches, of which each would pass for the whole release.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def ingest_releases(
    stream: DataFrame,
    ledger: Ledger,
    gates: Sequence[Gate],
    checkpoint: str,
    name: str = "ingest",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    further: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> StreamingQuery:
    """Work off all files that are there now, then stop.

    The load id follows from the checkpoint and the batch number, so streams never share a load,
    and a batch that is replayed after a failure gives the same ledger. A release must be complete
    when a run starts.
    """
    stream_id = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        ledger.promote(rows, gates, load=f"{name}-{stream_id}-{batch_id:08d}", further=further)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
