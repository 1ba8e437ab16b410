"""Sizes known before a job runs, and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_fallback: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be unreadable to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_fallback
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_fallback


def new_scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Rows are fixed from here on, so partition ids stored in them stay true when an executor is
    lost and its tasks run again.
    """
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, column: str, buckets: int, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder in buckets of ``column`` and read it back.

    Grouping by ``column``, windows over it and joins on it then use the stored layout, and the rows are
    not shuffled again. Stored columns have plain names, as a table catalog may not take all of them. Only
    the resolved frame is kept: the table's name leaves the catalog at once, its files stay.
    """
    spark = df.sparkSession
    plain = [c if c == column else f"c{i}" for i, c in enumerate(df.columns)]
    name = f"tallyloom_{uuid.uuid4().hex}"
    writer = df.toDF(*plain).write.format("parquet").bucketBy(buckets, column)
    writer.option("path", new_scratch_path(spark, label)).saveAsTable(name)
    stored = spark.table(name).toDF(*df.columns)
    spark.sql(f"DROP TABLE {name}")
    return stored


def plan_bytes(df: DataFrame) -> int:
    """Size estimate of a plan's output.

    Catalyst multiplies the sizes of join sides when it has no statistics, so the estimate is
    held below the sum of the tables read. Both only steer how work is cut, never its result.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(int(str(plan.stats().sizeInBytes())), read)


MAX_RANGES = 32768
#: Catalyst takes a source without statistics, such as rows given by a program, as about this large.
UNKNOWN_BYTES = 1 << 62


def range_count(df: DataFrame, target_bytes: int = 128 * 1024 * 1024) -> int:
    """How many ranges to cut a frame into so that one range fits a task.

    Past ``MAX_RANGES`` ranges grow instead; a larger range sorts with spilling. Rows of a source
    without statistics are counted, in a job of its own.
    """
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = plan_bytes(df)
    if size >= UNKNOWN_BYTES:
        size = df.count() * df._jdf.schema().defaultSize()
    return max(floor, min(MAX_RANGES, -(-size // target_bytes)))


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores before work that multiplies them.

    Applies only to inputs too small to be split over the cores on their own; for larger ones
    this is the frame itself and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    split = 128 * 1024 * 1024
    if plan_bytes(df) < cores * split // 2:
        return df.repartition(cores)
    return df
