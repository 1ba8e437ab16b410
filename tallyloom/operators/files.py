"""Byte counts and SHA-256 digests of files of any size.

Spark lists the files and deals them over tasks; a task reads a file in pieces, so its memory does not
grow with the file.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that are in memory at once.
PIECE_BYTES = 8 << 20


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, bytes`` of the files below a folder, or of one file. Contents are not read.

    Spark's reader does not list empty files: one that was cut to nothing counts as missing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("bytes"))


def with_digests(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``files(path, ...)`` with ``sha256``, null for a file that is not there any more.

    Paths are read from Python: local files and the stores that Arrow knows (``hdfs``, ``s3``, ``gs``).
    """

    def digest(path: str) -> str | None:
        from pyarrow import fs

        local = re.sub("^file:/*", "/", path)
        store, name = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)
        sha = hashlib.sha256()
        try:
            with store.open_input_stream(name, buffer_size=0) as stream:
                while piece := stream.read(piece_bytes):
                    sha.update(piece)
        except FileNotFoundError:
            return None
        return sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([digest(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "sha256"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition("path").mapInArrow(run, f"{kinds}, sha256 string")


def file_errors(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """``error, path`` from comparing recorded files ``(path, bytes, sha256)`` with those that are found."""
    r = recorded.select("path", F.col("bytes").alias("__b"), F.col("sha256").alias("__s"), F.lit(True).alias("__known"))
    f = found.select("path", F.col("bytes").alias("__ab"), F.col("sha256").alias("__as"), F.lit(True).alias("__there"))
    both = r.join(f, "path", "full_outer")
    lost = F.col("__known") & (F.col("__there").isNull() | F.col("__as").isNull())
    errors = F.array_compact(
        F.array(
            F.when(lost, F.lit("missing file")),
            F.when(F.col("__known").isNull(), F.lit("unrecorded file")),
            F.when(F.col("__b") != F.col("__ab"), F.lit("byte count mismatch")),
            F.when(F.col("__s") != F.col("__as"), F.lit("sha256 mismatch")),
        )
    )
    return both.select(F.explode(errors).alias("error"), "path")
