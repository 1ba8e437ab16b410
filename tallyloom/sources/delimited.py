"""Delimited and Parquet readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of provider schemas.
PROVIDER_TYPES = {"integer": T.LongType(), "float": T.DoubleType(), "string": T.StringType()}

SOURCE_FILE = "SOURCE_FILE"


def provider_schema(fields: Sequence[Mapping[str, str]]) -> T.StructType:
    """``[{"name": ..., "dtype": "integer" | "float" | "string"}]`` to a Spark schema."""
    unknown = sorted({f["dtype"] for f in fields} - set(PROVIDER_TYPES))
    if unknown:
        raise ValueError(f"unknown provider types: {', '.join(unknown)}")
    return T.StructType([T.StructField(f["name"], PROVIDER_TYPES[f["dtype"]]) for f in fields])


def read_contract_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | Sequence[Mapping[str, str]], sep: str = "|"
) -> DataFrame:
    """Delimited text with a known schema, whose names replace the header's."""
    if not isinstance(schema, T.StructType):
        schema = provider_schema(schema)
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("enforceSchema", True)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_inferred_csv(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text with types read off the whole file; an empty string is null.

    Costs a second pass over the text, so known schemas should use ``read_contract_csv``.
    """
    reader = spark.read.options(header=True, inferSchema=True, samplingRatio=1.0, sep=sep, nullValue="")
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_compressed_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    provenance: Mapping[str, str],
    partitions: int | None = None,
) -> DataFrame:
    """Compressed delimited text with provenance on every column.

    A gzip file is one split, so rows are spread right after the read.
    """
    df = spark.read.schema(schema).option("header", True).csv(paths if isinstance(paths, str) else list(paths))
    spread = df.repartition(partitions) if partitions else df.repartition()
    return with_provenance(spread, provenance)


def with_provenance(df: DataFrame, provenance: Mapping[str, str]) -> DataFrame:
    """Attach key-value provenance to column metadata; Parquet keeps it."""
    meta = {"provenance": dict(provenance)}
    return df.select([F.col(f"`{c}`").alias(c, metadata=meta) for c in df.columns])


def provenance_of(df: DataFrame) -> dict[str, str]:
    return dict(df.schema.fields[0].metadata.get("provenance", {})) if df.schema.fields else {}


def _common_type(types: Sequence[T.DataType]) -> T.DataType:
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, T.NumericType) for t in distinct):
        whole = all(isinstance(t, T.IntegralType) for t in distinct)
        return T.LongType() if whole else T.DoubleType()
    return T.StringType()


def stack_members(members: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from a member is null there, and members that
    disagree on a type meet at the widest."""
    seen: dict[str, list[T.DataType]] = {}
    for member in members:
        for field in member.schema.fields:
            seen.setdefault(field.name, []).append(field.dataType)
    target = {name: _common_type(types) for name, types in seen.items()}
    aligned = [
        m.select([F.col(f"`{c}`").cast(target[c]).alias(c) for c in m.columns]) for m in members
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def read_members(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Read member files on their own and stack them with the file name as provenance."""
    frames = []
    for path in paths:
        member = (
            read_contract_csv(spark, path, schema, sep) if schema is not None else read_inferred_csv(spark, path, sep)
        )
        frames.append(member.withColumn(SOURCE_FILE, F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0)))
    return stack_members(frames)


def read_parquet_pruned(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """File name, row count and column count per Parquet file; no data column is read."""
    df = spark.read.parquet(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    counts = df.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_columns", F.lit(len(df.columns)))
