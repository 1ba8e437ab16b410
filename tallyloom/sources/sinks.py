"""Sinks for release tables, small result tables and diagnostics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet_zstd(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Compressed Parquet. With partition columns the rows are rebalanced on them first, so that
    not every task writes a small file into every partition; large partitions are split."""
    if not partition_by:
        df.write.mode(mode).option("compression", "zstd").parquet(path)
        return
    balanced = df.hint("rebalance", *partition_by)
    balanced.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def result_table(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns as text with fixed decimals."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        [
            F.replace(F.format_number(F.bround(f.name, digits), digits), F.lit(","), F.lit("")).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_result_csv(df: DataFrame, path: str, order: Sequence[str | Column], digits: int = 6, mode: str = "errorifexists") -> None:
    """CSV parts in a stable order: the parts in order of their names, one after another, are the
    ordered table. Rows are sorted and written range by range in parallel, by the values of ``order``
    and not by their text; a small table is one part where adaptive execution joins small ranges."""
    result_table(df.orderBy(*order), digits).write.mode(mode).option("header", True).csv(path)


def diagnostics(analysis: str, sections: Mapping[str, DataFrame]) -> DataFrame:
    """One record per analysis. Each section is a one-row frame and becomes one struct."""
    if not sections:
        raise ValueError("at least one section is needed")
    structs = {name: frame.select(F.struct(*frame.columns).alias(name)) for name, frame in sections.items()}
    first, *rest = structs
    values = [structs[name].scalar().alias(name) for name in rest]
    return structs[first].select(F.lit(analysis).alias("analysis"), first, *values)


def write_diagnostics(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    record.select(F.to_json(F.struct(*record.columns)).alias("value")).write.mode(mode).text(path)
