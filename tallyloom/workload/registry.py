"""Named queries with the operator ids they cover."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.uncertainty import VectorRule

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Runner
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a function under its own name. ``covers`` lists operator ids."""

    def add(run: Runner) -> Runner:
        if run.__name__ in REGISTRY:
            raise ValueError(f"query {run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run.__name__, tuple(covers.split()), run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def cents(c: str) -> Column:
    """A two-decimal amount as a whole number of cents in a double: its sums are exact, so they
    do not depend on the order of addition."""
    return F.round(F.col(c) * F.lit(100.0))


# Replicate weights by whole-number arithmetic, the same in any engine. Factors are 1.5 and 0.5.
def replicate_factor(key: Column, line: Column, r: Column) -> Column:
    return F.when((key * (2 * r + 1) + line * r * r) % 97 < 48, F.lit(1.5)).otherwise(F.lit(0.5))


def replicate_weights(full: Column, key: Column, line: Column) -> VectorRule:
    """``full`` times ``replicate_factor`` in numpy."""

    def make(full, key, line, known, r):
        if min(key.min(), line.min()) < 0:
            last = int(r[0, -1])
            most = [max(int(a.max()), -int(a.min())) for a in (key, line)]
            if most[0] * (2 * last + 1) + most[1] * last * last >= 1 << 63:
                raise OverflowError("replicate factor: a key is too large")
            high = np.fmod(key * (2 * r + 1) + line * (r * r), 97) < 48
        else:
            # Remainders first: what is left is below 2**15, and short numbers are many times faster.
            key, line, once, square = [(a % 97).astype(np.uint16) for a in (key, line, 2 * r + 1, r * r)]
            cell = key * once
            cell += line * square
            rest = cell // 97
            rest *= 97
            high = np.subtract(cell, rest, out=rest) < 48
        if not known.all():
            high &= known > 0
        return np.where(high, full * 1.5, full * 0.5)

    zero = F.lit(0).cast("bigint")
    numbers = [F.coalesce(c.cast("bigint"), zero) for c in (key, line)]
    known = (key.isNotNull() & line.isNotNull()).cast("int")
    return VectorRule((full.cast("double"), *numbers, known), make)


def replicate_factor_sql(key: str, line: str, r: str = "r") -> str:
    return f"CASE WHEN ({key}*(2*{r}+1)+{line}*{r}*{r})%97<48 THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END"
