"""Cumulative weights, weighted quantiles and weighted quantile groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import valid_weight
from ..plans.ranges import running_total

CUM, TOTAL = "cum_weight", "total_weight"


def has_value(c: str) -> Column:
    """A finite number."""
    number = F.col(c).cast("double")
    return F.col(c).isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def cumulative_weight(
    df: DataFrame, weight: str, order: str, tie: str, by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``cum_weight`` and ``total_weight`` in ``(order, tie)`` order."""
    return running_total(df, weight, order, tie, by, CUM, TOTAL, ranges)


def weighted_quantile(
    df: DataFrame,
    value: str,
    weight: str,
    q: float | Sequence[float] = 0.5,
    by: Sequence[str] = (),
    prefix: str = "q",
) -> DataFrame:
    """Per group, the first value whose cumulative weight reaches ``q`` of the total.

    Rows of equal value are summed first: the answer does not depend on their order, and a
    frequent value shrinks to one row before anything is sorted. One ``q`` gives a column
    ``quantile``; several give ``<prefix>_<percent>``.
    """
    by = list(by)
    cuts = [q] if isinstance(q, (int, float)) else list(q)
    names = ["quantile"] if isinstance(q, (int, float)) else [f"{prefix}_{round(c * 100):d}" for c in cuts]
    present = df.filter(has_value(value) & valid_weight(weight))
    points = present.groupBy(*by, value).agg(F.sum(weight).alias("__w"))
    run = running_total(points, "__w", value, [], by, CUM, TOTAL)
    return run.groupBy(*by).agg(
        *[
            F.min(F.when(F.col(CUM) >= F.lit(c) * F.col(TOTAL), F.col(value))).alias(name)
            for c, name in zip(cuts, names)
        ]
    )


def imputed_quantile(
    df: DataFrame, value: str, weight: str, implicate: str, q: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """The quantile of each implicate, then their mean."""
    per_implicate = weighted_quantile(df, value, weight, q, [*by, implicate])
    return per_implicate.groupBy(*by).agg(F.avg("quantile").alias("quantile"))


def median_unweighted(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median"
) -> DataFrame:
    """Exact median per group, the mean of the two middle values for an even count.

    Built on value counts and their running total, so a large group is never held in one
    aggregation buffer.
    """
    by = list(by)
    points = df.filter(has_value(value)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    run = running_total(points, "__n", value, [], by, "__upto", "__all")
    lower = F.floor((F.col("__all") + 1) / F.lit(2))
    upper = F.floor((F.col("__all") + 2) / F.lit(2))
    middle = run.groupBy(*by).agg(
        F.min(F.when(F.col("__upto") >= lower, F.col(value))).alias("__lo"),
        F.min(F.when(F.col("__upto") >= upper, F.col(value))).alias("__hi"),
    )
    return middle.select(*by, ((F.col("__lo") + F.col("__hi")) / F.lit(2.0)).alias(out))


def midpoint_group(cum: Column, weight: Column, total: Column, k: int) -> Column:
    """Group of the weight midpoint: ``least(k, floor((cum - w/2) / total * k) + 1)``."""
    share = (cum - weight / F.lit(2.0)) / total
    return F.least(F.lit(k), F.floor(share * F.lit(k)) + 1).cast("int")


def right_edge_group(cum: Column, total: Column, cuts: Sequence[float]) -> Column:
    """``1 +`` the number of cuts that the cumulative share has reached."""
    share = cum / total
    reached = [F.when(share >= F.lit(c), F.lit(1)).otherwise(F.lit(0)) for c in cuts]
    out = F.lit(1)
    for r in reached:
        out = out + r
    return out.cast("int")


def quantile_groups_midpoint(
    df: DataFrame,
    value: str,
    weight: str,
    tie: str,
    k: int,
    by: Sequence[str] = (),
    out: str = "quantile_group",
) -> DataFrame:
    """Assign each row with a value and a positive weight to one of ``k`` weighted groups."""
    valid = df.filter(has_value(value) & valid_weight(weight))
    run = cumulative_weight(valid, weight, value, tie, by)
    group = midpoint_group(F.col(CUM), F.col(weight), F.col(TOTAL), k)
    return run.withColumn(out, group).drop(CUM, TOTAL)


def quantile_groups_right_edge(
    df: DataFrame,
    value: str,
    weight: str,
    tie: str,
    cuts: Sequence[float] = (0.2, 0.4, 0.6, 0.8),
    by: Sequence[str] = (),
    out: str = "quantile_group",
) -> DataFrame:
    """Assign rows by the right edge of their weight. Missing weights count as zero, missing
    values sort last."""
    filled = df.withColumn(weight, F.coalesce(F.col(weight), F.lit(0)))
    run = cumulative_weight(filled, weight, value, tie, by)
    return run.withColumn(out, right_edge_group(F.col(CUM), F.col(TOTAL), cuts)).drop(CUM, TOTAL)
