"""Running totals over a total order without sending a group to one task.

A window ordered over a whole group sorts that group in one task. Here rows are cut into
contiguous ranges of ``(by, order, tie)``; each range is summed on its own and shifted by the
total of the ranges before it. The tie key is unique, so neither one large group nor one
frequent value can make a range that does not fit. Any cut gives the exact result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize_by, range_count

RANGE = "__range"


def sort_keys(order: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(order).asc_nulls_last(), *[F.col(t).asc() for t in tie]]


def cut_ranges(df: DataFrame, order: str, tie: Sequence[str], by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Range-partition on ``(by, order, tie)`` and store each row's range number.

    The rows are stored in buckets of that number, a bucket for each range, so what works range by range
    reads its buckets and shuffles no rows.
    """
    n = ranges or range_count(df)
    keys = [*[F.col(b).asc() for b in by], *sort_keys(order, tie)]
    cut = df.repartitionByRange(n, *keys).withColumn(RANGE, F.spark_partition_id())
    return materialize_by(cut, RANGE, n, "ranges")


def spanning_groups(totals: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Per range, its groups that reach into other ranges as ``__spans``: their keys ``b0, b1, ...``, the
    sum ``before`` of earlier ranges and the sum ``total`` of all.

    ``totals`` has one row per group and range, so the windows see few rows. Ranges are contiguous in
    ``by``: only the first and the last group of a range can reach beyond it, so a list has two entries at most.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    spans = totals.select(
        RANGE,
        F.count(F.lit(1)).over(group).alias("__ranges"),
        F.struct(
            *[F.col(b).alias(f"b{i}") for i, b in enumerate(by)],
            F.sum(value).over(earlier).alias("before"),
            F.sum(value).over(group).alias("total"),
        ).alias("__span"),
    )
    return spans.filter("__ranges > 1").groupBy(RANGE).agg(F.collect_list("__span").alias("__spans"))


def running_total(
    df: DataFrame,
    value: str,
    order: str,
    tie: str | Sequence[str],
    by: Sequence[str] = (),
    out: str = "cum_weight",
    total: str = "total_weight",
    ranges: int | None = None,
) -> DataFrame:
    """Add the running and the full sum of ``value`` per group, in ``(order, tie)`` order.

    The same plan runs at every size. ``tie`` must make the order total.
    """
    tie = [tie] if isinstance(tie, str) else list(tie)
    by = list(by)
    cut = cut_ranges(df, order, tie, by, ranges)
    totals = cut.groupBy(*by, RANGE).agg(F.sum(value).alias("__sum"))
    spans = spanning_groups(totals, by, "__sum")
    part = Window.partitionBy(*by, RANGE)
    within = part.orderBy(*sort_keys(order, tie)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({"__local": F.sum(value).over(within), "__all": F.sum(value).over(part)})

    def same_group(span: Column) -> Column:
        same = F.lit(True)
        for i, b in enumerate(by):
            same = same & span[f"b{i}"].eqNullSafe(F.col(b))
        return same

    # Joined on the range alone, so that the stored layout serves the join too.
    joined = local.join(spans, RANGE, "left").withColumn("__span", F.get(F.filter("__spans", same_group), F.lit(0)))
    return joined.select(
        *df.columns,
        (F.col("__local") + F.coalesce(F.col("__span")["before"], F.lit(0))).alias(out),
        F.coalesce(F.col("__span")["total"], F.col("__all")).alias(total),
    )
