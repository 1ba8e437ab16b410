"""Time series: as-of baselines, indexing, latest values, stacking, ranking and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ColumnLike, col, ratio
from ..functions.recode import label_rank


def asof_value(value: str, date: str, tie: str | None = None, cutoff: ColumnLike | None = None) -> Column:
    """Aggregate: the last value at or before ``cutoff`` (or the last of all).

    One value per group is held and combined before the shuffle. Without a tie key the buffers
    are plain numbers, which keeps the aggregation hashed.
    """
    inside = (lambda c: c) if cutoff is None else (lambda c: F.when(F.col(date) <= col(cutoff), c))
    order = inside(F.struct(date, tie) if tie else F.col(date))
    newest = F.max_by(value, order)
    return F.struct(F.max(inside(F.col(date))).alias("date"), newest.alias("value"))


def asof_baseline(
    df: DataFrame, key: str, date: str, value: str, cutoff: ColumnLike, tie: str | None = None
) -> DataFrame:
    """Every row with its series' baseline. A series without one keeps a null baseline."""
    base = df.groupBy(key).agg(asof_value(value, date, tie, cutoff).alias("__b"))
    side = base.select(
        F.col(key).alias("__key"), F.col("__b.date").alias("baseline_date"), F.col("__b.value").alias("baseline")
    )
    return df.join(side, F.col(key) == F.col("__key"), "left").drop("__key")


def index_to_baseline(value: ColumnLike, baseline: ColumnLike) -> Column:
    return ratio(value, baseline) * F.lit(100.0)


def days_since(date: ColumnLike, event: ColumnLike) -> Column:
    return F.datediff(col(date), col(event))


def baseline_latest_summary(
    df: DataFrame, key: str, date: str, value: str, cutoff: ColumnLike, tie: str | None = None
) -> DataFrame:
    """Baseline, latest value, percent and absolute change per series, in one aggregation."""
    both = df.groupBy(key).agg(
        asof_value(value, date, tie, cutoff).alias("b"), asof_value(value, date, tie).alias("l")
    )
    return both.select(
        key,
        F.col("b.date").alias("baseline_date"),
        F.col("b.value").alias("baseline_value"),
        F.col("l.date").alias("latest_date"),
        F.col("l.value").alias("latest_value"),
        ((ratio("l.value", "b.value") - F.lit(1.0)) * F.lit(100.0)).alias("percent_change"),
        (F.col("l.value") - F.col("b.value")).alias("absolute_change"),
    )


def latest_per_group(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    tie: str | Sequence[str],
    min_period: str | None = None,
) -> DataFrame:
    """The newest row per group, ties by ``tie``; groups that end before ``min_period`` drop out.

    A ``max_by`` over whole rows, not a sorted window: one row per group is held and moved.
    """
    tie = [tie] if isinstance(tie, str) else list(tie)
    source = df if min_period is None else df.filter(F.col(period) >= F.lit(min_period))
    rest = [c for c in df.columns if c not in keys]
    newest = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(period, *tie)).alias("__row"))
    return newest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def nth_latest(df: DataFrame, period: str, lag: int) -> DataFrame:
    """Rows of the period ``lag`` places before the newest distinct one."""
    periods = df.select(F.col(period).alias("__p")).distinct().orderBy(F.col("__p").desc()).limit(lag + 1)
    chosen = periods.agg(F.min("__p").alias("__p"), F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == lag + 1)
    return df.join(chosen.select("__p"), F.col(period) == F.col("__p"), "left_semi")


def stack_bounds(df: DataFrame, x: str, band: str, labels: Sequence[str], v: str) -> DataFrame:
    """Lower and upper boundary of each band in its stack.

    Sums per ``(x, band)`` come first, so a window sees at most one row per band.
    """
    cells = df.groupBy(x, band).agg(F.sum(v).alias("value"))
    upto = (
        Window.partitionBy(x)
        .orderBy(label_rank(band, labels), F.col(band))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    top = cells.withColumn("upper", F.sum("value").over(upto))
    return top.withColumn("lower", F.col("upper") - F.col("value"))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def top_k(df: DataFrame, v: str, k: int, tie: str, ascending_display: bool = True) -> DataFrame:
    """The ``k`` largest rows, ties by key, shown smallest first."""
    top = df.orderBy(F.col(v).desc(), F.col(tie).asc()).limit(k)
    return top.orderBy(F.col(v).asc(), F.col(tie).desc()) if ascending_display else top


def order_by_labels(df: DataFrame, column: str, labels: Sequence[str], *then: Column | str) -> DataFrame:
    return df.orderBy(label_rank(column, labels), *then)


def multi_key_sort(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.orderBy(*keys)


def limited_union(a: DataFrame, b: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """Up to ``n`` rows: first from ``a``, the rest from ``b``, each in ``order``.

    Each side is cut to ``n`` before the union, so the final pick sorts at most ``2 n`` rows.
    """
    first = a.orderBy(*order).limit(n).withColumn("__side", F.lit(0))
    second = b.orderBy(*order).limit(n).withColumn("__side", F.lit(1))
    both = first.unionByName(second, allowMissingColumns=True)
    return both.orderBy("__side", *order).limit(n).drop("__side")


def append_series(base: DataFrame, derived: DataFrame) -> DataFrame:
    return base.unionByName(derived)


def concat_members(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def set_relation(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """One row: does ``a`` contain ``b``, equal it, share nothing with it. Nulls are ignored."""
    pick = lambda d, flag: d.select(column).filter(F.col(column).isNotNull()).distinct().withColumn(flag, F.lit(1))
    both = pick(a, "__a").join(pick(b, "__b"), column, "full_outer")
    only_a = F.count_if(F.col("__b").isNull())
    only_b = F.count_if(F.col("__a").isNull())
    shared = F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull())
    return both.agg(
        (only_b == 0).alias("contains_all"),
        ((only_a == 0) & (only_b == 0)).alias("equals_set"),
        (shared == 0).alias("disjoint"),
    )


def subset_publication(df: DataFrame, column: str, groups: Sequence[str]) -> DataFrame:
    """All-group table with a flag on the groups that are published."""
    return df.withColumn("published", F.col(column).isin(*groups))
