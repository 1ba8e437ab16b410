"""Point estimators. Column-returning functions go inside any ``agg``; Catalyst plans the lot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ColumnLike, col, ratio
from .joins import with_one_row

KEEP, DROP = "keep_weight", "drop"


def estimate(df: DataFrame, by: Sequence[str] = (), **aggregates: Column) -> DataFrame:
    """``groupBy(by).agg`` with names taken from the keywords."""
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in aggregates.items()])


def weighted_total(w: ColumnLike) -> Column:
    return F.sum(col(w))


def weighted_count_where(w: ColumnLike, predicate: Column) -> Column:
    """Sum of weights over rows where the predicate holds."""
    return F.coalesce(F.sum(F.when(predicate, col(w))), F.lit(0.0))


def weighted_mean(v: ColumnLike, w: ColumnLike, missing: str = KEEP) -> Column:
    """Weighted mean. A missing value keeps its weight in the denominator (``keep_weight``) or
    leaves both sums (``drop``)."""
    v, w = col(v), col(w)
    if missing not in (KEEP, DROP):
        raise ValueError(f"missing must be {KEEP} or {DROP}")
    den = F.sum(w) if missing == KEEP else F.sum(F.when(v.isNotNull(), w))
    return ratio(F.sum(v * w), den)


@dataclass(frozen=True)
class WeightedMean:
    """``weighted_mean`` of one column as a function of the weight, which also states the weighted sums it is made of."""

    v: ColumnLike
    missing: str = KEEP

    def __call__(self, w: ColumnLike) -> Column:
        return weighted_mean(self.v, w, self.missing)

    def terms(self) -> list[Column]:
        """What is multiplied by the weight and summed."""
        v, one = col(self.v), F.lit(1.0)
        return [v, one if self.missing == KEEP else F.when(v.isNotNull(), one)]

    def from_sums(self, total: Column, weight: Column) -> Column:
        return ratio(total, weight)


def weighted_mean_scaled(v: ColumnLike, w: ColumnLike, divisor: float, missing: str = KEEP) -> Column:
    """Weighted mean in another unit, such as minutes to hours."""
    return weighted_mean(v, w, missing) / F.lit(float(divisor))


def weighted_share(predicate: Column, w: ColumnLike, missing: str = KEEP) -> Column:
    """Weighted share of rows where the predicate holds. A null predicate is a missing answer."""
    hit = F.when(predicate, F.lit(1.0)).when(~predicate, F.lit(0.0))
    return weighted_mean(hit, w, missing)


def ratio_of_totals(num: ColumnLike, den: ColumnLike, scale: float = 1.0, mask: bool = True) -> Column:
    """``scale * sum(num) / sum(den)``; the mask keeps rows with both present and a positive
    denominator."""
    num, den = col(num), col(den)
    if mask:
        ok = num.isNotNull() & den.isNotNull() & (den > 0)
        num, den = F.when(ok, num), F.when(ok, den)
    return ratio(F.sum(num), F.sum(den), scale)


def ratio_mean_with_denominator(v: ColumnLike, w: ColumnLike, factor: ColumnLike, periods: int = 4) -> Column:
    """Mean per calendar-year unit: ``sum(v w) / sum(factor w / periods)``."""
    return ratio(F.sum(col(v) * col(w)), calendar_population(w, factor, periods))


def calendar_population(w: ColumnLike, factor: ColumnLike, periods: int = 4) -> Column:
    return F.sum(col(factor) * col(w) / F.lit(float(periods)))


def reporters(v: ColumnLike) -> Column:
    """Number of positive amounts."""
    return F.count_if(col(v) > 0)


def unweighted(v: ColumnLike) -> dict[str, Column]:
    """Mean, sum, non-missing count and row count of one column."""
    v = col(v)
    return {"mean": F.avg(v), "total": F.sum(v), "n_present": F.count(v), "n": F.count(F.lit(1))}


def group_profile(w: ColumnLike) -> dict[str, Column]:
    return {"n": F.count(F.lit(1)), "weighted_n": F.sum(col(w))}


def group_sum(df: DataFrame, by: Sequence[str], v: str, out: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(v).alias(out))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def distinct_domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: null count and row count, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot(["__rows"], list(columns), "column", "n_missing").withColumnRenamed("__rows", "n_rows")


def reference_group(df: DataFrame, member: str, members: Sequence[str], v: str, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean, minimum and maximum over a named peer set."""
    peer = F.when(F.col(member).isin(*members), F.col(v))
    return estimate(df, by, peer_mean=F.avg(peer), peer_min=F.min(peer), peer_max=F.max(peer))


def group_ratio(df: DataFrame, group: str, a: str, b: str, v: str, by: Sequence[str] = ()) -> DataFrame:
    """One group's estimate over another's, and the difference in percent."""
    of = lambda g: F.max(F.when(F.col(group) == F.lit(g), F.col(v)))
    pair = estimate(df, by, a_value=of(a), b_value=of(b))
    r = ratio("a_value", "b_value")
    return pair.withColumns({"ratio": r, "percent_difference": (r - F.lit(1.0)) * F.lit(100.0)})


def population_rescale(df: DataFrame, w: str, implicate: str, m: int, by: Sequence[str] = ()) -> DataFrame:
    """Population totals when each weight is divided over ``m`` implicates: ``m`` times the mean
    implicate total. An implicate without rows in a group adds zero."""
    per = df.groupBy(*by, implicate).agg(F.sum(w).alias("__w"), F.count(F.lit(1)).alias("__n"))
    return per.groupBy(*by).agg(
        F.sum("__w").alias("weighted_n"),
        F.bround(F.sum("__n") / F.lit(float(m)), 0).cast("bigint").alias("unweighted_n"),
    )


def coverage_ratio(estimate_col: ColumnLike, periods: float, official: float) -> Column:
    """An annualised estimate over the published figure."""
    return col(estimate_col) * F.lit(float(periods)) / F.lit(float(official))


def two_series_gap(df: DataFrame, category: str, series: str, a: str, b: str, v: str) -> DataFrame:
    """Two series side by side per category, their absolute gap, and a flag on the widest."""
    wide = df.groupBy(category).agg(
        F.max(F.when(F.col(series) == F.lit(a), F.col(v))).alias("a_value"),
        F.max(F.when(F.col(series) == F.lit(b), F.col(v))).alias("b_value"),
    )
    gap = wide.withColumn("gap", F.abs(F.col("a_value") - F.col("b_value")))
    widest = gap.agg(F.max_by(category, F.struct("gap", category)).alias("__widest"))
    flagged = with_one_row(gap, widest)
    return flagged.withColumn("widest", F.col(category).eqNullSafe(F.col("__widest"))).drop("__widest")


def share_complement(df: DataFrame, keys: Sequence[str], v: str) -> DataFrame:
    """A share and its complement as two rows per key."""
    both = df.select(*keys, F.col(v).alias("share"), (F.lit(1.0) - F.col(v)).alias("complement"))
    return both.unpivot(list(keys), ["share", "complement"], "part", "value")
