"""Join shapes of survey releases. No broadcast hints: Spark picks by measured size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def attach_totals(parent: DataFrame, child: DataFrame, key: str | Sequence[str], amount: str, out: str) -> DataFrame:
    """Sum a child amount per key and left-join it; parents without children get 0.

    The child shrinks to one row per key before the join, so a key with very many child rows
    reaches the join as one row.
    """
    keys = _keys(key)
    totals = child.groupBy(*keys).agg(F.sum(amount).alias("__total"))
    joined = parent.join(totals, keys, "left")
    return joined.select(*parent.columns, F.coalesce(F.col("__total"), F.lit(0.0)).alias(out))


def attach_replicates(df: DataFrame, replicates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join that should stay one-to-one; ``one_to_one`` reports whether it did."""
    return df.join(replicates, _keys(key), "inner")


def one_to_one(df: DataFrame, replicates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: key counts on each side, matches and repeated keys."""
    keys = _keys(key)
    left = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l"))
    right = replicates.groupBy(*keys).agg(F.count(F.lit(1)).alias("__r"))
    both = left.join(right, keys, "full_outer")
    return both.agg(
        F.coalesce(F.sum("__l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("__r"), F.lit(0)).alias("right_rows"),
        F.count_if((F.col("__l") == 1) & (F.col("__r") == 1)).alias("matched_keys"),
        F.count_if((F.col("__l") > 1) | (F.col("__r") > 1)).alias("repeated_keys"),
        F.count_if(F.col("__l").isNull() | F.col("__r").isNull()).alias("unmatched_keys"),
    )


def measure_self_join(
    df: DataFrame, measure: str, a: str, b: str, keys: str | Sequence[str], value: str, a_out: str, b_out: str
) -> DataFrame:
    """Rows of measure ``a`` with the value of measure ``b`` on the same dimensions.

    One conditional aggregation instead of a join of the table with itself.
    """
    keys = _keys(keys)
    pick = lambda m: F.max(F.when(F.col(measure) == F.lit(m), F.col(value)))
    has_a = F.count_if(F.col(measure) == F.lit(a))
    wide = (
        df.filter(F.col(measure).isin(a, b))
        .groupBy(*keys)
        .agg(has_a.alias("__n"), pick(a).alias(a_out), pick(b).alias(b_out))
    )
    return wide.filter(F.col("__n") > 0).drop("__n")


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent."""
    # Distinct first: a key held by very many parents reaches the join as one row.
    side = parent.select(F.col(parent_key or child_key).alias("__parent")).distinct()
    return child.join(side, F.col(child_key) == F.col("__parent"), "left_anti")


def key_set_match(a: DataFrame, b: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: keys only in ``a``, only in ``b`` and in both."""
    keys = _keys(keys)
    left = a.select(*keys).distinct().withColumn("__a", F.lit(1))
    right = b.select(*keys).distinct().withColumn("__b", F.lit(1))
    both = left.join(right, keys, "full_outer")
    return both.agg(
        F.count_if(F.col("__b").isNull()).alias("only_a"),
        F.count_if(F.col("__a").isNull()).alias("only_b"),
        F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("in_both"),
    )


def value_match_join(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], x: str, y: str, tolerance: float = 0.0
) -> DataFrame:
    """One row: matched keys, keys outside the tolerance, largest difference and both sums.

    Each side is reduced to one row per key with its extremes, so a repeated key is compared in
    full without forming its pairs.
    """
    keys = _keys(keys)

    def side(df: DataFrame, c: str, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.min(c).alias(f"__{tag}lo"),
            F.max(c).alias(f"__{tag}hi"),
            F.sum(c).alias(f"__{tag}sum"),
            F.count_if(F.col(c).isNull()).alias(f"__{tag}null"),
        )

    joined = side(a, x, "x").join(side(b, y, "y"), keys)
    gap = F.greatest(F.abs(F.col("__xhi") - F.col("__ylo")), F.abs(F.col("__yhi") - F.col("__xlo")))
    absent = (F.col("__xnull") > 0) | (F.col("__ynull") > 0)
    off = F.coalesce(gap > F.lit(tolerance), F.lit(True)) | absent
    return joined.agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(off).alias("mismatched"),
        F.max(gap).alias("largest_gap"),
        F.sum("__xsum").alias("sum_x"),
        F.sum("__ysum").alias("sum_y"),
    )


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row as a scalar subquery: it is computed once
    and enters the plan as a value, so nothing is joined. A second row fails the query."""
    value = one_row.select(F.struct(*one_row.columns).alias("__one")).scalar()
    return df.withColumn("__one", value).select(*df.columns, *[F.col(f"__one.{c}") for c in one_row.columns])


def cross_source_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side."""
    return with_one_row(a, b)


def missing_years(available: DataFrame, promoted: DataFrame, done: DataFrame, keys: Sequence[str] = ("survey", "year")) -> DataFrame:
    """Available releases that are neither promoted nor already worked off."""
    keys = list(keys)
    worked = promoted.select(*keys).unionByName(done.select(*keys)).distinct()
    return available.join(worked, keys, "left_anti")


def pointer_mismatches(
    pointers: DataFrame,
    releases: DataFrame,
    key: str = "digest",
    fields: Sequence[str] = ("survey", "year", "release_id", "digest"),
) -> DataFrame:
    """Pointer rows joined to the ledger row they name; one row per pointer with the names of
    the fields that differ, and ``found`` false where the target is no ledger row."""
    side = releases.select(*[F.col(f).alias(f"__{f}") for f in dict.fromkeys([*fields, key])]).distinct()
    joined = pointers.join(side, F.col(key) == F.col(f"__{key}"), "left")
    found = F.col(f"__{key}").isNotNull()
    bad = [F.when(found & ~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in fields]
    return joined.select(
        *pointers.columns, found.alias("found"), F.concat_ws(",", *bad).alias("mismatched_fields")
    )


# How a data column names a region.
REGION_FORMATS = ("name", "postal", "fips")


def attach_region(df: DataFrame, regions: DataFrame, key: str, form: str = "name") -> DataFrame:
    """Regions left-joined to data by name, postal code (both case-insensitive) or two-digit
    code. A region without data stays, with nulls."""
    if form not in REGION_FORMATS:
        raise ValueError(f"form must be one of {REGION_FORMATS}")
    if form == "fips":
        norm = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    else:
        norm = lambda c: F.lower(F.trim(F.col(c)))
    data = df.withColumn("__key", norm(key)).drop(key)
    matched = regions.join(data, norm(form) == F.col("__key"), "inner").drop("__key")
    # Regions without data are found on distinct keys. One left join from the region side would
    # hold all rows of a frequent region in one task.
    absent = regions.join(data.select("__key").distinct(), norm(form) == F.col("__key"), "left_anti")
    return matched.unionByName(absent, allowMissingColumns=True)


def same_on(a: str, b: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of two aliases on several columns."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])
