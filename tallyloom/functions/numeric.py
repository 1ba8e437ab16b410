"""Numeric coercion and null-safe arithmetic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Spark's cast reads a trailing type letter ("1.0d"); survey files never mean that.
_TYPE_SUFFIX = r"[0-9.][dDfF]\s*$"


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: ColumnLike, finite: bool = False) -> Column:
    """Text to double. Unreadable text and NaN become null; infinities too if ``finite``."""
    text = col(c).cast("string")
    number = F.when(~text.rlike(_TYPE_SUFFIX), text.try_cast("double"))
    number = F.when(~F.isnan(number), number)
    if finite:
        number = F.when(F.abs(number) < F.lit(float("inf")), number)
    return number


def clean_number(c: ColumnLike) -> Column:
    """Double with NaN and infinities as null, for columns that are numeric already."""
    number = col(c).cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def coerce_numeric(df: DataFrame, columns: Iterable[str], finite: bool = False) -> DataFrame:
    """Replace the named columns by their numeric reading."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        name: clean_number(name)
        if isinstance(types[name], T.NumericType) and not finite
        else to_number(name, finite)
        for name in columns
    }
    return df.withColumns(changed)


def valid_weight(w: ColumnLike, allow_zero: bool = False) -> Column:
    """True where a weight is present, finite and positive (or non-negative); never null.

    A plain conjunction, so that as a filter its parts reach the Parquet scan.
    """
    w = col(w).cast("double")
    sign = (w >= 0) if allow_zero else (w > 0)
    return w.isNotNull() & sign & (w < F.lit(float("inf"))) & ~F.isnan(w)


def ratio(num: ColumnLike, den: ColumnLike, scale: float = 1.0) -> Column:
    """``scale * num / den``; null where the denominator is zero or null."""
    top = col(num) if scale == 1.0 else col(num) * F.lit(scale)
    return F.try_divide(top.cast("double"), col(den).cast("double"))


def flag_over(value: ColumnLike, threshold: float) -> Column:
    return col(value) > F.lit(threshold)


def relative_difference(a: ColumnLike, b: ColumnLike, floor: float = 1e-9) -> Column:
    """``|a - b| / max(|b|, floor)``."""
    return F.abs(col(a) - col(b)) / F.greatest(F.abs(col(b)), F.lit(floor))


def clamp(value: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    out = col(value)
    if low is not None:
        out = F.greatest(F.lit(low), out)
    if high is not None:
        out = F.least(F.lit(high), out)
    return out


def half_even(value: ColumnLike, digits: int = 0) -> Column:
    """Round half to even, the rounding of published result tables."""
    return F.bround(col(value), digits)
