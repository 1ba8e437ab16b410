"""Filters and column selection over whole frames."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import coerce_numeric
from .recode import all_of


def in_universe(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def between_closed(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def filter_codes(df: DataFrame, codes: Mapping[str, object]) -> DataFrame:
    """Keep rows that match every ``column: code`` pair."""
    return df.filter(all_of([F.col(c) == F.lit(v) for c, v in codes.items()]))


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def filter_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def exclude_codes(df: DataFrame, column: str, codes: Iterable | DataFrame) -> DataFrame:
    """Drop listed codes. A table of codes is anti-joined on its first column."""
    if isinstance(codes, DataFrame):
        listed = codes.select(F.col(codes.columns[0]).alias("__code")).distinct()
        return df.join(listed, F.col(column) == F.col("__code"), "left_anti")
    return df.filter(~F.col(column).isin(*codes))


def rename_and_cast(df: DataFrame, names: Mapping[str, str], numeric: Sequence[str] = ()) -> DataFrame:
    """Provider headers to library names, in mapping order, with numeric coercion."""
    renamed = df.select([F.col(f"`{old}`").alias(new) for old, new in names.items()])
    return coerce_numeric(renamed, numeric)


def weight_columns(df: DataFrame, prefix: str, count: int | None = None, start: int = 1) -> list[str]:
    """Columns ``PREFIX<number>`` in number order; leading zeros are allowed.

    With ``count`` the numbers must be exactly ``start .. start+count-1``.
    """
    found: dict[int, str] = {}
    for name in df.columns:
        match = re.fullmatch(re.escape(prefix) + r"(\d+)", name)
        if match:
            number = int(match.group(1))
            if number in found:
                raise ValueError(f"two columns carry replicate {number}: {found[number]}, {name}")
            found[number] = name
    if count is not None and sorted(found) != list(range(start, start + count)):
        raise ValueError(f"{prefix}: expected {count} numbered columns from {start}, found {len(found)}")
    return [found[number] for number in sorted(found)]


def weight_array(df: DataFrame, prefix: str, count: int | None = None, start: int = 1) -> Column:
    """The replicate columns of one family as one array column."""
    return F.array(*[F.col(c).cast("double") for c in weight_columns(df, prefix, count, start)])


def first_present(df: DataFrame, candidates: Sequence[str], case_sensitive: bool = False) -> str | None:
    """The first candidate the frame has, spelled as the frame spells it."""
    have = {c if case_sensitive else c.lower(): c for c in df.columns}
    for name in candidates:
        hit = have.get(name if case_sensitive else name.lower())
        if hit is not None:
            return hit
    return None
