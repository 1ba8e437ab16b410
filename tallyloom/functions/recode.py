"""Recodes, bands and derived survey columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import ColumnLike, col


def recode(c: ColumnLike, mapping: Mapping, default: str | None = None, keep: bool = False) -> Column:
    """Map codes to labels. Unmapped codes become null, ``default``, or stay if ``keep``."""
    c = col(c)
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    label = F.try_element_at(pairs, c)
    if keep:
        return F.coalesce(label, c)
    return label if default is None else F.coalesce(label, F.lit(default))


def recode_join(df: DataFrame, column: str, mapping: DataFrame, code: str, label: str) -> DataFrame:
    """The same for a mapping held as a table. Spark picks broadcast by its size."""
    side = mapping.select(F.col(code).alias("__code"), F.col(label))
    return df.join(side, F.col(column) == F.col("__code"), "left").drop("__code")


def band(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands; the lowest edge belongs to the first band."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per band is needed")
    c = col(c)
    inside = (c >= F.lit(edges[0])) & (c <= F.lit(edges[-1]))
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges[1:-1], labels[:-1]))):
        out = F.when(c <= F.lit(edge), F.lit(label)).otherwise(out)
    return F.when(inside, out)


def label_rank(c: ColumnLike, labels: Sequence[str], unknown: int = 99) -> Column:
    """Position of a label in its display order, unknown labels last."""
    at = F.array_position(F.array(*[F.lit(x) for x in labels]), col(c))
    return F.coalesce(F.nullif(at, F.lit(0)), F.lit(unknown)).cast("int")


def strip_prefix_int(c: ColumnLike, prefix: str) -> Column:
    """The number after a fixed prefix (``AW67`` gives 67); null for other codes."""
    rest = F.substring(col(c), len(prefix) + 1, 32)
    return F.when(col(c).startswith(prefix), rest.try_cast("int"))


def implicate_of(identifier: ColumnLike, base: int = 10) -> Column:
    return F.pmod(col(identifier), F.lit(base)).cast("int")


def calendar_factor(month: ColumnLike, year: ColumnLike, reference_year: int) -> Column:
    """Share of an interview's three recall months that fall in the reference year.

    The recall window is the three months before the interview month. Interviews early in
    the reference year lose the months before January; interviews in the next year keep only
    those up to December.
    """
    month, year = col(month), col(year)
    early = (year == F.lit(reference_year)) & month.isin(1, 2, 3)
    late = year == F.lit(reference_year + 1)
    return (
        F.when(early, (month - 1) / F.lit(3.0)).when(late, (4 - month) / F.lit(3.0)).otherwise(F.lit(1.0))
    )


def premium_adjusted_rate(
    rate: ColumnLike, base: ColumnLike, add_num: float, add_den: float
) -> Column:
    """A percentage rate after adding amounts to its numerator and its base."""
    amount = col(rate) / F.lit(100.0) * col(base)
    return F.try_divide(amount + F.lit(add_num), col(base) + F.lit(add_den)) * F.lit(100.0)


def product_weight(weights: ColumnLike, multiplicity: ColumnLike) -> Column:
    """Element-wise product of two arrays of equal length."""
    return F.zip_with(col(weights), col(multiplicity), lambda w, m: w * m)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
