"""Quantile-group means recomputed inside every replicate.

The order of rows is the same in every replicate; only the weights differ. So rows are cut into
ranges once and stored in buckets of them. A first pass adds up one vector of replicate sums per range;
the second adds up each range's part of every replicate in slices that carry the sums reached. Rows are
shuffled once, by the cut, and never multiplied by the number of replicates. Weights given by an expression
are made from the stored rows in each pass, so what is shuffled and stored is as narrow as their inputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..plans.ranges import RANGE, cut_ranges
from ..plans.scratch import MAX_RANGES
from .ordering import has_value
from .uncertainty import REPLICATE

ORDER, TIE, VALUE, WEIGHTS = "__order", "__tie", "__value", "__weights"
#: One range holds about this much of weights; a slice of it is worked on at once.
RANGE_BYTES = 32 * 1024 * 1024
SLICE_ROWS = 2048


def replicate_quantile_group_means(
    df: DataFrame,
    order: str,
    value: str,
    tie: str,
    weights: Sequence[str] | Column,
    k: int,
    ranges: int | None = None,
) -> DataFrame:
    """Weighted mean, weight and row count per replicate and weight-midpoint group of ``order``.

    A row takes part in a replicate when its weight there is present and positive. ``weights`` are
    columns, or an array by a deterministic expression; all columns of ``df`` are stored with the ranges.
    """
    array = weights if isinstance(weights, Column) else F.array(*[F.col(c).cast("double") for c in weights])
    rows = df.filter(has_value(order) & has_value(value)).select(
        "*",
        F.col(order).cast("double").alias(ORDER),
        F.col(tie).alias(TIE),
        F.col(value).cast("double").alias(VALUE),
    )
    sums = _by_range(rows, array, k, ranges)
    return sums.select(
        REPLICATE,
        "quantile_group",
        ratio("sum_wv", "sum_w").alias("mean"),
        F.col("sum_w").alias("weighted_n"),
        "n",
    )


def _width(rows: DataFrame, array: Column) -> tuple[int, int]:
    """Number of rows and of replicates, which is the length of every array."""
    size = rows.select(array.alias(WEIGHTS)).filter(F.col(WEIGHTS).isNotNull()).select(F.size(WEIGHTS)).first()
    return rows.count(), size[0] if size else 0


def _by_range(rows: DataFrame, array: Column, k: int, ranges: int | None) -> DataFrame:
    number, width = _width(rows, array)
    floor = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = ranges or max(floor, min(MAX_RANGES, -(-number * (width + 3) * 8 // RANGE_BYTES)))
    cut = cut_ranges(rows, ORDER, [TIE], ranges=n_ranges)
    cut = cut.select(RANGE, ORDER, TIE, VALUE, array.alias(WEIGHTS))

    # Plain values only: the functions are sent to the workers, which need not have this package.
    range_, order, tie, value, weights, slice_rows = RANGE, ORDER, TIE, VALUE, WEIGHTS, SLICE_ROWS

    def vector_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One array of replicate sums per range and task."""

        def rows_of(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
            arrays = [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(arrays, names=["range", "sums"])

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            numbers = batch.column(0).to_numpy()
            for at in range(0, len(numbers), slice_rows):
                here = numbers[at : at + slice_rows]
                flat = batch.column(1).slice(at, slice_rows).flatten().to_numpy(zero_copy_only=False)
                matrix = flat.astype(float).reshape(len(here), width)
                matrix = np.where(np.isfinite(matrix) & (matrix > 0), matrix, 0.0)
                for r in np.unique(here):
                    sums[int(r)] = sums.get(int(r), 0.0) + matrix[here == r].sum(axis=0)
            if len(sums) > 64:
                yield rows_of(sums)
                sums = {}
        if sums:
            yield rows_of(sums)

    vectors = cut.select(range_, weights).mapInArrow(vector_sums, f"{range_} int, sums array<double>")
    per_range = (
        vectors.select(range_, F.posexplode("sums").alias("__at", "__s"))
        .groupBy(range_, (F.col("__at") + 1).alias(REPLICATE))
        .agg(F.sum("__s").alias("__sum"))
    )
    replicate = Window.partitionBy(REPLICATE)
    earlier = replicate.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        range_,
        REPLICATE,
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0.0)).alias("__before"),
        F.sum("__sum").over(replicate).alias("__total"),
    )

    def add_up(data: pa.Table, shift: pa.Table) -> pa.Table:
        """Slices of the range in order; the sums reached are carried from slice to slice."""
        names = ["replicate", "quantile_group", "sum_wv", "sum_w", "n"]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
        data = data.filter(data[weights].is_valid())
        if data.num_rows == 0 or shift.num_rows == 0:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        place = shift["replicate"].to_numpy() - 1
        reached, total = np.zeros(width), np.zeros(width)
        reached[place], total[place] = shift["__before"].to_numpy(), shift["__total"].to_numpy()
        data = data.select([order, tie, value, weights]).sort_by([(order, "ascending"), (tie, "ascending")])
        cells = width * k
        sum_wv, sum_w, n = np.zeros(cells), np.zeros(cells), np.zeros(cells, dtype=np.int64)
        for at in range(0, data.num_rows, slice_rows):
            piece = data.slice(at, slice_rows).combine_chunks()
            v = piece[value].to_numpy()
            flat = piece[weights].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            w = flat.astype(float).reshape(len(v), width)
            w = np.where(np.isfinite(w) & (w > 0), w, 0.0)
            upto = reached + np.cumsum(w, axis=0)
            middle = (upto - w / 2.0) / np.where(total > 0, total, 1.0)
            group = np.minimum(k - 1, np.floor(middle * k)).astype(np.int64)
            cell = (group + np.arange(width) * k).ravel()
            sum_wv += np.bincount(cell, (w * v[:, None]).ravel(), cells)
            sum_w += np.bincount(cell, w.ravel(), cells)
            n += np.bincount(cell, (w > 0).ravel(), cells).astype(np.int64)
            reached = upto[-1]
        some = np.flatnonzero(n)
        columns = [some // k + 1, some % k + 1, sum_wv[some], sum_w[some], n[some]]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    schema = "replicate int, quantile_group int, sum_wv double, sum_w double, n long"
    partial = cut.groupBy(range_).cogroup(offsets.groupBy(range_)).applyInArrow(add_up, schema)
    return partial.groupBy(REPLICATE, "quantile_group").agg(
        F.sum("sum_wv").alias("sum_wv"), F.sum("sum_w").alias("sum_w"), F.sum("n").alias("n")
    )
