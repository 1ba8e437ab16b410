"""Replicate-weight, bootstrap, multiple-imputation and analytic uncertainty.

Replicate 0 is the full sample. It travels in the same weight array as the replicates, so one
scan and one partial aggregation give the estimate and all its replicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import ColumnLike, clamp, col, ratio, valid_weight
from ..plans.scratch import spread
from .estimators import WeightedMean, weighted_mean
from .joins import with_one_row

Z90, Z95 = 1.645, 1.96

W, REPLICATE = "w", "replicate"


def to_replicates(
    df: DataFrame,
    weights: Sequence[str] | Column,
    keep: Sequence[str | Column],
    full: str | Column | None = None,
    positive_only: bool = False,
) -> DataFrame:
    """One row per input row and replicate: ``keep``, ``replicate`` and weight ``w``.

    Only ``keep`` and the weights survive to the explode. With ``full`` the full-sample weight
    is replicate 0. ``positive_only`` drops replicate rows without a positive weight, which is
    the half-sample rule; full-sample rows stay.
    """
    array = weights if isinstance(weights, Column) else F.array(*[F.col(c).cast("double") for c in weights])
    first = 1
    if full is not None:
        head = F.coalesce(col(full).cast("double"), F.lit(0.0))
        array, first = F.concat(F.array(head), array), 0
    narrow = spread(df.select(*keep, array.alias("__weights")))
    kept = [c for c in narrow.columns if c != "__weights"]
    long = narrow.select(*kept, F.posexplode("__weights").alias(REPLICATE, W))
    long = long.withColumn(REPLICATE, (F.col(REPLICATE) + F.lit(first)).cast("int"))
    if positive_only:
        long = long.filter((F.col(REPLICATE) == 0) | valid_weight(W))
    return long


def generated_replicates(
    df: DataFrame,
    count: int,
    weight_of: Callable[[Column], Column],
    keep: Sequence[str | Column],
    full: str | Column,
    positive_only: bool = False,
) -> DataFrame:
    """As ``to_replicates`` for weights given by a rule of the replicate number.

    The rule is an expression, so nothing wide is stored and the weights stay in generated code.
    """
    inputs = [c if isinstance(c, Column) else F.col(c) for c in keep]
    long = df.withColumn(REPLICATE, F.explode(F.sequence(F.lit(0), F.lit(count))))
    w = F.when(F.col(REPLICATE) == 0, col(full).cast("double")).otherwise(weight_of(F.col(REPLICATE)).cast("double"))
    out = long.select(*inputs, F.col(REPLICATE), w.alias(W))
    if positive_only:
        out = out.filter((F.col(REPLICATE) == 0) | valid_weight(W))
    return out


def replicate_estimates(long: DataFrame, by: Sequence[str] = (), **estimators: Column) -> DataFrame:
    """Any aggregate over ``w`` per group and replicate. Partial aggregation runs before the
    shuffle, so what moves is groups times replicates, not rows times replicates."""
    return long.groupBy(*by, REPLICATE).agg(*[c.alias(n) for n, c in estimators.items()])


def variance_scale(method: str, replicates: Column, rho: float = 0.5) -> Column:
    """Multiplier of the summed squared deviations for a replicate design; null where the
    replicates are too few."""
    if method == "sdr":
        return F.try_divide(F.lit(4.0), replicates)
    if method == "fay":
        return F.try_divide(F.lit(1.0 / (1.0 - rho) ** 2), replicates)
    if method in ("brr", "half_sample"):
        return F.try_divide(F.lit(1.0), replicates)
    if method == "bootstrap":
        return F.try_divide(F.lit(1.0), replicates - F.lit(1.0))
    raise ValueError(f"unknown replicate method {method}")


# Designs whose deviations are taken about the replicate mean.
MEAN_CENTERED = ("half_sample", "bootstrap")


def replicate_variance(
    estimates: DataFrame,
    name: str,
    method: str,
    by: Sequence[str] = (),
    rho: float = 0.5,
    center: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Estimate, standard error and replicate count per group. ``carry`` names further columns
    to take from the full-sample row.

    ``center`` is ``full`` or ``replicate_mean``; the default follows the method. The replicates
    of one group are as many as the design has, so they are held as one short sorted array and
    summed in replicate order, which makes the result the same on every run.
    """
    center = center or ("replicate_mean" if method in MEAN_CENTERED else "full")
    pairs = F.sort_array(
        F.collect_list(F.when((F.col(REPLICATE) > 0) & F.col(name).isNotNull(), F.struct(REPLICATE, name)))
    )
    table = estimates.groupBy(*by).agg(
        F.max(F.when(F.col(REPLICATE) == 0, F.col(name))).alias("estimate"),
        F.transform(pairs, lambda p: p[name].cast("double")).alias("__reps"),
        *[F.max(F.when(F.col(REPLICATE) == 0, F.col(c))).alias(c) for c in carry],
    )
    n = F.size("__reps").cast("double")
    if center == "full":
        about = F.col("estimate").cast("double")
    else:
        mean = F.try_divide(F.aggregate("__reps", F.lit(0.0), lambda a, x: a + x), n)
        table, about = table.withColumn("__about", mean), F.col("__about")
    squares = F.aggregate("__reps", F.lit(0.0), lambda a, x: a + (x - about) * (x - about))
    return table.select(
        *by,
        F.col("estimate").cast("double").alias("estimate"),
        F.sqrt(squares * variance_scale(method, n, rho)).alias("standard_error"),
        F.size("__reps").alias("replicates"),
        *carry,
    )


@dataclass(frozen=True)
class VectorRule:
    """The rule of a design for many rows and replicates at once.

    ``make`` takes each of ``inputs``, columns of numbers, as a numpy array of one column, and the replicate
    numbers as an array of one row, and returns the matrix of weights. A row that lacks an input has no replicate
    weight. ``make`` is sent to the workers by value, so it must be an inner function that uses plain values only.
    """

    inputs: tuple[Column, ...]
    make: Callable[..., np.ndarray]


#: Weights worked on at once by a task, which stay in a core's cache, and rows given back at once.
SLICE_CELLS, OUT_ROWS = 64 * 1024, 64 * 1024


def vector_sums(
    df: DataFrame, terms: Sequence[Column], full: Column, rule: VectorRule, count: int, by: Sequence[str]
) -> DataFrame:
    """``by``, ``replicate`` and the weighted sums ``__s0, __s1, ...`` of ``terms``, for the full sample and all replicates.

    Each batch of rows gives one row per group and replicate, from a matrix product of values and weights; input
    rows are neither multiplied nor shuffled. A sum without a present value and weight is null.
    """
    n_by, n_terms, width, cells, out_rows, make = len(by), len(terms), count + 1, SLICE_CELLS, OUT_ROWS, rule.make

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(1, width, dtype=np.int64)[None, :]
        step = max(1, cells // width)
        at_once = max(1, out_rows // width)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            code = np.zeros(batch.num_rows, dtype=np.int64)
            for i in range(n_by):
                keys = batch.column(i).dictionary_encode(null_encoding="encode")
                code = np.unique(code * len(keys.dictionary) + keys.indices.to_numpy(), return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            ends = np.append(starts[1:], len(order))
            rest = [batch.column(i) for i in range(n_by, batch.num_columns)]
            valid = [c.is_valid().to_numpy(zero_copy_only=False)[order] for c in rest]
            plain = [c.fill_null(0).to_numpy(zero_copy_only=False)[order] for c in rest]
            has_value, values = valid[:n_terms], plain[:n_terms]
            whole, inputs = plain[n_terms], plain[n_terms + 1 :]
            weighted = np.logical_and.reduce(valid[n_terms + 1 :])
            for first in range(0, len(starts), at_once):
                groups = range(first, min(first + at_once, len(starts)))
                sums = np.zeros((n_terms, len(groups), width))
                absent = np.ones((n_terms, len(groups), width), dtype=bool)
                for g in groups:
                    for low in range(starts[g], ends[g], step):
                        here = slice(low, min(low + step, ends[g]))
                        weights = make(*[a[here, None] for a in inputs], numbers)
                        for t in range(n_terms):
                            some, v = has_value[t][here], values[t][here]
                            if some.any():
                                sums[t, g - first, 0] += v[some] @ whole[here][some]
                                absent[t, g - first, 0] = False
                            both = some & weighted[here]
                            if both.any():
                                sums[t, g - first, 1:] += v @ weights if both.all() else v[both] @ weights[both]
                                absent[t, g - first, 1:] = False
                picked = pa.array(np.repeat(order[starts[groups.start : groups.stop]], width))
                columns = [batch.column(i).take(picked) for i in range(n_by)]
                columns.append(pa.array(np.tile(np.arange(width, dtype=np.int32), len(groups))))
                columns += [pa.array(sums[t].ravel(), mask=absent[t].ravel()) for t in range(n_terms)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = spread(df).select(
        *by,
        *[x.cast("double").alias(f"__x{t}") for t, x in enumerate(terms)],
        full.alias("__full"),
        *[c.alias(f"__in{i}") for i, c in enumerate(rule.inputs)],
    )
    fields = [*narrow.schema.fields[:n_by], T.StructField(REPLICATE, T.IntegerType())]
    fields += [T.StructField(f"__s{t}", T.DoubleType()) for t in range(n_terms)]
    names = [f.name for f in fields]
    partial = narrow.mapInArrow(add_up, T.StructType(fields))
    return partial.groupBy(*by, REPLICATE).agg(*[F.sum(f"__s{t}").alias(f"__s{t}") for t in range(n_terms)])


# Replicates per aggregation row. Eight keep the generated loop below the size that the JVM
# compiles; measured at 160 replicates this is three times faster than one row per replicate.
BLOCK = 8


@dataclass(frozen=True)
class Replicates:
    """A replicate design: the full-sample weight, and the replicate weights either as stored
    columns (names or an array column) or as a rule of the replicate number. ``vector`` states the
    same rule in numpy."""

    full: str
    method: str
    weights: Sequence[str] | Column | None = None
    rule: Callable[[Column], Column] | None = None
    count: int = 0
    rho: float = 0.5
    vector: VectorRule | None = None

    def replicates(self) -> int:
        if self.rule is not None or isinstance(self.weights, Column):
            return self.count
        return len(self.weights)

    def long(self, df: DataFrame, keep: Sequence[str | Column]) -> DataFrame:
        """One row per input row and replicate, for estimators that need rows."""
        half = self.method == "half_sample"
        if self.rule is not None:
            return generated_replicates(df, self.count, self.rule, keep, self.full, half)
        return to_replicates(df, self.weights, keep, self.full, half)

    def _in_matrices(self, df: DataFrame, estimator: Callable[[Column], Column], by: Sequence[str]) -> bool:
        """Half samples drop single weights, and nested keys have no codes in a batch: these take rows."""
        if self.vector is None or self.method == "half_sample" or not isinstance(estimator, WeightedMean):
            return False
        nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
        return not any(isinstance(f.dataType, nested) for f in df.select(*by).schema.fields)

    def table(
        self,
        df: DataFrame,
        estimator: Callable[[Column], Column],
        by: Sequence[str],
        keep: Sequence[str],
        **carry: Callable[[Column], Column],
    ) -> DataFrame:
        """``by``, ``replicate``, ``value`` and carried aggregates for the full sample (replicate 0)
        and every replicate, from one scan.

        ``estimator`` makes an aggregate from a weight column; rows outside a replicate reach it
        with a null weight. With a vector rule a weighted mean takes its sums from matrix products.
        Otherwise a row is multiplied by the number of blocks, and partial aggregation
        brings that down to groups times blocks before anything is shuffled.
        """
        count = self.replicates()
        if count < 1:
            raise ValueError("a design over an array or a rule needs its replicate count")
        names = list(dict.fromkeys([*by, *keep]))
        full = F.coalesce(F.col(self.full).cast("double"), F.lit(0.0))
        if self._in_matrices(df, estimator, by) and not carry:
            sums = vector_sums(df, estimator.terms(), full, self.vector, count, by)
            value = estimator.from_sums(*[F.col(f"__s{t}") for t in range(len(estimator.terms()))])
            return sums.select(*by, REPLICATE, value.cast("double").alias("value"))
        if self.rule is not None:
            rows = spread(df)
        elif isinstance(self.weights, Column):
            rows = df.select(*names, F.concat(F.array(full), self.weights).alias("__weights"))
        else:
            stored = [F.col(c).cast("double") for c in self.weights]
            rows = df.select(*names, F.array(full, *stored).alias("__weights"))
        blocks = -(-(count + 1) // BLOCK)
        rows = rows.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

        def weight(j: int) -> Column:
            r = F.col("__block") * F.lit(BLOCK) + F.lit(j)
            if self.rule is not None:
                w = F.when(r == 0, full).when(r <= F.lit(count), self.rule(r).cast("double"))
            else:
                w = F.get("__weights", r)
            return F.when((r == 0) | valid_weight(w), w) if self.method == "half_sample" else w

        wide = rows.select(*names, "__block", *[weight(j).alias(f"__w{j}") for j in range(BLOCK)])
        sums = wide.groupBy(*by, "__block").agg(
            *[estimator(F.col(f"__w{j}")).cast("double").alias(f"__v{j}") for j in range(BLOCK)],
            *[make(F.col("__w0")).alias(name) for name, make in carry.items()],
        )
        values = F.array(*[F.col(f"__v{j}") for j in range(BLOCK)])
        long = sums.select(*by, "__block", *carry, F.posexplode(values).alias("__at", "value"))
        replicate = (F.col("__block") * F.lit(BLOCK) + F.col("__at")).cast("int")
        return long.select(*by, replicate.alias(REPLICATE), "value", *carry).filter(F.col(REPLICATE) <= count)

    def estimate(
        self,
        df: DataFrame,
        estimator: Callable[[Column], Column],
        by: Sequence[str],
        keep: Sequence[str],
        **carry: Callable[[Column], Column],
    ) -> DataFrame:
        """Estimate and standard error per group, with other full-sample aggregates carried
        along. One scan and two shuffles of aggregated rows."""
        table = self.table(df, estimator, by, keep, **carry)
        return replicate_variance(table, "value", self.method, by, self.rho, carry=list(carry))


def combine_imputations(
    implicate_estimates: DataFrame,
    sampling_variance: DataFrame,
    name: str,
    m: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean over implicates; total variance is sampling + (1 + 1/m) * between-implicate.

    ``sampling_variance`` has ``by`` and ``variance``. Both sides are one row per group after
    aggregation.
    """
    between = implicate_estimates.groupBy(*by).agg(
        F.avg(name).alias("estimate"), F.var_samp(name).alias("imputation_variance")
    )
    if by:
        joined = between.join(sampling_variance, list(by), "left")
    else:
        joined = with_one_row(between, sampling_variance)
    total = F.col("variance") + F.lit(1.0 + 1.0 / m) * F.col("imputation_variance")
    return joined.select(
        *by,
        "estimate",
        "imputation_variance",
        F.col("variance").alias("sampling_variance"),
        F.sqrt(total).alias("standard_error"),
    )


def linearized_se(df: DataFrame, v: str, w: str, by: Sequence[str] = ()) -> DataFrame:
    """Weighted mean and its linearised standard error ``sqrt(sum((w (v - mean))^2)) / sum(w)``.

    Deviations are first taken from the overall mean, one number from a first pass, and moved to
    each group's own mean inside the aggregate. Rows are never joined to their group's mean, so
    none are shuffled; the shift keeps the subtraction from losing digits.
    """
    filled = df.select(
        *by,
        F.coalesce(F.col(v), F.lit(0)).cast("double").alias("__v"),
        F.coalesce(F.col(w), F.lit(0)).cast("double").alias("__w"),
    )
    center = F.coalesce(filled.agg(weighted_mean("__v", "__w")).scalar(), F.lit(0.0))
    shifted = filled.withColumn("__c", center).withColumn("__d", F.col("__v") - F.col("__c"))
    d, u = F.col("__d"), F.col("__w") * F.col("__w")
    sums = shifted.groupBy(*by).agg(
        F.max("__c").alias("__c"),
        F.sum("__w").alias("weighted_n"),
        F.count(F.lit(1)).alias("n"),
        ratio(F.sum(F.col("__w") * d), F.sum("__w")).alias("__delta"),
        F.sum(u * d * d).alias("__uu"),
        F.sum(u * d).alias("__ud"),
        F.sum(u).alias("__u"),
    )
    delta = F.col("__delta")
    squares = F.col("__uu") - F.lit(2.0) * delta * F.col("__ud") + delta * delta * F.col("__u")
    return sums.select(
        *by,
        (F.col("__c") + delta).alias("estimate"),
        ratio(F.sqrt(F.greatest(squares, F.lit(0.0))), "weighted_n").alias("standard_error"),
        "n",
        "weighted_n",
    )


def binomial_se(p: ColumnLike, n: ColumnLike) -> Column:
    """``sqrt(p (1 - p) / n)`` with the unweighted count."""
    return F.sqrt(F.try_divide(col(p) * (F.lit(1.0) - col(p)), col(n).cast("double")))


def normal_ci(
    est: ColumnLike, se: ColumnLike, z: float = Z95, low: float | None = None, high: float | None = None
) -> tuple[Column, Column]:
    """Lower and upper bound, clamped only at the outer side of each."""
    half = F.lit(z) * col(se)
    return clamp(col(est) - half, low=low), clamp(col(est) + half, high=high)


def with_ci(df: DataFrame, z: float = Z95, low: float | None = None, high: float | None = None) -> DataFrame:
    lo, hi = normal_ci("estimate", "standard_error", z, low, high)
    return df.withColumns({"ci_low": lo, "ci_high": hi})


def margin_of_error(se: ColumnLike, z: float = Z90) -> Column:
    return F.lit(z) * col(se)
