"""Estimators on closed-form fixtures, and the range form against skewed input."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import estimators as E
from tallyloom.operators import ordering, uncertainty
from tallyloom.operators.replicate_groups import replicate_quantile_group_means
from tallyloom.operators.uncertainty import Replicates


@pytest.fixture(scope="module")
def households(spark):
    rows = [("1", 10.0, 11.0, 9.0, 1.0), ("1", 20.0, 18.0, 23.0, 0.0), ("2", 30.0, 33.0, 27.0, 1.0)]
    return spark.createDataFrame(rows, "g string, w double, r1 double, r2 double, v double")


def estimate(df, method, **kw):
    design = Replicates("w", method, weights=["r1", "r2"], **kw)
    rows = design.estimate(df, lambda w: E.weighted_mean("v", w), ["g"], ["v"], n=lambda w: F.count(F.lit(1)))
    return {r["g"]: r for r in rows.collect()}


def test_replicate_variances(households):
    full, reps = 10 / 30, [11 / 29, 9 / 32]
    squares = sum((x - full) ** 2 for x in reps)
    for method, scale in (("sdr", 4 / 2), ("fay", 1 / (2 * 0.25)), ("brr", 1 / 2)):
        row = estimate(households, method)["1"]
        assert row["estimate"] == pytest.approx(full)
        assert row["standard_error"] == pytest.approx(math.sqrt(scale * squares))
        assert (row["replicates"], row["n"]) == (2, 2)
    mean = sum(reps) / 2
    boot = estimate(households, "bootstrap")["1"]["standard_error"]
    assert boot == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in reps)))


def test_half_sample_ignores_absent_weights(spark):
    rows = [(1.0, 2.0, None, 1.0), (1.0, None, 2.0, 0.0), (2.0, 4.0, None, 0.0)]
    df = spark.createDataFrame([("a", *r) for r in rows], "g string, w double, r1 double, r2 double, v double")
    row = estimate(df, "half_sample")["a"]
    reps = [2 / 6, 0.0]
    assert row["standard_error"] == pytest.approx(abs(reps[0] - reps[1]) / 2)


def test_many_replicates_cross_block_borders(spark):
    """Nineteen replicates fill two blocks and part of a third."""
    rows = [(float(i % 5 + 1), float(i % 3), [float((i * r) % 7 + 1) for r in range(1, 20)]) for i in range(200)]
    df = spark.createDataFrame(rows, "w double, v double, ws array<double>")
    design = Replicates("w", "brr", weights=F.col("ws"), count=19)
    got = design.table(df, lambda w: E.weighted_mean("v", w), [], ["v"]).orderBy("replicate").collect()
    assert [r["replicate"] for r in got] == list(range(20))
    for r in got:
        weights = [row[0] if r["replicate"] == 0 else row[2][r["replicate"] - 1] for row in rows]
        want = sum(w * row[1] for w, row in zip(weights, rows)) / sum(weights)
        assert r["value"] == pytest.approx(want)


def test_imputation_rule(spark):
    per = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,)], "mean double")
    sampling = spark.createDataFrame([(0.5,)], "variance double")
    row = uncertainty.combine_imputations(per, sampling, "mean", 5).first()
    assert row["estimate"] == 3.0
    assert row["standard_error"] == pytest.approx(math.sqrt(0.5 + 1.2 * 2.5))


def test_linearized_se_far_from_zero(spark):
    """A large offset must not eat the digits of the deviations."""
    values = [1e9 + x for x in (0.0, 1.0, 2.0, 5.0)]
    df = spark.createDataFrame([("a", v, 1.0 + i) for i, v in enumerate(values)], "g string, v double, w double")
    row = uncertainty.linearized_se(df, "v", "w", ["g"]).first()
    mu = sum(v * (1 + i) for i, v in enumerate(values)) / 10
    se = math.sqrt(sum(((1 + i) * (v - mu)) ** 2 for i, v in enumerate(values))) / 10
    assert row["standard_error"] == pytest.approx(se, rel=1e-6)


def test_weighted_mean_conventions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 3.0)], "v double, w double")
    row = df.agg(E.weighted_mean("v", "w").alias("keep"), E.weighted_mean("v", "w", E.DROP).alias("drop")).first()
    assert (row["keep"], row["drop"]) == (0.25, 1.0)


def test_weighted_quantile_takes_first_value_reaching_the_share(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 2.0)], "v double, w double")
    assert ordering.weighted_quantile(df, "v", "w", 0.5).first()[0] == 2.0
    assert ordering.weighted_quantile(df, "v", "w", 0.51).first()[0] == 3.0


def test_missing_values_take_no_part_in_quantiles(spark):
    rows = [(1.0, 1.0), (3.0, 1.0), (float("nan"), 5.0), (None, 5.0), (2.0, float("nan"))]
    df = spark.createDataFrame(rows, "v double, w double")
    assert ordering.weighted_quantile(df, "v", "w", 0.5).first()[0] == 1.0
    assert ordering.median_unweighted(df, "v").first()[0] == 2.0


def test_group_policies_differ_on_the_edge(spark):
    df = spark.createDataFrame([(float(i), 1.0, i) for i in range(1, 6)], "v double, w double, k int")
    mid = ordering.quantile_groups_midpoint(df, "v", "w", "k", 5).orderBy("k").collect()
    edge = ordering.quantile_groups_right_edge(df, "v", "w", "k").orderBy("k").collect()
    assert [r["quantile_group"] for r in mid] == [1, 2, 3, 4, 5]
    assert [r["quantile_group"] for r in edge] == [2, 3, 4, 5, 5]


def skewed(spark, n=4000):
    """One group holds most rows, and one value holds most of that group."""
    k = F.col("id")
    return spark.range(n).select(
        F.when(k % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), k % 5)).alias("g"),
        F.when(k % 3 > 0, F.lit(0.0)).otherwise(k % 101).cast("double").alias("v"),
        (1 + k % 4).cast("double").alias("w"),
        k.alias("k"),
    )


def summed_by_window(df):
    """The running weight stated by one sorted window per group."""
    group = Window.partitionBy("g")
    so_far = group.orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("g", "v", "w", "k", F.sum("w").over(so_far).alias("cum_weight"), F.sum("w").over(group).alias("total_weight"))


def test_ranged_running_total_equals_window_under_skew(spark):
    df = skewed(spark)
    a = summed_by_window(df)
    b = ordering.cumulative_weight(df, "w", "v", "k", ["g"], ranges=13).select(*a.columns)
    assert a.count() == b.count() == 4000
    assert a.exceptAll(b).count() == 0


def test_ranges_split_a_hot_group_and_value(spark):
    from tallyloom.plans.ranges import RANGE, cut_ranges

    cut = cut_ranges(skewed(spark), "v", ["k"], ["g"], ranges=13)
    sizes = [r["count"] for r in cut.groupBy(RANGE).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 4000 / 13


def test_ranged_keeps_null_groups_and_null_order(spark):
    df = spark.createDataFrame(
        [(None, 1.0, 1.0, 1), (None, None, 2.0, 2), ("a", 3.0, 4.0, 3)], "g string, v double, w double, k int"
    )
    got = ordering.cumulative_weight(df, "w", "v", "k", ["g"], ranges=3).orderBy("k").collect()
    assert [(r["cum_weight"], r["total_weight"]) for r in got] == [(1.0, 3.0), (3.0, 3.0), (4.0, 4.0)]


def test_ranged_quantiles_and_median_under_skew(spark):
    df = skewed(spark)
    for q in (0.1, 0.5, 0.9):
        reached = summed_by_window(df).filter(F.col("cum_weight") >= F.lit(q) * F.col("total_weight"))
        a = reached.groupBy("g").agg(F.min("v").alias("quantile"))
        b = ordering.weighted_quantile(df, "v", "w", q, ["g"]).select("g", "quantile")
        assert a.exceptAll(b).count() == 0
    exact = df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("median"))
    assert ordering.median_unweighted(df, "v", ["g"]).exceptAll(exact).count() == 0


def test_replicate_groups_agree_across_plans(spark):
    weights = F.array(*[F.when(F.col("k") % r != 0, ((F.col("k") * r) % 5).cast("double")) for r in (2, 3, 7)])
    df = skewed(spark).withColumn("b", F.col("k") % 17)
    a = replicate_quantile_group_means(df, "v", "b", "k", weights, 10, ranges=1)
    b = replicate_quantile_group_means(df, "v", "b", "k", weights, 10, ranges=9)
    keys = ["replicate", "quantile_group"]
    joined = a.join(b.select(*keys, F.col("mean").alias("m2"), F.col("n").alias("n2")), keys, "full_outer")
    bad = joined.filter(~F.col("n").eqNullSafe(F.col("n2")) | (F.abs(F.col("mean") - F.col("m2")) > 1e-9))
    assert bad.count() == 0 and a.count() == b.count() > 0


def test_replicate_groups_with_many_replicates_and_slices(spark, monkeypatch):
    """Against numpy over all rows at once: hundreds of replicates, missing weights, several slices a range."""
    import numpy as np

    from tallyloom.operators import replicate_groups

    monkeypatch.setattr(replicate_groups, "SLICE_ROWS", 100)
    width, k = 300, 7
    df = spark.range(2500).select(
        "id", ((F.col("id") * 37) % 50).cast("double").alias("v"), (F.col("id") % 11).cast("double").alias("b"),
        F.array(*[F.when((F.col("id") + r) % 9 != 0, ((F.col("id") * r) % 4).cast("double")) for r in range(1, width + 1)]).alias("ws"),
    )
    df = df.union(spark.createDataFrame([(9999, 1.0, 1.0, None), (9998, None, 1.0, [1.0] * width)], "id long, v double, b double, ws array<double>"))
    got = replicate_groups.replicate_quantile_group_means(df, "v", "b", "id", F.col("ws"), k, ranges=6)
    got = {(r["replicate"], r["quantile_group"]): (r["mean"], r["weighted_n"], r["n"]) for r in got.collect()}
    want = {}
    ids = np.array(sorted(range(2500), key=lambda i: ((i * 37) % 50, i)))
    for r in range(1, width + 1):
        w = np.where((ids + r) % 9 != 0, (ids * r) % 4, 0).astype(float)
        i, w = ids[w > 0], w[w > 0]
        if len(w) == 0:
            continue
        group = np.minimum(k, np.floor((np.cumsum(w) - w / 2) / w.sum() * k) + 1).astype(int)
        for g in np.unique(group):
            here = group == g
            want[r, int(g)] = (np.average(i[here] % 11, weights=w[here]), w[here].sum(), here.sum())
    assert got.keys() == want.keys()
    for key, (mean, weight, n) in want.items():
        assert abs(got[key][0] - mean) < 1e-9 and got[key][1:] == (weight, n)
    empty = replicate_groups.replicate_quantile_group_means(df.limit(0), "v", "b", "id", F.col("ws"), k)
    assert empty.count() == 0


def test_stored_ranges_are_not_shuffled_again(spark):
    """The rows' only exchange is the cut: what follows reads buckets. Sums of ranges may move."""
    run = ordering.cumulative_weight(skewed(spark), "w", "v", "k", ["g"], ranges=6)
    assert run.count() == skewed(spark).count()
    plan = run._jdf.queryExecution().executedPlan().toString()
    rows_moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(__range" in line and "__span" not in line]
    assert "Bucketed: true" in plan
    assert len(rows_moved) <= 1, plan
    names = [t.name for t in spark.catalog.listTables()]
    assert not any(n.startswith("tallyloom_") for n in names)


def test_a_source_without_statistics_is_counted(spark):
    from tallyloom.plans.scratch import range_count

    df = spark.createDataFrame([(i, 1.0) for i in range(100)], "k int, v double")
    assert range_count(df) == 8
    assert range_count(df, target_bytes=24) == 50


def test_ranged_totals_of_groups_inside_and_across_ranges(spark):
    """Many groups in a range, one over all ranges, decimal and whole sums, names with blanks and dots."""
    rows = [(f"g{i:04d}" if i % 3 else "hot", i % 2, i, i % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "`a group` string, `x.y` int, k int, w int").withColumn("w", F.col("w").cast("decimal(12,2)"))
    df = df.withColumnRenamed("x.y", "x y")
    got = ordering.cumulative_weight(df, "w", "x y", "k", ["a group"], ranges=7)
    whole = Window.partitionBy("a group")
    upto = whole.orderBy("x y", "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"cum_weight": F.sum("w").over(upto), "total_weight": F.sum("w").over(whole)})
    same = [F.col("a group"), F.col("x y"), F.col("k"), F.col("cum_weight").cast("double"), F.col("total_weight").cast("double")]
    assert got.count() == 3000 and got.select(*same).exceptAll(want.select(*same)).count() == 0
    assert got.columns == want.columns


def test_workers_do_not_need_the_package(tmp_path):
    """The worker function of the range form travels by value: run it where only the driver can
    import the package."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import functions as F
from tallyloom.operators.replicate_groups import replicate_quantile_group_means
from tallyloom.session import local_session
spark = local_session("alone", 2, **{{"spark.checkpoint.dir": {str(tmp_path / 'shared')!r}, "spark.driver.memory": "2g"}})
df = spark.range(100).select("id", F.col("id").cast("double").alias("v"), F.array(F.lit(1.0), F.lit(2.0)).alias("ws"))
print("rows", replicate_quantile_group_means(df, "v", "v", "id", F.col("ws"), 5).count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 10" in done.stdout, done.stderr[-2000:]


def odd_rows(spark):
    """Rows for a rule of key and line: missing and negative keys, missing and NaN weights, missing values and groups."""
    rows = [("a" if i % 3 else None, i % 2, i * 7919, i % 7 + 1, float(i % 5 + 1), float(i % 4)) for i in range(300)]
    rows += [("a", 0, None, 1, 2.0, 1.0), ("a", 0, 5, None, 2.0, 3.0), ("a", 1, -12345, 3, 2.0, 1.0), ("a", 0, 10, -4, 1.0, 2.0)]
    rows += [("a", 1, 10**15, 7, 3.0, 2.0), ("a", 0, 11, 2, None, 2.0), ("b", 0, 12, 3, None, 1.0), ("c", 1, 13, 1, 2.0, None)]
    rows += [("d", 0, 14, 2, float("nan"), 1.0), ("e", 0, 15, 1, 0.0, 1.0), ("f", 1, -99999, -3, 4.0, None), ("f", 1, 8, 3, 2.0, 5.0)]
    return spark.createDataFrame(rows, "g string, h int, l_orderkey long, l_linenumber int, l_quantity double, v double")


@pytest.mark.parametrize("by", [["g", "h"], ["g"], []])
@pytest.mark.parametrize("missing", [E.KEEP, E.DROP])
def test_matrix_sums_equal_the_row_form(spark, monkeypatch, by, missing):
    """Every replicate of every group, in slices of a few rows and several parts given back."""
    import dataclasses

    from tallyloom.workload.statistics import design

    monkeypatch.setattr(uncertainty, "SLICE_CELLS", 90)
    monkeypatch.setattr(uncertainty, "OUT_ROWS", 60)
    df, full = odd_rows(spark), design("bootstrap", count=29)
    assert full.vector is not None
    keys = [*by, "replicate"]
    got, want = [
        {tuple(r[k] for k in keys): r["value"] for r in d.table(df, E.WeightedMean("v", missing), by, ["v"]).collect()}
        for d in (full, dataclasses.replace(full, vector=None))
    ]
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (value if value is None else pytest.approx(value, rel=1e-12, nan_ok=True)), key


def test_matrix_sums_do_not_multiply_rows(spark, sf):
    """999 replicates used to send every row 125 times through the aggregation."""
    from tallyloom.workload import load_all

    plan = load_all()["bootstrap_share_999"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan, plan


def test_workers_do_not_need_the_package_for_matrix_sums(tmp_path):
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from tallyloom.session import local_session
from tallyloom.workload import load_all
spark = local_session("alone", 2, **{{"spark.checkpoint.dir": {str(tmp_path / 'shared')!r}, "spark.driver.memory": "2g"}})
print("rows", load_all()["sdr_share"].run(spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 3" in done.stdout, done.stderr[-2000:]
