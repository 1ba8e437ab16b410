"""Contracts that recipes enforce."""

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import recipes


def _summary(spark):
    rows = [(f, i, float(f), float(f % 7), 1.0) for f in range(1, 41) for i in range(1, 6)]
    return spark.createDataFrame(rows, "family int, imp int, wealth double, balance double, w double").withColumn("record", F.col("family") * 10)


def _replicates(spark, families):
    return spark.createDataFrame([(f * 10, [1.0, 2.0, 0.0 + f % 3]) for f in families], "key int, weights array<double>")


def _table(spark, families):
    return recipes.balance_by_quantile(
        _summary(spark), _replicates(spark, families), family="family", record="record", implicate="imp", wealth="wealth", balance="balance", weight="w",
        replicate_key="key", replicate_weights=F.col("weights"), implicates=5, groups=4,
    )


def test_families_without_replicate_weights_end_the_job(spark):
    assert _table(spark, range(1, 41)).count() == 4
    with pytest.raises(Exception, match="no replicate weights for record"):
        _table(spark, range(1, 40)).collect()


def test_replicate_weights_are_made_for_the_joined_records_only(spark):
    """Arrays made for every stored replicate row would be shuffled or broadcast whole."""
    keys = _replicates(spark, range(1, 60)).select("key")
    weights = F.when(F.col("key") <= 400, F.array(*[F.lit(1.0 + j) + F.col("key") % (j + 2) for j in range(3)])).otherwise(
        F.raise_error(F.lit("made for a record that no summary row has")).cast("array<double>")
    )
    out = recipes.balance_by_quantile(
        _summary(spark), keys, family="family", record="record", implicate="imp", wealth="wealth", balance="balance", weight="w",
        replicate_key="key", replicate_weights=weights, implicates=5, groups=4,
    ).collect()
    assert [r["quantile_group"] for r in out] == [1, 2, 3, 4] and all(r["standard_error"] > 0 for r in out)


def test_gates_name_what_is_broken(spark):
    names = {"family": "family", "record": "record", "implicate": "imp", "replicate_key": "key", "implicates": 5}
    summary = _summary(spark)
    status = lambda s, f: {r["gate"]: r["status"] for r in recipes.balance_gates(s, _replicates(spark, f), **names).collect()}
    assert set(status(summary, range(1, 41)).values()) == {"pass"}
    assert status(summary, [*range(1, 41), 3])["join_keys_repeated"] == "fail"
    assert status(summary, range(2, 41))["join_keys_unmatched"] == "fail"
    assert status(summary.filter("NOT (family = 4 AND imp = 2)"), range(1, 41))["implicate_rows_per_family"] == "fail"
