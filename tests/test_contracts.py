"""Each contract passes on its fixture, and one changed fact fails the named gate."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G


def status(df):
    return {r["gate"]: r["status"] for r in df.collect()}


@pytest.fixture(scope="module")
def respondents(spark):
    rows = [("a", 2025, 1.0, "Yes"), ("b", 2025, 2.0, "Yes"), ("c", 2025, 0.5, "No"), ("d", 2025, 0.5, None)]
    return spark.createDataFrame(rows, "id string, year int, weight double, okay string")


def test_table_gates_and_negatives(respondents):
    good = status(
        G.run_gates(
            respondents,
            [G.row_count(4), G.key_non_null(["id"]), *G.weights_valid("weight"), G.period_equals("year", 2025), G.domain("okay", ["Yes", "No"])],
        )
    )
    assert set(good.values()) == {"pass"}
    bad = status(
        G.run_gates(
            respondents.withColumn("weight", F.when(F.col("id") == "a", -1.0).otherwise(F.col("weight"))),
            [G.row_count(5), *G.weights_valid("weight"), G.period_equals("year", 2024), G.domain("okay", ["Yes"])],
        )
    )
    assert [bad[g] for g in ("row_count", "weight_sign", "period_equals", "okay_domain")] == ["fail"] * 4
    assert bad["weight_finite"] == "pass"


def test_plan_gates(spark, respondents):
    rows = [
        G.required_columns(respondents, ["id", "panel"]),
        G.forbidden_columns(respondents, ["name"]),
        G.ordered_header(respondents, ["ID", "YEAR", "WEIGHT", "OKAY"], fold_case=True),
        G.column_count(respondents, 5),
    ]
    assert status(G.plan_gates(spark, rows)) == {
        "required_columns": "fail", "forbidden_columns": "pass", "ordered_header": "pass", "column_count": "fail"
    }


def test_implicates(spark):
    rows = [(f, i) for f in (1, 2) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "family int, imp int")
    assert set(status(G.implicates_gate(df, "family", "imp", 5)).values()) == {"pass"}
    broken = spark.createDataFrame(rows[:-1] + [(2, 4)], "family int, imp int")
    got = status(G.implicates_gate(broken, "family", "imp", 5))
    assert got["implicate_sets"] == "fail" and got["implicate_rows_per_family"] == "pass"


def test_alignment_with_repeated_keys_forms_no_pairs(spark):
    main = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, w double")
    reps = spark.createDataFrame([(1, 2.0), (2, 3.0), (2, 3.5)], "k int, r double")
    got = status(G.replicate_alignment_gate(main, reps, ["k"], "w", "r", 0.1))
    assert got["replicate_alignment"] == "fail" and got["replicate_matched"] == "pass"
    assert status(G.one_to_one_gate(main, reps, "k"))["join_keys_repeated"] == "fail"


def test_benchmarks_and_pinned_year(spark):
    df = spark.createDataFrame([(2024, 10.0), (2024, 20.0)], "year int, v double")
    got = status(
        G.run_gates(
            df,
            [
                G.benchmark("close", F.sum("v"), 30.4, 0.5),
                G.benchmark("far", F.sum("v"), 40.0, 0.01, relative=True),
                G.year_benchmark("same_year", F.sum("v"), 30.0, 0.01, "year", 2024),
                G.year_benchmark("other_year", F.sum("v"), 1.0, 0.01, "year", 2020),
            ],
        )
    )
    assert got == {"close": "pass", "far": "fail", "same_year": "pass", "other_year": "skip"}


def test_empty_input_fails_rather_than_passes(spark):
    empty = spark.createDataFrame([], "w double, v double")
    got = status(G.run_gates(empty, [G.non_empty(), *G.weights_valid("w"), G.benchmark("b", F.sum("v"), 0.0, 1.0)]))
    assert got["non_empty"] == "fail" and got["w_total"] == "fail" and got["b"] == "fail"


def test_record_contract(spark):
    rows = [('{"id":"rec-1","n":3,"tags":[1]}',), ('{"id":"REC","n":"3","tags":{}}',), ("{oops",)]
    df = spark.createDataFrame(rows, "t string")
    got = {r["gate"]: r["observed"] for r in G.run_gates(df, G.record_contract("t", {"n": "number", "tags": "array"}, "id", "^rec-")).collect()}
    assert got == {"record_parses": 1.0, "record_n_number": 2.0, "record_tags_array": 2.0, "record_id_pattern": 2.0}


def test_redistribution_guard(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "survey string, v int")
    ledger = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "survey string, redistributable boolean")
    assert [r["v"] for r in G.redistributable(df, ledger, ["survey"]).collect()] == [1]
