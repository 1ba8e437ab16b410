"""Promotion, quarantine, revisions, tampering, replay and streaming ingestion."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G
from tallyloom.operators import ledger as L
from tallyloom.streaming.ingest import ingest_releases, release_stream


def rows(spark, data):
    return spark.createDataFrame(data, "survey string, year int, id int, v double")


FIRST = [("cps", 2023, 1, 1.0), ("cps", 2023, 2, 2.0), ("ahs", 2023, 1, 5.0)]
def gates():
    return [G.row_minimum(2), G.non_empty()]


def test_digest_is_the_hash_of_sorted_lines(spark):
    df = spark.createDataFrame([("cps", 2024, "b", "22"), ("cps", 2024, "a", "11")], "survey string, year int, role string, sha256 string")
    row = L.release_digests(df).first()
    want = hashlib.sha256(b"release-schema:2\na:11\nb:22\n").hexdigest()
    assert (row["digest"], row["release_id"]) == (want, f"cps-2024-{want[:12]}")


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).select(F.lit("s").alias("g"), "id", (F.col("id") * 1.5).alias("v"))
    a = L.table_fingerprint(df, ["g"]).first()
    b = L.table_fingerprint(df.orderBy(F.col("id").desc()).repartition(7).select("v", "g", "id"), ["g"]).first()
    c = L.table_fingerprint(df.filter("id <> 500"), ["g"]).first()
    assert a["sha256"] == b["sha256"] != c["sha256"]


def test_promote_quarantine_and_revise(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    first = {r["survey"]: r for r in ledger.promote(rows(spark, FIRST), gates(), "a", 1).collect()}
    assert (first["cps"]["status"], first["ahs"]["status"]) == ("promoted", "quarantined")
    again = {r["survey"]: r for r in ledger.promote(rows(spark, FIRST), gates(), "b", 2).collect()}
    assert again["cps"]["status"] == "already-current" and again["cps"]["digest"] == first["cps"]["digest"]
    revised = ledger.promote(rows(spark, [("cps", 2023, 1, 1.5), ("cps", 2023, 2, 2.0)]), gates(), "c", 3).first()
    assert (revised["status"], revised["change"]) == ("promoted", "changed")
    assert sorted(r["v"] for r in ledger.read("cps").collect()) == [1.5, 2.0]
    with pytest.raises(LookupError):
        ledger.read("ahs")
    assert ledger.scrub().count() == 0
    # Running the last load again leaves the same ledger.
    ledger.promote(rows(spark, [("cps", 2023, 1, 1.5), ("cps", 2023, 2, 2.0)]), gates(), "c", 3)
    assert ledger.releases().count() == 5
    assert ledger.current().first()["digest"] == revised["digest"]


def test_repeated_keys_quarantine_their_release_only(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    data = FIRST[:2] + [("ahs", 2023, 1, 5.0), ("ahs", 2023, 1, 6.0)]
    unique = lambda stored: G.key_unique_gate(stored, ["id"], by=["survey", "year"])
    got = {r["survey"]: r["status"] for r in ledger.promote(rows(spark, data), gates(), "a", 1, further=[unique]).collect()}
    assert got == {"cps": "promoted", "ahs": "quarantined"}
    assert ledger.checks().filter("gate = 'key_unique'").count() == 2


def test_added_column_keeps_earlier_fingerprints(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark, FIRST[:2]), gates(), "a", 1)
    wider = rows(spark, [("acs", 2023, 1, 1.0), ("acs", 2023, 2, 2.0)]).withColumn("note", F.lit("x"))
    ledger.promote(wider, gates(), "b", 2)
    assert ledger.scrub().count() == 0


def test_scrub_finds_changed_data(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark, FIRST[:2]), gates(), "a", 1)
    target = f"{tmp_path}/data/load=a/survey=cps/year=2023"
    spark.createDataFrame([(1, 1.0), (2, 2.5)], "id int, v double").write.mode("overwrite").parquet(target)
    assert {r["error"] for r in ledger.scrub().collect()} == {"sha256 mismatch"}


def test_revalidate_appends_rows(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark, FIRST[:2]), gates(), "a", 1)
    again = ledger.revalidate([G.row_minimum(3)], "check-1").collect()
    assert [r["status"] for r in again] == ["fail"] and ledger.checks().count() == 3


def test_required_release(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    row = ledger.promote(rows(spark, FIRST[:2]), gates(), "a", 1).first()
    good = L.require_release(ledger.releases(), "cps", row["release_id"], row["digest"]).first()
    bad = L.require_release(ledger.releases(), "cps", row["release_id"], "other").first()
    assert (good["status"], bad["status"]) == ("pass", "fail")


def test_artifact_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\n1,2\n")
    row = L.artifact_manifest(spark, str(tmp_path)).first()
    assert (row["filename"], row["bytes"], row["sha256"]) == ("a.csv", 8, hashlib.sha256(b"x,y\n1,2\n").hexdigest())


def test_failed_years_are_planned_again(spark):
    make = lambda data, s: spark.createDataFrame(data, s)
    available = make([("cps", y) for y in (2020, 2021, 2022)], "survey string, year int")
    releases = make([("cps", 2020, "promoted")], "survey string, year int, status string")
    log = make([("cps", 2021, "failed"), ("cps", 2022, "already-current")], "survey string, year int, status string")
    assert [r["year"] for r in L.backfill_plan(available, releases, log).collect()] == [2021]


def test_stream_takes_each_file_once(spark, tmp_path):
    incoming, root = tmp_path / "in", tmp_path / "lake"
    schema = "survey string, year int, id int, v double"
    ledger = L.Ledger(spark, str(root))
    run = lambda: ingest_releases(
        release_stream(spark, str(incoming), spark.createDataFrame([], schema).schema), ledger, gates(), str(tmp_path / "cp")
    ).awaitTermination()
    rows(spark, FIRST).coalesce(1).write.mode("append").parquet(str(incoming))
    run()
    run()
    assert ledger.releases().count() == 2
    rows(spark, [("cps", 2024, 1, 1.0), ("cps", 2024, 2, 9.0)]).coalesce(1).write.mode("append").parquet(str(incoming))
    run()
    assert ledger.releases().count() == 3
    assert ledger.current().first()["year"] == 2024


from tallyloom.operators.gates import non_empty  # noqa: E402


def _table(spark, survey, year, *values):
    return spark.createDataFrame([(survey, year, float(v)) for v in values], "survey string, year int, v double")


def test_streams_share_a_ledger_and_releases_stay_whole(spark, tmp_path):
    from tallyloom.operators.ledger import Ledger
    from tallyloom.streaming.ingest import ingest_releases, release_stream

    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for survey in ("acs", "007"):
        path = str(tmp_path / survey)
        for n in range(4):
            _table(spark, survey, 2023, n, n + 10).write.mode("append").parquet(path)
        stream = release_stream(spark, path, _table(spark, survey, 2023).schema)
        ingest_releases(stream, ledger, [non_empty()], str(tmp_path / f"checkpoint-{survey}")).awaitTermination()
    assert ledger.read("acs").count() == 8
    assert ledger.read("007").select("survey").distinct().first()[0] == "007"
    assert ledger.releases().filter("status = 'promoted'").count() == 2


def test_recorded_load_is_immutable(spark, tmp_path):
    import pytest

    from tallyloom.operators.ledger import Ledger

    ledger = Ledger(spark, str(tmp_path / "ledger"))
    first = ledger.promote(_table(spark, "acs", 2023, 1, 2), [non_empty()], "one").collect()
    assert ledger.promote(_table(spark, "acs", 2023, 2, 1), [non_empty()], "one").collect() == first
    with pytest.raises(ValueError):
        ledger.promote(_table(spark, "acs", 2023, 3), [non_empty()], "one")
    assert ledger.read("acs").count() == 2


def test_empty_load(spark, tmp_path):
    from tallyloom.operators.ledger import Ledger

    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.promote(_table(spark, "acs", 2023), [non_empty()], "none").count() == 0
    assert ledger.promote(_table(spark, "acs", 2023, 1), [non_empty()], "some").first()["seq"] == 0


def test_code_points_out_of_range(spark):
    from tallyloom.functions.text import decode_entities

    df = spark.createDataFrame([("a&#1114112;b&#55296;&#65;",)], "t string")
    assert df.select(decode_entities("t")).first()[0] == "a�b�A"


def test_row_codes_keep_fields_apart(spark):
    from tallyloom.operators.ledger import row_code

    df = spark.createDataFrame([("1\x1fb=2", None), ("1", "2"), ("1", "1:2"), ("1\x1f1:b=1:2", None)], "a string, b string")
    assert df.select(row_code(["a", "b"]).alias("c")).distinct().count() == 4


def test_a_column_may_change_its_type(spark, tmp_path):
    ledger = L.Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark, FIRST[:2]), gates(), "a")
    later = spark.createDataFrame([("cps", 2024, 1, "x", 1), ("cps", 2024, 2, "y", 2)], "survey string, year int, id int, v string, more int")
    ledger.promote(later, gates(), "b")
    assert ledger.scrub().count() == 0
    checks = ledger.revalidate([G.row_minimum(2), G.Gate("more", F.count("more"), "equal", 2)], "again")
    assert {(r["year"], r["gate"], r["status"]) for r in checks.collect() if r["gate"] == "more"} == {(2023, "more", "fail"), (2024, "more", "pass")}
    # Other rows in place of the stored ones, then none at all.
    later.withColumn("v", F.lit("z")).write.mode("overwrite").partitionBy("survey", "year").parquet(f"{tmp_path}/data/load=b")
    assert {r["year"] for r in ledger.scrub().collect()} == {2024}
    later.limit(0).drop("survey", "year").write.mode("overwrite").parquet(f"{tmp_path}/data/load=b")
    assert {r["year"] for r in ledger.scrub().collect()} == {2024}
