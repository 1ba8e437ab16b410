"""Row sums of stored files: changed, lost and rewritten files, and rows that are recovered."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G
from tallyloom.operators import ledger as L
from tallyloom.operators.ledger import Ledger

SCHEMA = "survey string, year int, id int, v double"


def rows(spark, n=60):
    data = [("cps", 2023, i, i / 4) for i in range(n)] + [("ahs", 2023, i, None) for i in range(5)] + [("ahs", 2023, 4, None)]
    return spark.createDataFrame(data, SCHEMA)


def stored(spark, root, pieces=3):
    """A ledger whose release of ``cps`` lies in several files."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 60 // pieces)
    try:
        ledger = Ledger(spark, str(root))
        ledger.promote(rows(spark), [G.row_minimum(2)], "first")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    return ledger


def parts(root, survey="cps"):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.startswith("part-") and f"survey={survey}" in d)


def overwrite(spark, frame, path, tmp_path):
    """Another file's bytes under a stored file's name."""
    frame.coalesce(1).write.parquet(out := str(tmp_path / f"new-{os.path.basename(path)}"))
    (new,) = [os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")]
    with open(new, "rb") as f, open(path, "wb") as g:
        g.write(f.read())
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def errors(frame):
    return sorted((r["error"], r["survey"], r["file"]) for r in frame.collect())


def test_lanes_are_sums_of_row_hashes(spark):
    df = spark.createDataFrame([("x", 1, "b"), ("x", 1, "b"), ("x", None, None), ("y", 2, "")], "k string, a int, b string")
    got = {r["k"]: r for r in L.row_lanes(df, ["k"], ["a", "b"]).collect()}

    def expected(items):
        hashes = [hashlib.sha256("\x1f".join(f"{len(n)}:{n}={len(str(v))}:{v}" for n, v in zip("ab", t) if v is not None).encode()).hexdigest() for t in items]
        return [sum(int(h[16 * i : 16 * i + 16], 16) for h in hashes) % (1 << 64) for i in range(4)]

    for k, items in {"x": [(1, "b"), (1, "b"), (None, None)], "y": [(2, "")]}.items():
        assert [int(got[k][c]) for c in L.LANES] == expected(items) and got[k]["n_rows"] == len(items)
    whole = L.joined_lanes(L.row_lanes(df, ["k"], ["a", "b"]), []).first()
    direct = L.row_lanes(df, [], ["a", "b"]).first()
    assert whole.asDict() == direct.asDict()


def test_files_add_up_to_the_release(spark, tmp_path):
    ledger = stored(spark, tmp_path)
    assert len(parts(tmp_path)) >= 3
    files = ledger.lanes().collect()
    assert sorted(r["file"] for r in files if r["survey"] == "cps") == [os.path.basename(p) for p in parts(tmp_path)]
    keys = ["survey", "year"]
    want = L.row_lanes(rows(spark), keys, ["id", "v"])
    assert L.lane_errors(L.joined_lanes(ledger.lanes(), keys), want, keys).isEmpty()
    assert ledger.scrub_rows().isEmpty() and ledger.scrub().isEmpty()


def test_rewritten_rows_are_sound_and_changed_ones_are_not(spark, tmp_path):
    ledger = stored(spark, tmp_path)
    first, second, third = parts(tmp_path)[:3]
    same = spark.read.parquet(first).orderBy(F.desc("id"))
    overwrite(spark, same, first, tmp_path)
    name = os.path.basename
    assert {r["error"] for r in ledger.scrub_files().collect()} >= {"sha256 mismatch"}
    assert ledger.scrub_rows().isEmpty()
    changed = spark.read.parquet(second)
    smallest = changed.agg(F.min("id")).first()[0]
    overwrite(spark, changed.withColumn("v", F.when(F.col("id") == smallest, F.lit(-1.0)).otherwise(F.col("v"))), second, tmp_path)
    os.remove(third)
    want = sorted([("row mismatch", "cps", name(second)), ("no rows left", "cps", name(third))])
    assert errors(ledger.scrub_rows()) == want == errors(ledger.scrub_rows("cps", 2023))
    assert errors(ledger.scrub_rows("ahs")) == []
    assert errors(ledger.scrub_rows(files=[name(second)])) == [("row mismatch", "cps", name(second))]


def test_lost_rows_are_found_in_a_source(spark, tmp_path):
    ledger = stored(spark, tmp_path)
    first, second = parts(tmp_path)[:2]
    lost = sorted(r["id"] for r in spark.read.parquet(first, second).collect())
    os.remove(first)
    with open(second, "r+b") as f:
        f.truncate(10)
    found = ledger.recover("cps", 2023, rows(spark))
    assert sorted(r["id"] for r in found.collect()) == lost
    with pytest.raises(ValueError, match="does not hold"):
        ledger.recover("cps", 2023, rows(spark).filter(F.col("id") != lost[0]))
    with pytest.raises(ValueError, match="does not hold"):
        ledger.recover("cps", 2023, rows(spark).withColumn("v", F.col("v") + 1))
    with pytest.raises(LookupError):
        ledger.recover("sipp", 2023, rows(spark))
    assert ledger.recover("ahs", 2023, rows(spark)).isEmpty()


def test_empty_load(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark).limit(0), [G.row_minimum(2)], "none")
    assert ledger.lanes().isEmpty() and ledger.scrub_rows().isEmpty()


def test_loads_side_by_side_take_different_places(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    ledger = Ledger(spark, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(lambda _: ledger._claim_seq(), range(8))) == list(range(8))
    ledger.promote(rows(spark), [G.row_minimum(2)], "given", seq=20)
    assert ledger._claim_seq() == 21 and ledger._claim_seq() == 22
