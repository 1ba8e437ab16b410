"""File digests, files recorded in the ledger, and content that is stored once."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G
from tallyloom.operators.files import list_files, with_digests
from tallyloom.operators.ledger import Ledger

ROWS = [("cps", 2023, 1, 1.0), ("cps", 2023, 2, 2.0), ("a b:c/d+e", 2024, 1, 5.0), ("a b:c/d+e", 2024, 2, 6.0), ("small", 2024, 1, 1.0)]


def rows(spark, data=ROWS):
    return spark.createDataFrame(data, "survey string, year int, id int, v double")


def parts(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.startswith("part-"))


def test_a_file_of_three_gigabytes(spark, tmp_path):
    """More than one value can hold; the file is sparse, so it takes no room."""
    size = 3 << 30
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "small file.bin").write_bytes(b"x" * 1000)
    (tmp_path / "empty.bin").write_bytes(b"")
    got = {os.path.basename(r["path"]): (r["bytes"], r["sha256"]) for r in with_digests(list_files(spark, str(tmp_path))).collect()}
    sha = hashlib.sha256()
    for _ in range(size >> 24):
        sha.update(bytes(1 << 24))
    assert got["large.bin"] == (size, sha.hexdigest())
    assert got["small file.bin"] == (1000, hashlib.sha256(b"x" * 1000).hexdigest())
    assert len(got) == 2


def test_ledger_tells_file_errors_apart(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark), [G.row_minimum(2)], "first")
    assert ledger.scrub_files().count() == 0
    recorded = {r["path"]: r for r in ledger.files().collect()}
    assert sorted(recorded) == [os.path.relpath(p, tmp_path) for p in parts(tmp_path)]
    for path, r in recorded.items():
        body = (tmp_path / path).read_bytes()
        assert (r["bytes"], r["sha256"]) == (len(body), hashlib.sha256(body).hexdigest())
    assert {r["survey"] for r in recorded.values()} == {"cps", "a b:c/d+e", "small"}
    cps = next(p for p, r in recorded.items() if r["survey"] == "cps")
    other = next(p for p, r in recorded.items() if r["survey"].startswith("a b"))
    body = bytearray((tmp_path / cps).read_bytes())
    body[len(body) // 2] ^= 1
    (tmp_path / cps).write_bytes(bytes(body))
    (tmp_path / other).replace((tmp_path / other).with_name("part-moved.parquet"))
    got = {(r["error"], r["survey"], os.path.basename(r["path"])) for r in ledger.scrub_files().collect()}
    assert got == {
        ("sha256 mismatch", "cps", os.path.basename(cps)), ("missing file", "a b:c/d+e", os.path.basename(other)), ("unrecorded file", None, "part-moved.parquet"),
    }
    (tmp_path / cps).write_bytes(bytes(body) + b"more")
    assert {"byte count mismatch", "sha256 mismatch"} <= {r["error"] for r in ledger.scrub_files().filter("survey = 'cps'").collect()}
    (tmp_path / cps).write_bytes(b"")
    assert [r["error"] for r in ledger.scrub_files().filter("survey = 'cps'").collect()] == ["missing file"]
    assert Ledger(spark, str(tmp_path / "none")).scrub_files().count() == 0


def test_equal_content_is_stored_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    ledger.promote(rows(spark), [G.row_minimum(2)], "first")
    before = parts(tmp_path)
    again = ledger.promote(rows(spark).repartition(3), [G.row_minimum(2)], "second")
    assert {r["survey"]: r["status"] for r in again.collect()} == {"cps": "already-current", "a b:c/d+e": "already-current", "small": "quarantined"}
    added = [p for p in parts(tmp_path) if p not in before]
    assert added and all("survey=small" in p for p in added) and set(before) <= set(parts(tmp_path))
    assert ledger.read("cps").count() == 2 and ledger.scrub().count() == 0 and ledger.scrub_files().count() == 0
    changed = rows(spark).withColumn("v", F.col("v") + F.when(F.col("survey") == "cps", 1.0).otherwise(0.0))
    ledger.promote(changed, [G.row_minimum(2)], "third")
    assert sorted(r["v"] for r in ledger.read("cps").collect()) == [2.0, 3.0]
    with pytest.raises(ValueError, match="gates"):
        ledger.promote(rows(spark), [], "fourth")
