"""Result tables: parts written in parallel are the ordered table."""

from __future__ import annotations

import csv
import pathlib

from pyspark.sql import functions as F

from tallyloom.sources.sinks import write_result_csv


def parts(path: str) -> list[list[dict]]:
    files = sorted(pathlib.Path(path).glob("part-*.csv"))
    return [list(csv.DictReader(f.open())) for f in files]


def test_parts_are_ordered_by_value(spark, tmp_path):
    df = spark.range(2000).select(((F.col("id") * 7919) % 2000 / 8.0).alias("v"), "id")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_result_csv(df, path := str(tmp_path / "many"), [F.col("v").desc(), "id"], digits=3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    found = parts(path)
    assert len(found) > 1
    rows = [r for part in found for r in part]
    want = sorted(((i * 7919) % 2000 / 8.0, i) for i in range(2000))
    want.sort(key=lambda x: (-x[0], x[1]))
    assert [(r["v"], int(r["id"])) for r in rows] == [(f"{v:.3f}", i) for v, i in want]


def test_small_and_empty_tables_have_a_header(spark, tmp_path):
    df = spark.createDataFrame([("b", 10.0), ("a", 9.5), (None, None)], "k string, v double")
    write_result_csv(df, path := str(tmp_path / "small"), ["v"])
    assert [r["v"] for part in parts(path) for r in part] == ["", "9.500000", "10.000000"]
    write_result_csv(df.limit(0), path := str(tmp_path / "none"), ["v"])
    assert [f.read_text() for f in pathlib.Path(path).glob("part-*.csv")] == ["k,v\n"]
