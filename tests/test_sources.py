"""Readers and payload flatteners on tiny documents."""

import json

import pytest

from tallyloom.sources import delimited, statjson


def docs(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")


def test_provider_schema_replaces_header(spark, tmp_path):
    (tmp_path / "m.csv").write_text("X|Y\n1|2.5\n3|\n")
    schema = [{"name": "SSUID", "dtype": "string"}, {"name": "INC", "dtype": "float"}]
    rows = delimited.read_contract_csv(spark, str(tmp_path / "m.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [("1", 2.5), ("3", None)]
    with pytest.raises(ValueError):
        delimited.provider_schema([{"name": "A", "dtype": "money"}])


def test_members_meet_by_name_and_type(spark, tmp_path):
    (tmp_path / "q1.csv").write_text("NEWID,COST\n1,2\n")
    (tmp_path / "q2.csv").write_text("COST,NEWID,EXTRA\n2.5,7,x\n")
    rows = delimited.read_members(spark, [str(tmp_path / "q1.csv"), str(tmp_path / "q2.csv")]).orderBy("NEWID").collect()
    assert [(r["NEWID"], r["COST"], r["EXTRA"], r["SOURCE_FILE"]) for r in rows] == [
        (1, 2.0, None, "q1.csv"), (7, 2.5, "x", "q2.csv")
    ]


def test_provenance_survives_parquet(spark, tmp_path):
    df = delimited.with_provenance(spark.range(2), {"survey": "cps", "year": "2024"})
    df.write.parquet(str(tmp_path / "p"))
    assert delimited.provenance_of(spark.read.parquet(str(tmp_path / "p"))) == {"survey": "cps", "year": "2024"}


def test_sdmx_series_out_of_range(spark):
    payload = {
        "data": {
            "structures": [{"dimensions": {
                "series": [{"id": "AREA", "values": [{"id": "USA"}, {"id": "DEU"}]}, {"id": "FREQ", "values": [{"id": "Q"}]}],
                "observation": [{"id": "TIME_PERIOD", "values": [{"id": "2024-Q1"}]}],
            }}],
            "dataSets": [{"series": {"0:0": {"observations": {"0": [1.5], "3": ["2.5", 0]}}, "1:4": {"observations": {"0": [None]}}}}],
        }
    }
    rows = statjson.flatten_sdmx_series(docs(spark, payload), "payload", ["AREA", "FREQ", "NONE"]).collect()
    assert {tuple(r) for r in rows} == {
        ("USA", "Q", None, "2024-Q1", 1.5), ("USA", "Q", None, "idx_3", 2.5), ("DEU", None, None, "2024-Q1", None)
    }


def test_sdmx_all_dimensions(spark):
    payload = {
        "structures": [{"dimensions": {"observation": [{"id": "AREA", "values": [{"id": "USA"}]}, {"id": "LEVEL", "values": [{"id": "AW50"}, {"id": "AW67"}]}]}}],
        "dataSets": [{"observations": {"0:1": [9.25, 0], "0:5": [1]}}],
    }
    rows = statjson.flatten_sdmx_all_dimensions(docs(spark, payload), "payload", ["LEVEL", "AREA"]).collect()
    assert {tuple(r) for r in rows} == {("AW67", "USA", 9.25), ("idx_5", "USA", 1.0)}


def test_jsonstat(spark):
    payload = {
        "size": [2, 3],
        "value": {"0": 1.0, "5": 6.0},
        "dimension": {
            "geo": {"category": {"index": {"DE": 0, "FR": 1}, "label": {"DE": "Germany"}}},
            "time": {"category": {"index": {"2021": 0, "2022": 1, "2023": 2}, "label": {}}},
        },
    }
    cells = statjson.flatten_jsonstat(docs(spark, payload), "payload", ["geo", "time"])
    assert {tuple(r) for r in cells.collect()} == {("DE", "Germany", "2021", "2021", 1.0), ("FR", "FR", "2023", "2023", 6.0)}
    assert statjson.jsonstat_lookup(cells, {"geo": "Germany", "time": "2021"}).count() == 1
    assert statjson.jsonstat_lookup(cells, {"geo": "Atlantis", "time": "2021"}).count() == 0
    ok = statjson.jsonstat_dimensions(docs(spark, payload), "payload", ["geo", "time", "sex"]).first()
    assert not ok["dimensions_match"] and not ok["sizes_match"]


def test_record_shapes(spark):
    record = {"ref_area": "USA", "obs_value": 3.5}
    both = docs(spark, [record], {"value": [record, record]})
    assert statjson.flatten_record_list(both, "payload", {"ref_area": "string", "obs_value": "double"}).count() == 3
    indicator = [{"page": 1}, [{"indicator": {"id": "I", "value": "n"}, "country": {"id": "US", "value": "USA"}, "date": "2023", "value": 2, "decimal": 0}]]
    row = statjson.flatten_indicator_records(docs(spark, indicator), "payload").first()
    assert (row["indicator_id"], row["country_name"], row["value"]) == ("I", "USA", 2.0)
    head = [["NAME", "POP"], ["A", "1"], ["B", "2"]]
    table = statjson.header_row_table(docs(spark, head), "payload", ["POP", "NAME", "GONE"])
    assert sorted(tuple(r) for r in table.collect()) == [("1", "A", None), ("2", "B", None)]


def test_series_points_and_vintages(spark):
    points = {"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": "C", "data": [
        {"year": "2024", "period": "M12", "periodName": "December", "value": "315.605", "footnotes": [{"text": "a"}, {"text": "b"}]},
        {"year": "2024", "period": "M11", "periodName": "November", "value": "-", "footnotes": [{}]},
    ]}]}}
    rows = {r["period"]: r for r in statjson.flatten_series_points(docs(spark, points), "payload").collect()}
    assert (rows["M12"]["value"], rows["M12"]["footnotes"], rows["M11"]["value"]) == (315.605, "a | b", None)
    vintages = {"observations": [
        {"realtime_start": "2024-01-01", "realtime_end": "2024-06-30", "date": "2023-10-01", "value": "1"},
        {"realtime_start": "2024-07-01", "realtime_end": "9999-12-31", "date": "2023-10-01", "value": "2"},
    ]}
    rows = statjson.flatten_vintage_observations(docs(spark, vintages), "payload")
    assert [r["value"] for r in statjson.as_of_vintage(rows, "2024-08-01").collect()] == ["2"]


def test_united_series_of_all_event_types(spark, sf):
    from tallyloom.workload import load_all

    types = {r[0] for r in spark.read.parquet(f"{sf}/events.parquet").select("event_type").distinct().collect()}
    rows = load_all()["united_series_all"].run(spark, sf).select("series_id").distinct().collect()
    assert {r["series_id"] for r in rows} == types and len(types) == 5
