"""Broken, absent, half-known and odd payloads listed beside the cells of the others."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.gates import run_gates
from tallyloom.sources.payloads import payload_gates, payload_rows, read_fields

DOCS = [
    (1, '{"value":[{"geo":"AA","v":1.5},{"geo":"ZZ","v":"n/a"},{"geo":null,"v":null},{}]}'),
    (2, '{"value":[]}'),
    (3, '{"value":['),
    (4, None),
    (5, '{"other":1}'),
    (6, '{"value":7}'),
    (7, '{"value":{"a":{"geo":"BB","v":2},"b":{"geo":"AA","v":"3"}}}'),
    (8, ""),
    (9, '{"value":[5]}'),
    (10, '{"value":{}}'),
    (11, '{"value":null}'),
    (12, '{"value":[null]}'),
    (1, '{"value":[{"geo":"AA","v":1.5}]}'),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(DOCS, "id int, payload string")
    return payload_rows(df, "payload", "$.value", ["id"])


def test_every_document_has_one_status(rows):
    got = sorted((r["id"], r["status"]) for r in rows.filter("row = 'document'").collect())
    want = {1: "parsed", 2: "empty", 3: "broken", 4: "absent", 5: "unexpected", 6: "unexpected", 7: "parsed", 8: "broken", 9: "parsed", 10: "empty", 11: "unexpected", 12: "parsed"}
    assert got == sorted([*want.items(), (1, "parsed")])


def test_elements_carry_faults(rows):
    read = read_fields(rows, {"geo": "string", "v": "double"}, {"geo": ["AA", "BB"]})
    got = [(r["id"], r["pos"], r["key"], r["geo"], r["v"], r["faults"]) for r in read.filter("row = 'element'").collect()]
    by = lambda x: (x[0], x[1], str(x[3]), str(x[4]))
    assert sorted(got, key=by) == [
        (1, 0, None, "AA", 1.5, []), (1, 0, None, "AA", 1.5, []), (1, 1, None, "ZZ", None, ["v: unreadable", "geo: unknown code"]),
        (1, 2, None, None, None, []), (1, 3, None, None, None, []), (7, 0, "a", "BB", 2.0, []), (7, 1, "b", "AA", 3.0, []),
        (9, 0, None, None, None, []), (12, 0, None, None, None, []),
    ]
    assert read.filter("row = 'document' AND size(faults) > 0").isEmpty()


def test_gates(rows):
    read = read_fields(rows, {"geo": "string", "v": "double"}, {"geo": ["AA", "BB"]})
    got = {r["gate"]: (r["observed"], r["status"]) for r in run_gates(read, payload_gates(["geo"])).collect()}
    assert got == {
        "payload_absent": (1.0, "fail"), "payload_broken": (2.0, "fail"), "payload_unexpected": (3.0, "fail"), "payload_empty": (2.0, "fail"),
        "values_read": (1.0, "fail"), "known_codes_geo": (1.0, "fail"),
    }


def test_paths_dots_and_names(spark):
    text = json.dumps([{}, [{"a.b": 1, "in": {"x": "q"}}]])
    rows = payload_rows(spark.createDataFrame([(text,)], "t string"), "t", "$[1]")
    got = read_fields(rows, {"n": "int", "x": "string"}, paths={"n": "$['a.b']", "x": "$.in.x"}).filter("row = 'element'").first()
    assert (got["n"], got["x"], got["faults"]) == (1, "q", [])
    with pytest.raises(ValueError):
        payload_rows(spark.createDataFrame([("1", "{}")], "status string, t string"), "t", keep=["status"])
    with pytest.raises(ValueError):
        read_fields(rows, {"pos": "int"})


def test_empty_table_and_long_list(spark):
    none = payload_rows(spark.createDataFrame([], "t string"), "t")
    assert none.isEmpty() and read_fields(none, {"v": "int"}).isEmpty()
    text = json.dumps([{"v": i} for i in range(50_000)])
    read = read_fields(payload_rows(spark.createDataFrame([(text,)], "t string"), "t"), {"v": "long"})
    assert read.agg(F.count("v"), F.sum("v"), F.count("*")).first()[:] == (50_000, 50_000 * 49_999 // 2, 50_001)
