"""The catalog of a ledger: what is promoted is found, by postings as by a scan."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gates as G
from tallyloom.operators.catalog_index import BUCKETS, CatalogIndex
from tallyloom.operators.ledger import Ledger

DOCS = [
    ("cps", 2023, "codebook", "a.txt", "Weights of the Persons file; Replicate weights follow"), ("cps", 2023, "notes", "b.txt", "Ünits are HOUSEHOLDS\nwith 100% sample_"),
    ("ahs", 2023, "codebook", "c.txt", "persons"), ("ahs", 2024, "codebook", "d.txt", "per sons"), ("ahs", 2024, "empty", "e.txt", ""), ("ahs", 2024, "null", "f.txt", None),
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    ledger = Ledger(spark, str(tmp_path_factory.mktemp("lake")))
    docs = spark.createDataFrame(DOCS, "survey string, year int, document_role string, source_file string, content string")
    data = spark.createDataFrame([("scf", 2022, 1, 2.0, [1])], "survey string, year int, PersonWeight int, income double, parts array<int>")
    catalog = CatalogIndex(ledger)
    assert catalog.update() == [] and catalog.search("weight").count() == 0
    ledger.promote(docs, [G.non_empty()], "docs")
    assert catalog.update() == ["docs"]
    ledger.promote(data, [G.non_empty()], "data")
    ledger.promote(data.withColumns({"survey": F.lit("bad"), "year": F.lit(1900)}), [G.row_minimum(5)], "bad")
    assert catalog.update() == ["data"] and catalog.update() == []
    return catalog


@pytest.mark.parametrize("query", ["persons", "WEIGHT", "weights of the", "ünits", "100%", "sample_", "\nwith", "x", "er", "no such words", "ons", "aaa"])
def test_postings_give_what_a_scan_gives(index, query):
    from tallyloom.operators.catalog import search_documents, search_variables

    docs, found = index.documents(), index.search_documents(query)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, search_documents(docs, query).collect()), key=str)
    want = {i for s, y, _, i, t in DOCS if t is not None and query.lower() in t.lower()}
    assert {r["source_file"] for r in found.collect()} == want
    names = search_variables(index.variables(), query)
    assert sorted(map(tuple, index.search_variables(query).collect())) == sorted(map(tuple, names.collect()))


def test_variables_come_from_schemas(index):
    rows = index.variables().filter("survey = 'scf'").collect()
    assert {(r["variable_name"], r["data_type"]) for r in rows} == {("PersonWeight", "integer"), ("income", "double"), ("parts", "array")}
    assert [r["kind"] for r in index.search("weight", 2).collect()] == ["variable", "document"]
    assert index.search_variables("person").first()["release_id"].startswith("scf-2022-")


def test_only_postings_of_the_wanted_triples_are_read(index):
    found = index.postings("persons")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "In(triple" in plan
    assert len({r["bucket"] for r in index._read("postings", "bucket int").select("bucket").distinct().collect()}) <= BUCKETS


def test_a_revision_replaces_its_release(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    catalog = CatalogIndex(ledger)
    make = lambda text: spark.createDataFrame([("cps", 2023, "codebook", "a.txt", text)], "survey string, year int, document_role string, source_file string, content string")
    ledger.promote(make("first wording"), [G.non_empty()], "one")
    catalog.update()
    ledger.promote(make("second wording"), [G.non_empty()], "two")
    assert catalog.search_documents("wording").count() == 0
    catalog.update()
    assert [r["snippet"] for r in catalog.search_documents("wording").collect()] == ["second wording"]
    assert catalog.search_documents("first").count() == 0
    assert catalog.scan("wording").count() == 1
