"""Pages, documents and catalog search."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import catalog, joins, series, webpages
from tallyloom.operators.webpages import LinkRole

HTML = """<html><head><title>t</title><style>x</style></head><body><NAV><a href="/skip">s</a></NAV><script>var a="<p>";</script>
<header>top</header><main><h1>Title &amp; more</h1><p> one <b>two</b></p><!-- gone --></main><footer>f</footer></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    links = """<a class=x href="/files/scf2022.zip"><b>Data</b> 2022</a><a href='codebook.pdf'>Book</a><a href="https://o.org/a?b=1#c">Out</a><a name="n">no</a>"""
    return spark.createDataFrame([(1, "https://x.org/data/index.htm?q=1", links), (2, "https://y.org", HTML)], "page_id int, url string, html string")


def test_links_are_absolute_and_clean(pages):
    got = {(r["link"], r["label"]) for r in webpages.extract_links(pages).filter("page_id = 1").collect()}
    assert got == {
        ("https://x.org/files/scf2022.zip", "Data 2022"), ("https://x.org/data/codebook.pdf", "Book"), ("https://o.org/a?b=1#c", "Out")
    }


def test_main_text_drops_navigation_and_prefers_main(pages):
    text = pages.filter("page_id = 2").select(webpages.main_text("html")).first()[0]
    assert text == "Title & more\none\ntwo"


def test_roles_and_complete_years(spark):
    links = spark.createDataFrame(
        [("https://x/scf2022.zip",), ("https://x/scf2022rw.zip",), ("https://x/scf2019.zip",), ("https://x/se%20doc.pdf",)], "link string"
    )
    roles = [LinkRole("weights", r"/scf(\d{4})rw\.zip$", 1), LinkRole("data", r"/scf(\d{4}).*\.zip$", 1), LinkRole("doc", r"/se doc\.pdf$")]
    found = webpages.classify_links(links, roles)
    assert {(r["role"], r["year"]) for r in found.collect()} == {("data", 2022), ("weights", 2022), ("data", 2019), ("doc", None)}
    assert [r["year"] for r in webpages.complete_releases(found, ["data", "weights", "doc"]).collect()] == [2022]
    assert webpages.exactly_one(found).filter("unambiguous").count() == 4


def test_sample_ids_need_the_whole_first_cell(spark):
    html = "<table><tr><th>ID</th></tr><tr><td>us2023a</td><td>us2022a</td></tr><tr><td>us2024ax</td></tr><tr><td>us1999a</td></tr></table>"
    pages = spark.createDataFrame([(html,)], "html string")
    rows = webpages.sample_ids(pages, r"us(\d{4})a", 1, 2000).collect()
    assert [tuple(r) for r in rows] == [(2023, "us2023a")]


def test_segments_keep_source_page_numbers(spark):
    docs = spark.createDataFrame([(1, "codebook", "c.txt", "one\f \f three ")], "doc_id int, role string, file string, text string")
    assert [(r["source_page"], r["segment"]) for r in webpages.page_segments(docs).collect()] == [(1, "one"), (3, "three")]
    side = webpages.doc_sidecar(docs, "role", "file", "direct-text").first()
    assert side["page_segments"] == 2
    assert side["markdown"].endswith("<!-- source-page: 1 -->\n\none\n\n<!-- source-page: 3 -->\n\nthree\n")


def test_search_shares_one_limit(spark):
    frame = spark.createDataFrame([], "WGT double, NETWORTH double, wgt2 int")
    variables = catalog.catalog_variables(spark, [("scf", 2022, "r1", "s.parquet", frame), ("scf", 2019, "r0", "s.parquet", frame)])
    docs = spark.createDataFrame([("codebook", "c.txt", "x" * 300 + " the WGT variable"), ("changes", "d.txt", "wgt")], "document_role string, source_file string, content string")
    docs = catalog.catalog_documents(docs, "scf", 2022, "r1")
    hits = catalog.search_catalog(variables, docs, "wgt", 5).collect()
    assert [h["kind"] for h in hits] == ["variable"] * 4 + ["document"]
    assert [h["year"] for h in hits[:4]] == [2022, 2022, 2019, 2019]
    assert [h["document_role"] for h in catalog.search_documents(docs, "wgt", 1).collect()] == ["changes"]
    long = catalog.search_documents(docs, "wgt").filter("source_file = 'c.txt'").first()["snippet"]
    assert "the WGT variable" in long and len(long) < 300


def test_region_join_keeps_empty_regions(spark):
    regions = spark.createDataFrame([("Ohio", "OH", "39"), ("Utah", "UT", "49")], "name string, postal string, fips string")
    data = spark.createDataFrame([("oh", 1.0), ("OH", 2.0), ("ZZ", 3.0)], "state string, v double")
    got = joins.attach_region(data, regions, "state", "postal")
    assert sorted((r["name"], r["v"]) for r in got.filter("v is not null").collect()) == [("Ohio", 1.0), ("Ohio", 2.0)]
    assert [r["name"] for r in got.filter("v is null").collect()] == ["Utah"]


def test_latest_and_as_of(spark):
    df = spark.createDataFrame(
        [("a", "2024-Q1", 1.0, 1), ("a", "2024-Q2", 2.0, 2), ("b", "1990-Q2", 9.0, 3)], "area string, q string, v double, k int"
    )
    assert {r["v"] for r in series.latest_per_group(df, ["area"], "q", "k").collect()} == {2.0, 9.0}
    assert {r["v"] for r in series.latest_per_group(df, ["area"], "q", "k", "2020-Q1").collect()} == {2.0}
    based = series.asof_baseline(df, "area", "q", "v", F.lit("2024-Q1")).filter("area = 'a'").select("baseline").distinct()
    assert [r[0] for r in based.collect()] == [1.0]


def test_links_resolve_dots_and_bare_targets(spark):
    from urllib.parse import urljoin

    base = "https://x.org/c/d/e.html?a=../b"
    targets = ["../data.zip", "./y.csv", "plain.zip", "../../../z", "a/./b/../c?q=../r", "/p/../q/.", "..", "?s=./t", "#f", "//h/./i", "http://o/a/../b", "g/.h/..i/"]
    html = "".join(f"<a class=k href={t}>{i}</a>" for i, t in enumerate(targets)) + "<A HREF = 'in quotes.csv' >q</A>"
    page = spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")
    from tallyloom.operators.webpages import extract_links

    got = {r["label"]: r["link"] for r in extract_links(page).collect()}
    assert got == {str(i): urljoin(base, t) for i, t in enumerate(targets)} | {"q": "https://x.org/c/d/in quotes.csv"}
