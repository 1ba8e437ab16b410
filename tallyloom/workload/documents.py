"""Pages, documents and catalog search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, pagetext, webpages
from ..operators.catalog_index import CatalogIndex
from ..operators.gates import non_empty
from ..operators.ledger import Ledger
from ..operators.webpages import LinkRole
from ..plans.scratch import new_scratch_path
from ..sources.delimited import file_inventory
from .registry import query, table

_ANCHOR_SQL = r"""(?is)<a\s[^>]*?href=["''][^"'']+["''][^>]*>.*?</a>"""
_DECODE = lambda e: f"replace(replace({e},'&quot;','\"'),'&amp;','&')"


@query(
    "L1",
    f"""SELECT page_id, regexp_extract(url,'^([a-zA-Z]+://[^/?#]*)',1)||{_DECODE("regexp_extract(a,'(?is)^<a[^>]*href=.([^\"'']+)',1)")} AS link,
    trim(regexp_replace({_DECODE("regexp_replace(regexp_replace(regexp_replace(a,'(?is)^<a[^>]*>',''),'(?is)</a>$',''),'<[^>]*>',' ','g')")},'\\s+',' ','g')) AS label
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html,'{_ANCHOR_SQL}')) a FROM pages)""",
)
def page_links(spark, sf):
    return webpages.extract_links(table(spark, sf, "pages"))


LANGUAGES = ("en", "fr", "de", "es")
ROLES = [LinkRole(lang, rf"/{lang}/[0-9]*([0-9])", 1) for lang in LANGUAGES] + [LinkRole("shared", "^/[A-Za-z]+$")]
_PATH_SQL = r"regexp_replace(regexp_replace(link,'^[a-z]+://[^/?#]*',''),'[?#].*$','')"
_ROLE_SQL = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(path,'/{lang}/[0-9]*([0-9])') THEN '{lang}'" for lang in LANGUAGES)
    + " WHEN regexp_matches(path,'^/[A-Za-z]+$') THEN 'shared' END"
)
_YEAR_SQL = "CASE " + " ".join(f"WHEN regexp_matches(path,'/{lang}/[0-9]*([0-9])') THEN CAST(regexp_extract(path,'/{lang}/[0-9]*([0-9])',1) AS INTEGER)" for lang in LANGUAGES) + " END"
_CLASSIFIED_SQL = f"""WITH links AS (SELECT url AS link FROM pages UNION ALL SELECT regexp_extract(url,'^([a-zA-Z]+://[^/?#]*)',1)||'/guide' FROM pages),
    c AS (SELECT * FROM (SELECT link, {_ROLE_SQL} role, {_YEAR_SQL} AS year FROM (SELECT link, {_PATH_SQL} path FROM links)) WHERE role IS NOT NULL) """


def classified(spark, sf):
    pages = table(spark, sf, "pages")
    own = pages.select(F.col("url").alias("link"))
    guide = pages.select(webpages.resolve_url(F.lit("/guide"), "url").alias("link"))
    return webpages.classify_links(own.unionByName(guide), ROLES)


@query("L2", _CLASSIFIED_SQL + "SELECT role, coalesce(year,-1) AS year, count(*) AS n FROM c GROUP BY 1,2")
def link_roles(spark, sf):
    return classified(spark, sf).groupBy("role", F.coalesce("year", F.lit(-1)).alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "L3",
    _CLASSIFIED_SQL
    + "SELECT year FROM c WHERE role IN ('en','fr','es') GROUP BY 1 HAVING count(DISTINCT role)=3 AND (SELECT count(*) FROM c WHERE role='shared')>0",
)
def complete_releases(spark, sf):
    return webpages.complete_releases(classified(spark, sf), ["en", "fr", "es", "shared"])


@query(
    "L4",
    _CLASSIFIED_SQL
    + "SELECT role, coalesce(year,-1) AS year, CAST(count(DISTINCT link) AS BIGINT) AS n, count(DISTINCT link)=1 AS unambiguous FROM c GROUP BY 1,2",
)
def unambiguous_roles(spark, sf):
    counted = webpages.exactly_one(classified(spark, sf))
    return counted.withColumn("year", F.coalesce("year", F.lit(-1)))


@query(
    "L5",
    "SELECT DISTINCT CAST(2000+page_id%40 AS INTEGER) AS year, 'us'||(2000+page_id%40)||'a' AS sample_id FROM pages WHERE page_id%40>=10 AND page_id%3<>0",
)
def sample_identifiers(spark, sf):
    """Each page gets a table whose first cell holds an identifier; every third is malformed."""
    k = F.col("page_id")
    suffix = F.when(k % 3 == 0, F.lit("ab")).otherwise(F.lit("a"))
    row = F.concat(
        F.lit("<table><tr><th>Sample</th></tr><tr class='r'><td><b>us"), (2000 + k % 40).cast("string"), suffix,
        F.lit("</b></td><td>us1999a</td></tr></table>"),
    )
    pages = table(spark, sf, "pages").select(F.concat("html", row).alias("html"))
    return webpages.sample_ids(pages, "us([0-9]{4})a", 1, 2010)


def _main_text_sql() -> str:
    t = "regexp_replace(html,'(?is)<!--.*?-->',chr(10),'g')"
    for tag in webpages.DROPPED_ELEMENTS:
        t = rf"regexp_replace({t},'(?is)<{tag}\b[^>]*>.*?</{tag}\s*>',chr(10),'g')"
    part = lambda tag: rf"nullif(regexp_extract(t,'(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>',1),'')"
    main = rf"coalesce({part('main')},{part('article')},{part('body')},nullif(regexp_extract(t,'(?is)<body\b[^>]*>(.*)$',1),''),t)"
    text = f"regexp_replace({main},'<[^>]*>',chr(10),'g')"
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text},'{entity}','{char}')"
    lines = f"list_transform(string_split({text},chr(10)), lambda x: trim(x,' '||chr(9)||chr(13)))"
    return f"SELECT page_id, sha256(array_to_string(list_filter({lines}, lambda x: x<>''),chr(10))) AS digest FROM (SELECT page_id, {t} t FROM pages)"


_PLANTED = """<nav>x<nav>y</nav>z</nav><p title="a>b</article>">1 < 2 &eacute;</p><footer><script>'</footer>'</script></footer>"""


def _structure_sql() -> str:
    """Lines of the page without what is planted, and the planted line in front."""
    plain = _main_text_sql().replace("SELECT page_id, sha256(", "SELECT page_id, html, (", 1).replace("SELECT page_id, regexp", "SELECT page_id, html, regexp", 1)
    return f"SELECT page_id, sha256(CASE WHEN contains(html,'<article>') THEN '1 < 2 é'||chr(10) ELSE '' END||digest) AS digest FROM ({plain})"


@query("L6", _structure_sql())
def main_texts_by_structure(spark, sf):
    """Pages with nested, quoted and script-held tags planted in their articles."""
    pages = table(spark, sf, "pages").select("page_id", F.replace("html", F.lit("<article>"), F.lit("<article>" + _PLANTED)).alias("html"))
    return pagetext.structured_texts(pages).select("page_id", F.sha2("main_text", 256).alias("digest"))


@query("L6", _main_text_sql())
def main_texts(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2(webpages.main_text("html"), 256).alias("digest"))


_PAGED = "replace(text,chr(10),chr(12))"
_BLANK = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


@query(
    "L7",
    f"""SELECT doc_id, CAST(i AS INTEGER) AS source_page, sha256(seg) AS digest FROM (SELECT doc_id, i, trim(p[i],{_BLANK}) seg FROM (SELECT doc_id, p, unnest(range(1,len(p)+1)) i FROM (SELECT doc_id, string_split({_PAGED},chr(12)) p FROM documents))) WHERE length(seg)>0""",
)
def document_segments(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\f")).alias("text"))
    return webpages.page_segments(docs).select("doc_id", "source_page", F.sha2("segment", 256).alias("digest"))


@query(
    "L8",
    f"""WITH d AS (SELECT doc_id, source, sha256({_PAGED}) sha, string_split({_PAGED},chr(12)) p FROM documents),
    s AS (SELECT * FROM (SELECT doc_id, i, trim(p[i],{_BLANK}) seg FROM (SELECT doc_id, p, unnest(range(1,len(p)+1)) i FROM d)) WHERE length(seg)>0),
    b AS (SELECT doc_id, count(*) n, string_agg('<!-- source-page: '||i||' -->'||chr(10)||chr(10)||seg, chr(10)||chr(10) ORDER BY i) body FROM s GROUP BY 1)
    SELECT d.doc_id, CAST(coalesce(n,0) AS INTEGER) AS page_segments, sha AS source_sha256,
    sha256('---'||chr(10)||'role: codebook'||chr(10)||'source_file: '||source||'.txt'||chr(10)||'source_sha256: '||sha||chr(10)||'extraction_method: direct-text'||chr(10)||'---'||chr(10)||chr(10)||coalesce(body,'')||chr(10)) AS digest
    FROM d LEFT JOIN b ON d.doc_id=b.doc_id""",
)
def document_sidecars(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.lit("codebook").alias("role"),
        F.concat("source", F.lit(".txt")).alias("file"),
        F.replace("text", F.lit("\n"), F.lit("\f")).alias("text"),
    )
    side = webpages.doc_sidecar(docs, "role", "file", "direct-text", keep=["doc_id"])
    return side.select("doc_id", "page_segments", "source_sha256", F.sha2("markdown", 256).alias("digest"))


@query(
    "L9",
    """SELECT CAST(count(*) AS BIGINT) AS denied FROM pages WHERE page_id%25=0 OR regexp_matches(lower(html),'page not found|access denied')""",
)
def denial_pages(spark, sf):
    html = F.when(F.col("page_id") % 25 == 0, F.concat("html", F.lit("<p>Access Denied</p>"))).otherwise(F.col("html"))
    return table(spark, sf, "pages").filter(webpages.denial_page(html)).agg(F.count(F.lit(1)).alias("denied"))


# --- catalog --------------------------------------------------------------------------------------------

CATALOGED = ("orders", "lineitem", "customer", "part")


def variables(spark, sf):
    tables = [(t, 2024, f"{t}-2024-0", f"{t}.parquet", table(spark, sf, t)) for t in CATALOGED]
    return catalog.catalog_variables(spark, tables)


@query(
    "K8",
    """SELECT table_name||'.parquet' AS source_file, column_name AS variable_name, n AS n_rows FROM information_schema.columns JOIN (
    SELECT 'orders' t, count(*) n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'part', count(*) FROM part) ON table_name=t""",
)
def catalog_variables(spark, sf):
    counts = None
    for t in CATALOGED:
        one = file_inventory(spark, f"{sf}/{t}.parquet")
        counts = one if counts is None else counts.unionByName(one)
    joined = variables(spark, sf).join(counts, F.col("source_file") == F.col("file"))
    return joined.select("source_file", "variable_name", "n_rows")


@query(
    "K9",
    """SELECT 'acs' AS survey, CAST(2024 AS INTEGER) AS year, CAST(sum(length(text)+1) AS BIGINT) AS characters FROM documents""",
)
def catalog_documents(spark, sf):
    path = new_scratch_path(spark, "k9")
    table(spark, sf, "documents").select("text", "lang").write.partitionBy("lang").text(path)
    docs = catalog.read_documents(spark, path, "acs", 2024, "acs-2024-0")
    return docs.groupBy("survey", "year").agg(F.sum(F.length("content")).alias("characters"))


@query(
    "K10",
    """SELECT table_name AS survey, CAST(2024 AS INTEGER) AS year, column_name AS variable_name, n AS n_rows FROM information_schema.columns JOIN (
    SELECT 'orders' t, count(*) n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'part', count(*) FROM part) ON table_name=t
    WHERE contains(lower(column_name),'price')""",
)
def variable_search(spark, sf):
    counts = None
    for t in CATALOGED:
        one = file_inventory(spark, f"{sf}/{t}.parquet")
        counts = one if counts is None else counts.unionByName(one)
    hits = catalog.search_variables(variables(spark, sf), "PRICE")
    return hits.join(counts, F.col("source_file") == F.col("file")).select("survey", "year", "variable_name", "n_rows")


def _documents(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("source").alias("survey"),
        (2000 + F.col("doc_id") % 20).cast("int").alias("year"),
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("release_id"),
        F.col("lang").alias("document_role"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"),
        F.col("text").alias("content"),
    )


_SNIP = "trim(regexp_replace(substr(text, greatest(1, strpos(lower(text),'the ')-160), 420),'\\s+',' ','g'))"


@query(
    "K11 E11",
    f"""SELECT source AS survey, doc_id||'.txt' AS source_file, {_SNIP} AS snippet FROM documents WHERE contains(lower(text),'the ')""",
)
def document_search(spark, sf):
    return catalog.search_documents(_documents(spark, sf), "The ").select("survey", "source_file", "snippet")


@query(
    "K12 G4",
    f"""WITH v AS (SELECT 'variable' kind, table_name survey, column_name AS name, '' AS source_file, '' AS snippet FROM information_schema.columns WHERE table_name IN ('orders','lineitem','customer','part') AND contains(lower(column_name),'the ')),
    d AS (SELECT 'document' kind, source survey, lang AS name, doc_id||'.txt' source_file, {_SNIP} snippet, row_number() OVER (ORDER BY source, 2000+doc_id%20 DESC, lang, doc_id||'.txt') rn FROM documents WHERE contains(lower(text),'the '))
    SELECT kind, survey, source_file, snippet FROM v UNION ALL SELECT kind, survey, source_file, snippet FROM d WHERE rn<=25-(SELECT count(*) FROM v)""",
)
def catalog_search(spark, sf):
    hits = catalog.search_catalog(variables(spark, sf), _documents(spark, sf), "the ", 25)
    return hits.select("kind", "survey", "source_file", F.coalesce("snippet", F.lit("")).alias("snippet"))


@query(
    "K12 G4",
    """SELECT kind, name FROM (SELECT 'variable' kind, column_name AS name FROM information_schema.columns WHERE table_name IN ('orders','lineitem','customer','part') AND contains(column_name,'o'))
    UNION ALL SELECT 'document', name FROM (SELECT 'd' kind, lang AS name, row_number() OVER (ORDER BY source, 2000+doc_id%20 DESC, lang, doc_id||'.txt') rn FROM documents WHERE contains(lower(text),'o'))
    WHERE rn<=greatest(0, 30-(SELECT count(*) FROM information_schema.columns WHERE table_name IN ('orders','lineitem','customer','part') AND contains(column_name,'o')))""",
)
def catalog_search_mixed(spark, sf):
    hits = catalog.search_catalog(variables(spark, sf), _documents(spark, sf), "O", 30)
    return hits.select("kind", F.coalesce("name", "role").alias("name"))


_LEDGER_HITS = f"""d AS (SELECT 'document' AS kind, source AS survey, lang AS name, doc_id||'.txt' AS source_file, {_SNIP} AS snippet,
    row_number() OVER (ORDER BY source, 2020+doc_id%2 DESC, lang, doc_id||'.txt') rn FROM documents WHERE contains(lower(text),'the '))"""


@query(
    "K8 K9 K11 K12",
    f"""WITH {_LEDGER_HITS} SELECT 'the ' AS wanted, kind, survey, name, source_file, snippet FROM d WHERE rn<=25
    UNION ALL SELECT 'NATION', 'variable', table_name, column_name, table_name||'-2024.parquet', '' FROM information_schema.columns WHERE table_name IN ('customer','supplier') AND contains(lower(column_name),'nation')
    UNION ALL SELECT 'all', 'variable', table_name, column_name, table_name||'-2024.parquet', '' FROM information_schema.columns WHERE table_name IN ('customer','supplier')""",
)
def ledger_catalog_search(spark, sf):
    """Documents and tables go to a ledger, the catalog follows it, and searches go through its postings."""
    ledger = Ledger(spark, new_scratch_path(spark, "catalog"))
    index = CatalogIndex(ledger)
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("survey"), (2020 + F.col("doc_id") % 2).cast("int").alias("year"), F.col("lang").alias("document_role"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), F.col("text").alias("content"),
    )
    ledger.promote(docs, [non_empty()], "documents")
    index.update()
    for name in ("customer", "supplier"):
        rows = table(spark, sf, name).select("*", F.lit(name).alias("survey"), F.lit(2024).alias("year"))
        ledger.promote(rows, [non_empty()], name)
    index.update()
    shown = lambda wanted, hits: hits.select(F.lit(wanted).alias("wanted"), "kind", "survey", F.coalesce("name", "role").alias("name"), "source_file", F.coalesce("snippet", F.lit("")).alias("snippet"))
    every = index.variables().select(F.lit("all").alias("wanted"), F.lit("variable").alias("kind"), "survey", F.col("variable_name").alias("name"), "source_file", F.lit("").alias("snippet"))
    return shown("the ", index.search("the ", 25)).unionAll(shown("NATION", index.search("NATION", 100).filter("kind = 'variable'"))).unionAll(every)
