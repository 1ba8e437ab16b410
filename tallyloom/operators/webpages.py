"""Page and document jobs: links, releases on landing pages, main text, page segments.

All of it is text functions inside generated code; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ColumnLike, col
from ..functions.text import collapse_whitespace, content_sha256, decode_entities, let, strip, trimmed_lines
from .joins import with_one_row

_TARGET = r"""(["'][^"']+["']|[^\s"'>]+)"""
ANCHOR = rf"""(?is)<a\s[^>]*?href\s*=\s*{_TARGET}[^>]*>.*?</a>"""
HREF = rf"""(?is)^<a\s[^>]*?href\s*=\s*{_TARGET}"""

# Elements without readable text.
DROPPED_ELEMENTS = ("script", "style", "noscript", "nav", "header", "footer")
# Elements holding the main text, best first.
MAIN_ELEMENTS = ("main", "article", "body")


def strip_tags(c: ColumnLike, by: str = " ") -> Column:
    return F.regexp_replace(col(c), "<[^>]*>", by)


def resolve_url(href: ColumnLike, base: ColumnLike) -> Column:
    """Absolute URL of a link: absolute, scheme-relative, root-relative, fragment or relative."""
    return let(col(href), lambda h: _resolve(h, F.regexp_replace(col(base), "#.*$", "")))


def _without_dots(url: Column) -> Column:
    """``.`` and ``..`` segments of the path worked out; ``..`` at the root is dropped."""
    parts = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
    segments = F.split(F.regexp_extract(url, parts, 2), "/")
    last = F.element_at(segments, -1)
    # A path that ends in a dot segment ends in its folder.
    closed = F.when(last.isin(".", ".."), F.array_append(segments, F.lit(""))).otherwise(segments)
    kept = F.aggregate(
        closed,
        F.array().cast("array<string>"),
        lambda out, s: F.when(s == ".", out)
        .when(s == "..", F.when(F.size(out) > 1, F.slice(out, 1, F.size(out) - 1)).otherwise(out))
        .otherwise(F.array_append(out, s)),
    )
    clean = F.concat(F.regexp_extract(url, parts, 1), F.array_join(kept, "/"), F.regexp_extract(url, parts, 3))
    return F.when(url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/\.{1,2}(/|[?#]|$)"), clean).otherwise(url)


def _resolve(href: Column, base: Column) -> Column:
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    path = F.regexp_replace(base, r"\?.*$", "")
    at_root = path.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$")
    folder = F.when(at_root, F.concat(path, F.lit("/"))).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), let(F.concat(root, href), _without_dots))
        .when(href.startswith("#"), F.concat(base, href))
        .when(href.startswith("?"), F.concat(path, href))
        .otherwise(let(F.concat(folder, href), _without_dots))
    )


def extract_links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per anchor: page, absolute URL and tag-free label."""
    anchors = pages.select(page, url, F.explode(F.regexp_extract_all(html, F.lit(ANCHOR), 0)).alias("__a"))
    label = F.regexp_replace(F.regexp_replace(F.col("__a"), r"(?is)^<a\s[^>]*>", ""), r"(?is)</a>$", "")
    return anchors.select(
        page,
        resolve_url(decode_entities(F.trim(F.btrim(F.regexp_extract("__a", HREF, 1), F.lit("\"'")))), F.col(url)).alias("link"),
        collapse_whitespace(decode_entities(strip_tags(label))).alias("label"),
    )


@dataclass(frozen=True)
class LinkRole:
    """A link pattern; ``year_group`` is the group of the year, 0 for roles shared by all years."""

    role: str
    pattern: str
    year_group: int = 0


def link_path(link: ColumnLike) -> Column:
    """Path of a URL without host, query and fragment, percent-decoded."""
    path = F.regexp_replace(F.regexp_replace(col(link), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def classify_links(links: DataFrame, roles: Sequence[LinkRole], link: str = "link") -> DataFrame:
    """Role and year of each link from its path; the first matching pattern wins."""
    def match(path: Column) -> Column:
        role, year = F.lit(None).cast("string"), F.lit(None).cast("int")
        for r in reversed(roles):
            hit = path.rlike(r.pattern)
            found = (
                F.regexp_extract(path, r.pattern, r.year_group).try_cast("int")
                if r.year_group
                else F.lit(None).cast("int")
            )
            role, year = F.when(hit, F.lit(r.role)).otherwise(role), F.when(hit, found).otherwise(year)
        return F.struct(role.alias("role"), year.alias("year"))

    matched = links.withColumn("__m", let(link_path(link), match))
    return matched.select(*links.columns, "__m.role", "__m.year").filter(F.col("role").isNotNull())


def complete_releases(classified: DataFrame, required: Sequence[str], keys: Sequence[str] = ("year",)) -> DataFrame:
    """Releases that have every required role. A role without a year counts for all of them.

    Links reduce to one row per release and role before anything is counted.
    """
    keys = list(keys)
    have = classified.filter(F.col("role").isin(*required)).select(*keys, "role").distinct()
    shared = have.filter(F.col("year").isNull()).agg(
        *[F.coalesce(F.max(F.when(F.col("role") == F.lit(r), F.lit(1))), F.lit(0)).alias(f"__s{i}") for i, r in enumerate(required)]
    )
    own = have.filter(F.col("year").isNotNull()).groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(F.col("role") == F.lit(r), F.lit(1))), F.lit(0)).alias(f"__o{i}") for i, r in enumerate(required)]
    )
    both = with_one_row(own, shared)
    n = sum((F.greatest(f"__s{i}", f"__o{i}") for i in range(len(required))), F.lit(0))
    return both.withColumn("__n", n).filter(F.col("__n") == len(required)).select(*keys)


def exactly_one(classified: DataFrame, keys: Sequence[str] = ("year", "role"), link: str = "link") -> DataFrame:
    """Distinct links per release and role, and whether there is exactly one."""
    counted = classified.select(*keys, link).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("unambiguous", F.col("n") == 1)


CELL = r"(?is)<t[dh]\b[^>]*>.*?</t[dh]>"


def sample_ids(pages: DataFrame, pattern: str, year_group: int, minimum_year: int, html: str = "html") -> DataFrame:
    """``(year, sample_id)`` from the first cell of each table row that matches the whole pattern."""
    rows = pages.select(F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), 0)).alias("__r"))
    cell = F.trim(decode_entities(strip_tags(F.regexp_extract("__r", CELL, 0), "")))
    whole = f"^(?:{pattern})$"
    ids = rows.select(cell.alias("sample_id")).filter(F.col("sample_id").rlike(whole))
    year = F.regexp_extract("sample_id", whole, year_group).try_cast("int")
    return ids.select(year.alias("year"), "sample_id").filter(F.col("year") >= minimum_year).distinct()


def _main_part(text: Column) -> Column:
    parts = [F.regexp_extract(text, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1) for tag in MAIN_ELEMENTS]
    # A page whose closing body tag is missing still has a body.
    open_body = F.regexp_extract(text, r"(?is)<body\b[^>]*>(.*)$", 1)
    found = F.filter(F.array(*parts, open_body, text), lambda p: p != F.lit(""))
    return F.coalesce(F.get(found, F.lit(0)), text)


def main_text(html: ColumnLike) -> Column:
    """Readable text of a page: one trimmed line per block, empty lines dropped."""
    text = F.regexp_replace(col(html), r"(?is)<!--.*?-->", "\n")
    for tag in DROPPED_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "\n")
    return trimmed_lines(decode_entities(strip_tags(let(text, _main_part), "\n")))


def denial_page(html: ColumnLike) -> Column:
    """Flags pages that report denial or absence instead of content."""
    return F.lower(col(html)).rlike("page not found|access denied")


def page_segments(docs: DataFrame, doc: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Non-empty pages of form-feed separated text, with their page numbers from 1."""
    pages = docs.select(doc, *keep, F.posexplode(F.split(text, "\f")).alias("__at", "__page"))
    return pages.select(
        doc, *keep, (F.col("__at") + 1).alias("source_page"), strip("__page").alias("segment")
    ).filter(F.length("segment") > 0)


def doc_sidecar(
    docs: DataFrame, role: str, filename: str, method: str, text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Metadata and front matter per document. Works inside each row, nothing is regrouped."""
    pages = F.transform(F.split(text, "\f"), strip)
    numbered = F.filter(
        F.transform(pages, lambda p, i: F.struct((i + 1).alias("n"), p.alias("t"))), lambda s: F.length(s["t"]) > 0
    )
    body = F.array_join(
        F.transform(
            numbered,
            lambda s: F.concat(F.lit("<!-- source-page: "), s["n"].cast("string"), F.lit(" -->\n\n"), s["t"]),
        ),
        "\n\n",
    )
    sha = content_sha256(text)
    header = F.concat(
        F.lit("---\nrole: "), F.col(role),
        F.lit("\nsource_file: "), F.col(filename),
        F.lit("\nsource_sha256: "), sha,
        F.lit(f"\nextraction_method: {method}\n---\n\n"),
    )
    return docs.select(
        *keep,
        F.col(role).alias("role"),
        F.col(filename).alias("source_file"),
        sha.alias("source_sha256"),
        F.lit(method).alias("extraction_method"),
        F.size(numbered).alias("page_segments"),
        F.concat(header, body, F.lit("\n")).alias("markdown"),
    )
