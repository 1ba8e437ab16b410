"""Ledger, integrity, backfill and streaming ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates as G
from ..operators import ledger as L
from ..operators.files import list_files
from ..operators.ledger import Ledger
from ..operators.joins import with_one_row
from ..plans.scratch import new_scratch_path
from ..streaming.ingest import ingest_releases, release_stream
from ..streaming.pieces import file_stream, ingest_pieces, waiting_releases
from .contracts import shown
from .registry import query, table

KEYS = ["survey", "year"]


def fingerprint_sql(fields: list[str], source: str, by: str) -> str:
    """``by``, row count and fingerprint of ``name=value`` fields, in name order."""
    text = "concat_ws(chr(31)," + ",".join(f"'{len(n)}:{n}='||length(CAST({e} AS VARCHAR))||':'||CAST({e} AS VARCHAR)" for n, e in (f.split(":", 1) for f in sorted(fields))) + ")"
    return f"""SELECT {by}, n AS n_rows, sha256(n||':'||s) AS sha256 FROM (SELECT {by}, count(*) n, CAST(sum(CAST(('0x'||substr(sha256({text}),1,12)) AS BIGINT)) AS VARCHAR) s FROM {source} GROUP BY ALL)"""


def digest_sql(sha: str, role: str = "table") -> str:
    return f"sha256('release-schema:2'||chr(10)||'{role}:'||{sha}||chr(10))"


def releases(spark, sf):
    """Documents as survey releases: source and year, with their rows."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("survey"), (2020 + F.floor(F.col("doc_id") / 20) % 2).cast("int").alias("year"), "doc_id", "lang", "n_chars"
    )


_DOCS = "(SELECT source AS survey, CAST(2020+(doc_id//20)%2 AS INTEGER) AS year, doc_id, lang, n_chars FROM documents)"
_PRINT = fingerprint_sql(["doc_id:doc_id", "lang:lang", "n_chars:n_chars"], _DOCS, "survey, year")


@query("K2 I7", _PRINT)
def release_fingerprints(spark, sf):
    return L.table_fingerprint(releases(spark, sf), KEYS)


_ART = fingerprint_sql(["doc_id:doc_id", "n_chars:n_chars"], _DOCS, "survey, year, lang")


@query(
    "K2 K3",
    f"""SELECT survey, year, d AS digest, survey||'-'||year||'-'||substr(d,1,12) AS release_id FROM (
    SELECT survey, year, sha256('release-schema:2'||chr(10)||string_agg(lang||':'||sha256||chr(10),'' ORDER BY lang)) d FROM ({_ART}) GROUP BY 1,2)""",
)
def release_digests(spark, sf):
    """One artifact per language: its fingerprint under the language as role."""
    artifacts = L.table_fingerprint(releases(spark, sf), [*KEYS, "lang"]).withColumnRenamed("lang", "role")
    return L.release_digests(artifacts)


@query("K1", "SELECT lang, CAST(sum(strlen(text)+1) AS BIGINT) AS bytes, true AS hashed FROM documents GROUP BY 1")
def file_manifest(spark, sf):
    path = new_scratch_path(spark, "k1")
    table(spark, sf, "documents").select("text", "lang").write.partitionBy("lang").text(path)
    manifest = L.artifact_manifest(spark, path).filter(F.col("filename").startswith("part-"))
    lang = F.regexp_extract("path", "lang=([^/]*)", 1)
    return manifest.groupBy(lang.alias("lang")).agg(
        F.sum("bytes").alias("bytes"), F.bool_and(F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("hashed")
    )


@query(
    "K4",
    f"""SELECT survey, year, CASE WHEN survey='src5' THEN 'new' WHEN survey LIKE 'src1%' THEN 'changed' ELSE 'unchanged' END AS change FROM {_DOCS} GROUP BY ALL""",
)
def detected_revisions(spark, sf):
    """The current ledger lacks one survey and holds other bytes for some."""
    prints = L.table_fingerprint(releases(spark, sf), KEYS).withColumn("role", F.lit("table"))
    new = L.release_digests(prints)
    old = releases(spark, sf).filter("survey <> 'src5'").withColumn(
        "n_chars", F.when(F.col("survey").startswith("src1"), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    )
    current = L.release_digests(L.table_fingerprint(old, KEYS).withColumn("role", F.lit("table")))
    return L.detect_revision(new, current).select(*KEYS, "change")


def _two_loads(spark, sf, minimum: int = 24) -> Ledger:
    """Load all releases, then load them again with one survey revised."""
    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    rows = releases(spark, sf)
    ledger.promote(rows, [G.row_minimum(minimum), G.non_empty()], "first", 1)
    revised = rows.withColumn("n_chars", F.when(F.col("survey") == "src2", F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    ledger.promote(revised, [G.row_minimum(minimum), G.non_empty()], "second", 2)
    return ledger


_REVISED = "(SELECT survey, year, doc_id, lang, CASE WHEN survey='src2' THEN n_chars+1 ELSE n_chars END n_chars FROM " + _DOCS + ")"
_PRINT2 = fingerprint_sql(["doc_id:doc_id", "lang:lang", "n_chars:n_chars"], _REVISED, "survey, year")
_LEDGER = f"""SELECT survey, year, {digest_sql('sha256')} digest, 1 seq, n_rows, 'new' AS change, CASE WHEN n_rows>=24 THEN 'promoted' ELSE 'quarantined' END status FROM ({_PRINT})
    UNION ALL SELECT survey, year, {digest_sql('sha256')}, 2, n_rows, CASE WHEN n_rows<24 THEN 'new' WHEN survey='src2' THEN 'changed' ELSE 'unchanged' END,
    CASE WHEN n_rows<24 THEN 'quarantined' WHEN survey='src2' THEN 'promoted' ELSE 'already-current' END FROM ({_PRINT2})"""


@query(
    "K5",
    f"SELECT survey, year, digest, survey||'-'||year||'-'||substr(digest,1,12) AS release_id, status, change, n_rows, CAST(seq AS BIGINT) AS seq FROM ({_LEDGER})",
)
def promoted_releases(spark, sf):
    return _two_loads(spark, sf).releases().drop("load")


@query(
    "K14",
    f"SELECT survey, year, digest FROM (SELECT *, row_number() OVER (PARTITION BY survey ORDER BY seq DESC, year DESC) rn FROM ({_LEDGER}) WHERE status='promoted') WHERE rn=1",
)
def current_status(spark, sf):
    return _two_loads(spark, sf).current().select("survey", "year", "digest")


@query(
    "K7",
    f"""SELECT survey, year, gate, CASE WHEN gate='row_minimum' AND n<26 THEN 'fail' ELSE 'pass' END AS status, CAST(n AS DOUBLE) AS observed FROM (SELECT survey, year, count(*) n FROM {_DOCS} GROUP BY 1,2), (VALUES ('row_minimum'),('non_empty')) g(gate) WHERE n>=24""",
)
def revalidated_releases(spark, sf):
    checks = _two_loads(spark, sf).revalidate([G.row_minimum(26), G.non_empty()], "again")
    return checks.select(*KEYS, "gate", "status", "observed")


@query(
    "K15",
    f"""SELECT lang, count(*) AS n, CAST(sum(n_chars+1) AS BIGINT) AS chars, 'pass' AS status FROM {_DOCS} WHERE survey='src2' AND year=2021 GROUP BY 1""",
)
def pinned_release(spark, sf):
    """Pin the current release of one survey and read it through the ledger."""
    ledger = _two_loads(spark, sf, minimum=1)
    pinned = ledger.current().filter("survey = 'src2'").first()
    gate = L.require_release(ledger.releases(), "src2", pinned["release_id"], pinned["digest"]).select("status")
    rows = ledger.read("src2").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    return with_one_row(rows, gate)


@query(
    "K6 C10",
    f"""WITH a AS (SELECT DISTINCT survey, year, lang FROM {_DOCS})
    SELECT 'sha256 mismatch' AS error, survey, year, lang AS subject FROM a WHERE survey='src2' AND lang='fr'
    UNION ALL SELECT 'byte count mismatch', survey, year, lang FROM a WHERE survey='src3' AND lang='en'
    UNION ALL SELECT 'missing file', survey, year, lang FROM a WHERE survey='src4' AND lang='de'
    UNION ALL SELECT 'unrecorded file', survey, year, 'extra' FROM a WHERE survey='src6' GROUP BY ALL
    UNION ALL SELECT 'pointer year mismatch', survey, 1999, 'pointer' FROM a WHERE survey='src7' AND year=2020 GROUP BY ALL
    UNION ALL SELECT 'pointer release_id mismatch', survey, 1999, 'pointer' FROM a WHERE survey='src7' AND year=2020 GROUP BY ALL
    UNION ALL SELECT 'pointer target is no release', survey, 2020, 'lost' FROM a WHERE survey='src8' AND year=2020 GROUP BY ALL""",
)
def scrubbed_ledger(spark, sf):
    """One artifact per language; a few are changed, lost or added behind the ledger's back."""
    prints = L.table_fingerprint(releases(spark, sf), [*KEYS, "lang"]).withColumnRenamed("lang", "role")
    digests = L.release_digests(prints)
    ledger_rows = digests.withColumn("status", F.lit(L.PROMOTED))
    artifacts = prints.join(digests, KEYS).select(*KEYS, "digest", "role", F.col("n_rows").alias("bytes"), "sha256")
    is_ = lambda s, r: (F.col("survey") == s) & (F.col("role") == r)
    actual = artifacts.filter(~is_("src4", "de")).withColumns(
        {
            "sha256": F.when(is_("src2", "fr"), F.lit("tampered")).otherwise(F.col("sha256")),
            "bytes": F.when(is_("src3", "en"), F.col("bytes") + 1).otherwise(F.col("bytes")),
        }
    )
    extra = artifacts.filter("survey = 'src6'").select(*KEYS, "digest", F.lit("extra").alias("role"), F.lit(1).cast("bigint").alias("bytes"), F.lit("x").alias("sha256")).distinct()
    first = digests.filter("year = 2020")
    pointers = first.filter("survey = 'src7'").select(
        "survey", F.lit(1999).alias("year"), F.lit("pointer").alias("release_id"), "digest"
    ).unionByName(
        first.filter("survey = 'src8'").select("survey", "year", F.lit("lost").alias("release_id"), F.lit("gone").alias("digest"))
    )
    return L.scrub(ledger_rows, artifacts, actual.unionByName(extra), pointers)


@query("K6", "SELECT (SELECT count(*) FROM documents) AS n_rows, CAST(0 AS BIGINT) AS errors")
def scrubbed_storage(spark, sf):
    """A ledger that nothing has touched scrubs clean."""
    errors = _two_loads(spark, sf).scrub().agg(F.count(F.lit(1)).alias("errors"))
    return with_one_row(table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n_rows")), errors)


def lanes_sql(fields: list[str], source: str, by: str) -> str:
    """Row count and four 64-bit sums of row hashes per group, as text."""
    text = "concat_ws(chr(31)," + ",".join(f"'{len(n)}:{n}='||length(CAST({e} AS VARCHAR))||':'||CAST({e} AS VARCHAR)" for n, e in (f.split(":", 1) for f in sorted(fields))) + ")"
    lanes = ", ".join(f"CAST(sum(CAST(('0x'||substr(h,{1 + 16 * i},16)) AS UBIGINT)) % 18446744073709551616 AS VARCHAR) AS lane{i}" for i in range(4))
    return f"SELECT {by}, count(*) AS n_rows, {lanes} FROM (SELECT {by}, sha256({text}) h FROM {source}) GROUP BY ALL"


@query("K2 K5", lanes_sql(["doc_id:doc_id", "lang:lang", "n_chars:n_chars"], _DOCS, "survey, year"))
def release_lanes(spark, sf):
    """Sums of the stored files of each release; the rows are hashed once, when a load stores them."""
    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    ledger.promote(releases(spark, sf), [G.non_empty()], "first", 1)
    sums = L.joined_lanes(ledger.lanes(), KEYS)
    return sums.select(*KEYS, "n_rows", *[F.col(c).cast("string").alias(c) for c in L.LANES])


@query(
    "K6",
    f"""SELECT survey, year, CASE WHEN survey='src3' THEN 'row count mismatch' ELSE 'row mismatch' END AS error FROM {_DOCS} WHERE survey IN ('src2','src3') GROUP BY ALL
    HAVING survey='src2' OR count_if(doc_id%3=0)>0""",
)
def scrubbed_rows(spark, sf):
    """Recorded sums against rows of which one survey's were changed and another's thinned out."""
    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    rows = releases(spark, sf)
    ledger.promote(rows, [G.non_empty()], "first", 1)
    changed = rows.filter("NOT (survey = 'src3' AND doc_id % 3 = 0)").withColumn(
        "n_chars", F.when(F.col("survey") == "src2", F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    )
    now = L.row_lanes(changed, KEYS, ["doc_id", "lang", "n_chars"])
    return L.lane_errors(L.joined_lanes(ledger.lanes(), KEYS), now, KEYS).select(*KEYS, "error")


@query(
    "K13 E12",
    f"""SELECT survey, year FROM {_DOCS} WHERE NOT (survey LIKE 'src1%' AND year=2020) AND NOT (survey='src2') GROUP BY ALL""",
)
def backfill_plan(spark, sf):
    """``src1*`` of 2020 is promoted and ``src2`` logged as done; ``src3`` failed and stays planned."""
    available = releases(spark, sf).select(*KEYS).distinct()
    promoted = available.filter("survey LIKE 'src1%' AND year = 2020").withColumn("status", F.lit(L.PROMOTED))
    log = available.filter("survey IN ('src2', 'src3')").withColumn(
        "status", F.when(F.col("survey") == "src2", F.lit(L.UNCHANGED)).otherwise(F.lit("failed"))
    )
    return L.backfill_plan(available, promoted, log)


_EVENTS = "(SELECT event_type AS survey, CAST(year(ts) AS INTEGER) AS year, event_id, user_id FROM events)"
_EPRINT = fingerprint_sql(["event_id:event_id", "user_id:user_id"], _EVENTS, "survey, year")


@query(
    "S1 K5",
    f"""SELECT survey, year, {digest_sql('sha256')} AS digest, 'promoted' AS status, n_rows, CAST(1 AS BIGINT) AS loads FROM ({_EPRINT})""",
)
def streamed_releases(spark, sf):
    """Ingest the event file as a stream, twice with one checkpoint: the second run finds nothing."""
    root = new_scratch_path(spark, "stream")
    ledger = Ledger(spark, f"{root}/ledger")
    schema = table(spark, sf, "events").schema

    def prepare(batch):
        return batch.select(F.col("event_type").alias("survey"), F.year("ts").alias("year"), "event_id", "user_id")

    for _ in range(2):
        stream = release_stream(spark, sf, schema, pathGlobFilter="events.parquet")
        ingest_releases(stream, ledger, [G.non_empty(), G.key_non_null(["event_id"])], f"{root}/checkpoint", prepare=prepare).awaitTermination()
    rows = ledger.releases()
    loads = rows.groupBy(*KEYS).agg(F.countDistinct("load").alias("loads"))
    return rows.join(loads, KEYS).select(*KEYS, "digest", "status", "n_rows", "loads")


@query(
    "K5 J26",
    f"""SELECT survey, year, gate, CASE WHEN gate='row_minimum' AND n<24 THEN 'fail' ELSE 'pass' END AS status, CAST(n AS DOUBLE) AS observed FROM (SELECT survey, year, count(*) n FROM {_DOCS} GROUP BY 1,2), (VALUES ('row_minimum'),('non_empty')) g(gate)""",
)
def recorded_checks(spark, sf):
    ledger = Ledger(spark, new_scratch_path(spark, "ledger"))
    ledger.promote(releases(spark, sf), [G.row_minimum(24), G.non_empty()], "first", 1)
    return shown(ledger.checks().drop("load")).select(*KEYS, "gate", "status", "observed")


_MEMBERS = ["m0", "m1", "m2"]
_PIECES = "(SELECT event_type AS survey, CAST(year(ts) AS INTEGER) AS year, event_id, user_id, month(ts)%3 AS m FROM events)"
_WHOLE = f"(SELECT survey, year FROM {_PIECES} WHERE survey<>'error' OR m<>2 GROUP BY 1,2 HAVING count(DISTINCT m)=3)"


@query(
    "S1 K5 J29",
    f"""SELECT survey, year, {digest_sql('sha256')} AS digest, 'promoted' AS status, 'new' AS change, n_rows, CAST(0 AS BIGINT) AS waiting FROM ({_EPRINT}) JOIN {_WHOLE} USING (survey, year)
    UNION ALL SELECT survey, year, NULL, NULL, NULL, NULL, CAST(3-count(DISTINCT m) AS BIGINT) FROM {_PIECES} WHERE survey<>'error' OR m<>2 GROUP BY 1,2 HAVING count(DISTINCT m)<3""",
)
def pieced_releases(spark, sf):
    """Events as releases of three member files each, which arrive in three runs; a survey's last member never comes."""
    root = new_scratch_path(spark, "pieces")
    ledger = Ledger(spark, f"{root}/ledger")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("survey"), F.year("ts").alias("year"), F.concat(F.lit("m"), F.month("ts") % 3).alias("member"), "event_id", "user_id"
    )
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)", 1)
    for member in _MEMBERS:
        # One file per member: rows of a member meet in one task.
        arriving = rows.filter((F.col("member") == member) & ~((F.col("survey") == "error") & (F.col("member") == "m2")))
        arriving.repartition("survey", "year", "member").write.mode("append").partitionBy("survey", "year", "member").parquet(f"{root}/in")
        files = file_stream(spark, f"{root}/in", part("survey"), part("year"), part("member"), glob="part-*")
        read = lambda s, paths: s.read.parquet(*paths).select("event_id", "user_id")
        ingest_pieces(files, ledger, [G.non_empty(), G.key_non_null(["event_id"])], f"{root}/checkpoint", _MEMBERS, read).awaitTermination()
    whole = ledger.releases().select(*KEYS, "digest", "status", "change", "n_rows", F.lit(0).cast("long").alias("waiting"))
    missing = waiting_releases(spark, f"{root}/checkpoint", _MEMBERS).select(
        *KEYS, *[F.lit(None).cast("string").alias(c) for c in ("digest", "status", "change")], F.lit(None).cast("long").alias("n_rows"), F.size("missing").cast("long").alias("waiting")
    )
    return whole.unionByName(missing)


@query(
    "K1 K5 K6",
    f"""SELECT survey, year, CAST(CASE WHEN n_rows<24 OR survey='src2' THEN 2 ELSE 1 END AS BIGINT) AS copies, true AS recorded, CAST(0 AS BIGINT) AS errors FROM ({_PRINT})""",
)
def stored_files(spark, sf):
    """Loads that hold files of each release after two loads, whether the ledger has their digests, and file errors.
    Content that was current already has one copy."""
    ledger = _two_loads(spark, sf)
    named = lambda c: F.regexp_extract("path", f"/{c}=([^/]*)/", 1)
    found = list_files(spark, f"{ledger.root}/data", "part-*").select(named("survey").alias("survey"), named("year").cast("int").alias("year"), named("load").alias("load"))
    copies = found.groupBy(*KEYS).agg(F.countDistinct("load").alias("copies"))
    recorded = ledger.files().groupBy(*KEYS).agg(F.bool_and((F.col("bytes") > 0) & F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("recorded"))
    return with_one_row(copies.join(recorded, KEYS), ledger.scrub_files().agg(F.count(F.lit(1)).alias("errors")))
