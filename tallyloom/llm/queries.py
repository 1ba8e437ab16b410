"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversation_repair import repair_of_damaged
from .decontamination import contamination
from .fingerprint import edited_likeness
from .fixity import audit, warc_record
from .importance import importance_ranks
from .mixing import curriculum
from .ngram_join import similar_groups
from .piece_codec import encoded
from .quality_model import learn, scored
from .quality_rules import ruled
from .substring_dedup import remove_repeats
from .token_count import token_counts
from .training_slots import training_shards

#: Fixed values of the public byte-level vocabulary.
END_OF_TEXT = {"<|endoftext|>": 50256}
#: The order of training is a function of this key and the stored sequences.
ORDER_KEY = 20_240_229


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return training_shards(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, ORDER_KEY)


def op2_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as an archive, and a replica in which some records are damaged, lost or strange."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    record = lambda i, h: warc_record(i, F.col("url"), h)
    primary = pages.select(F.col("page_id").alias("id"), record(F.col("page_id"), F.col("html")).alias("record"))
    html = F.when(F.col("page_id") % 997 == 5, F.concat(F.lit("~"), F.substr("html", F.lit(2)))).otherwise(F.col("html"))
    held = pages.filter(F.coalesce(F.col("page_id") % 1009 != 7, F.lit(True)))
    held = held.select(F.col("page_id").alias("id"), record(F.col("page_id"), html).alias("record"))
    strange = pages.filter(F.col("page_id") % 1013 == 9).select((-1 - F.col("page_id")).alias("id"), record(-1 - F.col("page_id"), F.col("html")).alias("record"))
    return audit(primary, held.union(strange))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = curriculum(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    # In the order of each document's first training position; what is not taken comes last, spread
    # over several ranges by a hash.
    rows = mix.withColumns({"first": F.get("__copies", F.lit(0))["position"], "spread": F.xxhash64("doc_id")})
    order = [F.col("first").asc_nulls_last(), F.col("spread")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
        F.size("__copies").cast("long").alias("n_copies"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, END_OF_TEXT)


def op6_similar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


def op7_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = ruled(docs, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans", "kept")


def op9_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_ranks(docs, table(spark, sf_dir, "benchmark").select("text")).drop("digest")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_of_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_training_shards, op2_fixity_audit, op3_quality_model, op4_curriculum_mix, op5_token_counts,
        op6_similar_groups, op7_certified_rules, op8_repeated_bytes, op9_chunk_fingerprints, op10_piece_codec,
        op11_decontamination, op12_importance_draw, op13_conversation_repair,
    )
}

_RECORD = """'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || {id} || '>' || chr(13) || chr(10)
 || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen({html}) || chr(13) || chr(10) || chr(13) || chr(10) || {html} || chr(13) || chr(10) || chr(13) || chr(10)"""
_DAMAGED = "(CASE WHEN page_id % 997 = 5 THEN '~' || substr(html, 2) ELSE html END)"
_LEVELS = ", ".join(f"bool_and(same) OVER (PARTITION BY \"offset\" >> {16 + 4 * k}) AS e{k + 1}" for k in range(8))
_TOP = "(SELECT max(k) FROM (SELECT CASE WHEN (SELECT max(\"offset\") FROM o) >> (16 + 4 * k) > 0 THEN k + 2 ELSE 1 END AS k FROM range(8) t(k)))"

#: Words of the contracts of op11 and op12.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: CRC-32 of byte strings in SQL: a table of 256 registers, then one byte of every string in each round.
_CRC_TABLE = "crc0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS v FROM range(256)), " + ", ".join(
    f"crc{k + 1} AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM crc{k})" for k in range(8)
)
_CRC_ROUNDS = """rounds(f, hx, i, c) AS (SELECT f, hex(encode(f)), 1, CAST(4294967295 AS BIGINT) FROM strings
  UNION ALL SELECT f, hx, rounds.i + 2, xor(c >> 8, v) FROM rounds JOIN crc8
   ON crc8.i = xor(c & 255, (strpos('0123456789ABCDEF', substr(hx, rounds.i, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(hx, rounds.i + 1, 1)) - 1) WHERE rounds.i < strlen(hx)),
 crc AS (SELECT f, xor(c, 4294967295) AS c FROM rounds WHERE i > strlen(hx))"""

#: In op13 a state's best path is its cost in nine digits and then its audit, so the least string is the answer.
_GROW = "lpad(CAST(CAST(substr({v}, 1, 9) AS BIGINT) + {k} AS VARCHAR), 9, '0') || substr({v}, 10) || '{l}'"
_D, _K, _R, _I = (lambda v, k=k, l=l: _GROW.format(v=v, k=k, l=l) for k, l in (("3", "D"), ("k", "K"), ("2 + k", "R"), ("2", "I")))
_REPAIR_STEP = f"""SELECT c, p, z, s, least(u, {_I("z")}, {_I("s")}, {_I("a")}) AS u, least(a, {_I("u")}, {_I(f"({_I('z')})")}, {_I(f"({_I('s')})")}) AS a FROM"""

ORACLES: dict[str, str] = {
    "op2_fixity_audit": f"""WITH p AS (SELECT page_id AS id, {_RECORD.format(id="page_id", html="html")} AS r FROM pages),
 q AS (SELECT page_id AS id, {_RECORD.format(id="page_id", html=_DAMAGED)} AS r FROM pages WHERE page_id % 1009 <> 7
   UNION ALL SELECT -1 - page_id, {_RECORD.format(id="(-1 - page_id)", html="html")} FROM pages WHERE page_id % 1013 = 9),
 o AS (SELECT id, CAST(sum(strlen(r)) OVER (ORDER BY id) - strlen(r) AS BIGINT) AS "offset", CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS digest FROM p),
 j AS (SELECT o.*, sha256(q.r) AS theirs, coalesce(sha256(q.r) = digest, false) AS same FROM o LEFT JOIN q USING (id)),
 l AS (SELECT *, {_LEVELS} FROM j)
 SELECT id, "offset", length, digest, CASE WHEN same THEN 'ok' WHEN theirs IS NULL THEN 'missing' ELSE 'changed' END AS status,
  CAST(CASE {" ".join(f"WHEN e{k} AND {k} <= {_TOP} THEN {k}" for k in range(8, 0, -1))} WHEN same THEN 0 END AS INTEGER) AS cleared_level FROM l
 UNION ALL SELECT id, NULL, CAST(strlen(r) AS BIGINT), sha256(r), 'extra', NULL FROM q WHERE id NOT IN (SELECT id FROM p)""",
    "op4_curriculum_mix": r"""WITH d AS (SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
 w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * n AS cap FROM s),
 f AS (SELECT *, CAST(cap AS DOUBLE) / CAST(w AS DOUBLE) AS fill FROM w),
 r AS (SELECT *, sum(n) OVER () - coalesce(sum(cap) OVER b, 0) AS words, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS weights FROM f
   WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 v AS (SELECT CAST(words AS DOUBLE) / CAST(weights AS DOUBLE) AS level FROM r WHERE CAST(words AS DOUBLE) / CAST(weights AS DOUBLE) <= fill ORDER BY fill, source NULLS LAST LIMIT 1),
 t AS (SELECT source, n, least(CAST(cap AS DOUBLE), (SELECT level FROM v) * CAST(w AS DOUBLE)) AS target FROM r),
 b AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS LAST, coalesce(md5(text), '')
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
 c AS (SELECT doc_id, size, n, target, [greatest(0, least(size, CAST(round(target) AS BIGINT) - (n * k + before))) FOR k IN [0, 1, 2]] AS words FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
 SELECT doc_id, size, n AS source_size, target, CAST(list_sum(words) AS BIGINT) AS taken, CAST(len([x FOR x IN words IF x > 0]) AS BIGINT) AS n_copies FROM c""",
    "op11_decontamination": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
 g AS (SELECT DISTINCT item, n, unnest([array_to_string(w[p:p + n - 1], ' ') FOR p IN range(1, len(w) - n + 2)]) AS gram
  FROM (SELECT *, least(len(w), 10) AS n FROM b) WHERE n > 0),
 o AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p, unnest([array_to_string(w[p:p + n - 1], ' ') FOR p IN range(1, len(w) - n + 2)]) AS gram
  FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
 h AS (SELECT o.r, o.p, o.n, g.item FROM o JOIN g USING (n, gram)),
 c AS (SELECT r, count(DISTINCT q) AS hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
 t AS (SELECT r, count(*) AS items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, hit IS NOT NULL AS contaminated FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)""",
    "op12_importance_draw": f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT {_WORDS} AS w FROM benchmark),
 df AS (SELECT r, unnest(list_concat(w, [w[p] || ' ' || w[p + 1] FOR p IN range(1, len(w))])) AS f FROM d),
 bf AS (SELECT unnest(list_concat(w, [w[p] || ' ' || w[p + 1] FOR p IN range(1, len(w))])) AS f FROM b),
 strings AS (SELECT f FROM df UNION SELECT f FROM bf), {_CRC_TABLE}, {_CRC_ROUNDS},
 k AS (SELECT f, c % 10000 AS bucket FROM crc),
 s AS (SELECT bucket, count(*) AS s FROM df JOIN k USING (f) GROUP BY bucket),
 t AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY bucket),
 n AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM s) AS DOUBLE) AS a, CAST((SELECT coalesce(sum(t), 0) FROM t) AS DOUBLE) AS b),
 g AS (SELECT bucket, CAST(floor(1000.0::DOUBLE * ln((coalesce(t, 0)::DOUBLE + 1) * (n.a + 10000) / ((s::DOUBLE + 1) * (n.b + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), n),
 m AS (SELECT r, CAST(count(*) AS BIGINT) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY r),
 h AS (SELECT d.*, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE AS h FROM d LEFT JOIN m USING (r)),
 x AS (SELECT *, weight + CAST(floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM h),
 y AS (SELECT *, len(w) >= 20 AS able, row_number() OVER (PARTITION BY len(w) >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place FROM x)
 SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= (SELECT count(*) FROM y WHERE able) * 25 // 100 THEN place END AS rank FROM y""",
    "op13_conversation_repair": f"""WITH RECURSIVE ids AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
 o AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(v.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS f
  FROM conversations v JOIN ids ON v.conv_id IS NOT DISTINCT FROM ids.conv_id),
 strings AS (SELECT DISTINCT f FROM o), {_CRC_TABLE}, {_CRC_ROUNDS},
 m AS (SELECT o.*, crc.c % 20 AS luck FROM o JOIN crc USING (f)),
 e AS (SELECT c, turn, CASE luck WHEN 4 THEN 'user' ELSE role END AS role, CASE luck WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE luck WHEN 3 THEN [1, 2] ELSE [1] END) AS time FROM m WHERE luck <> 0),
 w AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), time) AS p FROM e),
 x AS (SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY p) AS j, row_number() OVER (PARTITION BY c, role, text ORDER BY p) AS seen FROM w),
 y AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN seen > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault FROM x),
 q AS (SELECT *, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS k, fault IN (0, 3) AS ok FROM y),
 r AS ({_REPAIR_STEP} (SELECT DISTINCT c, 1 AS p, '000000000' AS z, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM q)
  UNION ALL {_REPAIR_STEP} (SELECT r.c, r.p + 1 AS p, {_D("z")} AS z,
   least({_D("s")}, CASE WHEN ok AND i = 's' THEN {_K("z")} END) AS s,
   least({_D("u")}, CASE WHEN ok THEN least({_R("z")}, {_R("s")}, {_R("a")}) END, CASE WHEN ok AND i = 'u' THEN least({_K("z")}, {_K("s")}, {_K("a")}) END) AS u,
   least({_D("a")}, CASE WHEN ok THEN {_R("u")} END, CASE WHEN ok AND i = 'a' THEN {_K("u")} END) AS a
   FROM r JOIN q ON q.c = r.c AND q.p = r.p)),
 b AS (SELECT c, least(z, a) AS best FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY p DESC) AS last FROM r) WHERE last = 1),
 l AS (SELECT c, unnest(range(1, length(best) - 8)) AS n, substr(best, 9 + unnest(range(1, length(best) - 8)), 1) AS act FROM b),
 a1 AS (SELECT *, sum(CASE WHEN act <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY n) AS p, sum(CASE WHEN act <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY n) AS pos FROM l),
 a2 AS (SELECT a1.c, n, act, pos, CASE WHEN act = 'I' THEN NULL ELSE role END AS role, CASE WHEN act = 'I' THEN '' ELSE text END AS text FROM a1 LEFT JOIN q ON q.c = a1.c AND q.p = a1.p WHERE act <> 'D'),
 a3 AS (SELECT *, max(CASE WHEN pos = 1 AND act = 'K' AND substr(role, 1, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c) AS led FROM a2),
 t AS (SELECT c, string_agg(CASE WHEN act = 'K' THEN role WHEN (pos - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n) AS told FROM a3 GROUP BY c),
 g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
  count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (p > 1 AND j || i NOT IN ('su', 'ua', 'au')) AS illegal FROM q GROUP BY c)
 SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(CAST(substr(best, 1, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
  FROM ids LEFT JOIN g USING (c) LEFT JOIN b USING (c) LEFT JOIN t USING (c)""",
}
