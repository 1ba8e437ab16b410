"""Joins, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import label_rank
from ..operators import joins, series
from .registry import cents, query, rounded, table


@query(
    "C1",
    """SELECT o_orderpriority, CAST(sum(c) AS BIGINT) AS cost_cents, CAST(sum(CASE WHEN c=0 THEN 1 ELSE 0 END) AS BIGINT) AS without FROM (
    SELECT o_orderpriority, coalesce(t.c,0) c FROM orders LEFT JOIN (SELECT l_orderkey, sum(round(l_extendedprice*100)) c FROM lineitem GROUP BY 1) t ON o_orderkey=l_orderkey) GROUP BY 1""",
)
def attach_child_totals(spark, sf):
    child = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), cents("l_extendedprice").alias("c"))
    joined = joins.attach_totals(table(spark, sf, "orders"), child, "o_orderkey", "c", "cost")
    return joined.groupBy("o_orderpriority").agg(
        F.sum("cost").cast("bigint").alias("cost_cents"), F.count_if(F.col("cost") == 0).alias("without")
    )


def _weights_table(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").filter(k % 10 != 3).select(
        "o_orderkey", (F.lit(1.0) + k % 7).alias("full"), *[(1 + (k * r) % 7).cast("double").alias(f"REP{r}") for r in (1, 2, 3)]
    )


@query(
    "C2",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(1+o_orderkey%7) AS BIGINT) AS full_weight, CAST(sum(1+(o_orderkey*2)%7) AS BIGINT) AS rep2 FROM orders WHERE o_orderkey%10<>3 GROUP BY 1""",
)
def attach_replicate_weights(spark, sf):
    joined = joins.attach_replicates(table(spark, sf, "orders"), _weights_table(spark, sf), "o_orderkey")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("full").cast("bigint").alias("full_weight"), F.sum("REP2").cast("bigint").alias("rep2")
    )


@query(
    "C2",
    """SELECT count(*) AS left_rows, CAST(count(CASE WHEN o_orderkey%10<>3 THEN 1 END) AS BIGINT) AS right_rows, CAST(count(CASE WHEN o_orderkey%10<>3 THEN 1 END) AS BIGINT) AS matched_keys,
    CAST(0 AS BIGINT) AS repeated_keys, CAST(count(CASE WHEN o_orderkey%10=3 THEN 1 END) AS BIGINT) AS unmatched_keys FROM orders""",
)
def one_to_one_report(spark, sf):
    return joins.one_to_one(table(spark, sf, "orders"), _weights_table(spark, sf), "o_orderkey")


@query(
    "C3",
    """WITH c AS (SELECT l_returnflag, year(l_shipdate) y, l_linestatus s, CAST(sum(round(l_extendedprice*100)) AS BIGINT) v FROM lineitem GROUP BY 1,2,3)
    SELECT a.l_returnflag, a.y AS year, a.v AS f_value, b.v AS o_value FROM c a LEFT JOIN c b ON a.l_returnflag=b.l_returnflag AND a.y=b.y AND b.s='O' WHERE a.s='F'""",
)
def measures_side_by_side(spark, sf):
    cells = table(spark, sf, "lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("year"), "l_linestatus").agg(
        F.sum(cents("l_extendedprice")).cast("bigint").alias("v")
    )
    return joins.measure_self_join(cells, "l_linestatus", "F", "O", ["l_returnflag", "year"], "v", "f_value", "o_value")


@query(
    "C4",
    """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""",
)
def orders_without_lines(spark, sf):
    orphans = joins.fk_orphans(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")
    return orphans.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "C5",
    """SELECT CAST(count(CASE WHEN b IS NULL THEN 1 END) AS BIGINT) AS only_a, CAST(count(CASE WHEN a IS NULL THEN 1 END) AS BIGINT) AS only_b, CAST(count(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 END) AS BIGINT) AS in_both
    FROM (SELECT DISTINCT doc_id a FROM documents) x FULL JOIN (SELECT DISTINCT doc_id+5 b FROM labels) y ON a=b""",
)
def key_set_comparison(spark, sf):
    shifted = table(spark, sf, "labels").select((F.col("doc_id") + 5).alias("doc_id"))
    return joins.key_set_match(table(spark, sf, "documents"), shifted, "doc_id")


@query(
    "C6",
    """SELECT count(*) AS matched, CAST(sum(CASE WHEN o_orderkey%100=0 THEN 1 ELSE 0 END) AS BIGINT) AS mismatched, max(CASE WHEN o_orderkey%100=0 THEN 3.0::DOUBLE ELSE 0 END) AS largest_gap,
    CAST(sum(1+o_orderkey%7) AS BIGINT) AS sum_x, CAST(sum(1+o_orderkey%7+CASE WHEN o_orderkey%100=0 THEN 3 ELSE 0 END) AS BIGINT) AS sum_y FROM orders WHERE o_orderkey%10<>3""",
)
def matched_value_comparison(spark, sf):
    k = F.col("o_orderkey")
    main = table(spark, sf, "orders").select("o_orderkey", (1 + k % 7).alias("x"))
    other = table(spark, sf, "orders").filter(k % 10 != 3).select(
        "o_orderkey", (1 + k % 7 + F.when(k % 100 == 0, 3).otherwise(0)).alias("y")
    )
    out = joins.value_match_join(main, other, "o_orderkey", "x", "y", 0.5)
    return out.withColumn("largest_gap", F.col("largest_gap").cast("double"))


@query(
    "C8",
    """SELECT (SELECT CAST(sum(l_quantity) AS BIGINT) FROM lineitem) AS value_a, (SELECT CAST(sum(round(o_totalprice*100)) AS BIGINT) FROM orders) AS value_b""",
)
def cross_source_totals(spark, sf):
    return joins.cross_source_pair(
        table(spark, sf, "lineitem").agg(F.sum("l_quantity").cast("bigint").alias("value_a")),
        table(spark, sf, "orders").agg(F.sum(cents("o_totalprice")).cast("bigint").alias("value_b")),
    )


@query(
    "C9",
    """SELECT DISTINCT 'ship' AS survey, year(l_shipdate) AS year FROM lineitem WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderstatus='F' AND year(o_orderdate)<1998) AND year(l_shipdate)<>2000""",
)
def releases_still_missing(spark, sf):
    survey = F.lit("ship").alias("survey")
    available = table(spark, sf, "lineitem").select(survey, F.year("l_shipdate").alias("year")).distinct()
    promoted = table(spark, sf, "orders").filter("o_orderstatus = 'F' AND year(o_orderdate) < 1998").select(
        survey, F.year("o_orderdate").alias("year")
    ).distinct()
    done = available.filter("year = 2000")
    return joins.missing_years(available, promoted, done)


@query(
    "C10",
    """SELECT doc_id, (doc_id%50<>7) AS found, CASE WHEN doc_id%50=7 THEN '' ELSE concat_ws(',', CASE WHEN doc_id%20=1 THEN 'year' END, CASE WHEN doc_id%30=2 THEN 'release_id' END) END AS mismatched_fields
    FROM documents""",
)
def pointer_checks(spark, sf):
    docs = table(spark, sf, "documents")
    k = F.col("doc_id")
    digest = F.sha2(F.concat_ws("-", k.cast("string"), "text"), 256)
    ledger = docs.select(
        F.col("source").alias("survey"), F.lit(2024).alias("year"), F.substring(digest, 1, 12).alias("release_id"), digest.alias("digest")
    )
    pointers = docs.select(
        "doc_id",
        F.col("source").alias("survey"),
        F.when(k % 20 == 1, 2023).otherwise(2024).alias("year"),
        F.when(k % 30 == 2, F.lit("stale")).otherwise(F.substring(digest, 1, 12)).alias("release_id"),
        F.when(k % 50 == 7, F.lit("gone")).otherwise(digest).alias("digest"),
    )
    return joins.pointer_mismatches(pointers, ledger).select("doc_id", "found", "mismatched_fields")


@query(
    "C11",
    """SELECT n_name, n_regionkey, n FROM nation LEFT JOIN (SELECT c_nationkey k, count(*) n FROM customer WHERE c_nationkey%6<>0 GROUP BY 1) ON n_nationkey=k WHERE n IS NOT NULL
    UNION ALL SELECT n_name, n_regionkey, -1 FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey%6<>0)""",
)
def region_attachment(spark, sf):
    counts = (
        table(spark, sf, "customer")
        .filter("c_nationkey % 6 <> 0")
        .groupBy(F.concat(F.lit("nation_"), F.col("c_nationkey")).alias("place"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    regions = table(spark, sf, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    joined = joins.attach_region(counts, regions, "place", "name")
    return joined.select(F.col("name").alias("n_name"), "n_regionkey", F.coalesce("n", F.lit(-1)).alias("n"))


@query(
    "C11",
    """SELECT lpad(CAST(n_nationkey AS VARCHAR),2,'0') AS fips, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey=n_nationkey GROUP BY 1,2""",
)
def region_attachment_by_code(spark, sf):
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    regions = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("fips"), "n_name")
    joined = joins.attach_region(counts, regions, "code", "fips")
    return joined.select("fips", "n_name", F.coalesce("n", F.lit(0)).alias("n"))


# --- order, limit, sets ------------------------------------------------------------------------------


@query(
    "G1",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15",
)
def top_orders(spark, sf):
    return series.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 15, "o_orderkey")


@query(
    "G2",
    """SELECT o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 99 END AS place, count(*) AS n FROM orders GROUP BY 1""",
)
def label_order(spark, sf):
    labels = ["5-LOW", "1-URGENT"]
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("place", label_rank("o_orderpriority", labels))
    return series.order_by_labels(ranked, "o_orderpriority", labels, "o_orderpriority")


@query(
    "G3",
    "SELECT c_mktsegment, c_nationkey, c_custkey FROM customer ORDER BY c_mktsegment, c_nationkey DESC, c_custkey",
)
def multi_key_order(spark, sf):
    return series.multi_key_sort(
        table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey"),
        "c_mktsegment",
        F.col("c_nationkey").desc(),
        "c_custkey",
    )


@query(
    "G4",
    """(SELECT 's' AS kind, s_name AS name FROM supplier WHERE s_nationkey=3 ORDER BY s_name LIMIT 12)
    UNION ALL (SELECT 'c', c_name FROM customer ORDER BY c_name LIMIT (SELECT CAST(greatest(0, 12-count(*)) AS BIGINT) FROM supplier WHERE s_nationkey=3))""",
)
def limited_union(spark, sf):
    a = table(spark, sf, "supplier").filter("s_nationkey = 3").select(F.lit("s").alias("kind"), F.col("s_name").alias("name"))
    b = table(spark, sf, "customer").select(F.lit("c").alias("kind"), F.col("c_name").alias("name"))
    return series.limited_union(a, b, 12, ["name"])


@query(
    "H1 H2",
    """SELECT l_returnflag AS series, year(l_shipdate) AS year, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY 1,2
    UNION ALL SELECT 'A adjusted', year(l_shipdate), CAST(sum(l_quantity)+1000 AS BIGINT) FROM lineitem WHERE l_returnflag='A' GROUP BY 2""",
)
def appended_series(spark, sf):
    base = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("series"), F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").cast("bigint").alias("v")
    )
    adjusted = base.filter("series = 'A'").select(F.lit("A adjusted").alias("series"), "year", (F.col("v") + 1000).alias("v"))
    return series.append_series(base, adjusted)


@query(
    "H2",
    """SELECT kind, count(*) AS n, CAST(count(extra) AS BIGINT) AS with_extra FROM (SELECT 'c' kind, c_mktsegment extra FROM customer UNION ALL SELECT 's', NULL FROM supplier) GROUP BY 1""",
)
def concatenated_members(spark, sf):
    a = table(spark, sf, "customer").select(F.lit("c").alias("kind"), F.col("c_mktsegment").alias("extra"))
    b = table(spark, sf, "supplier").select(F.lit("s").alias("kind"))
    return series.concat_members(a, b).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("with_extra"))


@query(
    "H3",
    """SELECT (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders))=0 AS contains_all,
    (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders))+(SELECT count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem))=0 AS equals_set,
    (SELECT count(*) FROM (SELECT o_orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem))=0 AS disjoint""",
)
def set_relations(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    b = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    return series.set_relation(a, b, "k")


@query(
    "H4",
    """SELECT l_returnflag, l_returnflag IN ('A','R') AS published, round(sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END)/sum(l_quantity),9) AS share FROM lineitem GROUP BY 1""",
)
def published_subset(spark, sf):
    from ..operators.estimators import estimate, weighted_share

    shares = estimate(
        table(spark, sf, "lineitem"), ["l_returnflag"], share=weighted_share(F.col("l_linestatus") == "F", "l_quantity")
    )
    return rounded(series.subset_publication(shares, "l_returnflag", ["A", "R"]), 9, "share")
