"""Contract gates: one row per gate and the SQL that counts what the gate should have seen."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import implicate_of
from ..operators import estimators as E
from ..operators import gates as G
from ..operators.joins import with_one_row
from .registry import cents, query, table


def shown(df):
    """The columns that SQL states; notes are free text."""
    return df.select(
        *[c for c in df.columns if c not in G.GATE_COLUMNS], "gate", "status", F.round("observed", 6).alias("observed")
    )


def scalar_sql(rows: list[tuple[str, str, str]]) -> str:
    """``(gate, observed SQL, pass SQL over o)`` to gate rows."""
    parts = [
        f"SELECT '{gate}' AS gate, CASE WHEN {test} THEN 'pass' ELSE 'fail' END AS status, round(CAST(o AS DOUBLE),6) AS observed FROM (SELECT ({observed}) AS o)"
        for gate, observed, test in rows
    ]
    return " UNION ALL ".join(parts)


@query(
    "J1 J2 J3 J4 J5 J6 J7",
    scalar_sql(
        [
            ("required_columns", "SELECT 0", "o=0"),
            ("forbidden_columns", "SELECT 1", "o=0"),
            ("column_count", "SELECT 6", "o=6"),
            ("ordered_header", "SELECT 6", "o=6"),
            ("row_minimum", "SELECT count(*) FROM orders", "o>=100"),
            ("row_count", "SELECT count(*) FROM orders", "o=15000"),
            ("non_empty", "SELECT count(*) FROM orders", "o>0"),
            ("key_non_null", "SELECT count(*)-count(o_orderkey) FROM orders", "o=0"),
            ("key_unique", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*)>1)", "o=0"),
            ("line_key_unique", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)>1)", "o=0"),
        ]
    ),
)
def table_contract(spark, sf):
    orders = table(spark, sf, "orders")
    known = G.plan_gates(
        spark,
        [
            G.required_columns(orders, ["o_orderkey", "o_custkey"]),
            G.forbidden_columns(orders, ["o_orderdate", "name", "address"]),
            G.column_count(orders, 6),
            G.ordered_header(orders, [c.upper() for c in orders.columns], fold_case=True),
        ],
    )
    fused = G.run_gates(orders, [G.row_minimum(100), G.row_count(15000), G.non_empty(), G.key_non_null(["o_orderkey"])])
    keys = G.key_unique_gate(orders, ["o_orderkey"])
    lines = G.key_unique_gate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "line_key_unique")
    return shown(G.merge_gates(known, fused, keys, lines))


@query(
    "J8 J26",
    scalar_sql(
        [
            ("line_has_order", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)", "o=0"),
            ("order_has_line", "SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", "o=0"),
        ]
    ),
)
def foreign_keys(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return shown(
        G.merge_gates(
            G.foreign_key_gate(lines, orders, "l_orderkey", "o_orderkey", "line_has_order"),
            G.foreign_key_gate(orders, lines, "o_orderkey", "l_orderkey", "order_has_line"),
        )
    )


@query(
    "J9",
    scalar_sql(
        [
            ("w_finite", "SELECT count(*) FROM orders WHERE o_orderkey%11=0", "o=0"),
            ("w_sign", "SELECT count(*) FROM orders WHERE o_orderkey%11=1", "o=0"),
            ("w_total", "SELECT sum(CASE o_orderkey%11 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END) FROM orders", "o>0"),
            ("s_finite", "SELECT 0", "o=0"),
            ("s_sign", "SELECT 0", "o=0"),
            ("s_total", "SELECT sum(o_orderkey%2) FROM orders", "o>0"),
        ]
    ),
)
def weight_gates(spark, sf):
    k = F.col("o_orderkey") % 11
    df = table(spark, sf, "orders").select(
        F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(0.0)).otherwise(F.lit(2.0)).alias("w"),
        (F.col("o_orderkey") % 2).cast("double").alias("s"),
    )
    return shown(G.run_gates(df, [*G.weights_valid("w"), *G.weights_valid("s", allow_zero=True)]))


@query(
    "J10 J11",
    scalar_sql(
        [
            ("replicate_columns", "SELECT 4", "o=4"),
            ("replicate_columns_5", "SELECT 4", "o=5"),
            ("replicates_positive_or_missing", "SELECT count(*) FROM orders WHERE o_orderkey%101=3", "o=0"),
            ("replicates_balanced", "SELECT 1", "o=0"),
        ]
    ),
)
def replicate_gates(spark, sf):
    """Replicate 4 is never missing, so the set is not balanced."""
    k = F.col("o_orderkey")
    half = [F.when((k * (2 * r + 1)) % 97 < 48, F.lit(2.0)).alias(f"WT{r:02d}") for r in (1, 2, 3)]
    df = table(spark, sf, "orders").select(*half, F.when(k % 101 == 3, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("WT04"))
    five = G.replicate_columns(df, "WT", 5)
    known = G.plan_gates(spark, [G.replicate_columns(df, "WT", 4), ("replicate_columns_5", *five[1:])])
    return shown(G.merge_gates(known, G.replicate_balance_gate(df, [f"WT{r:02d}" for r in (1, 2, 3, 4)])))


@query(
    "J12 C5",
    scalar_sql(
        [
            ("replicate_matched", "SELECT count(*) FROM orders WHERE o_orderkey%10<>3", "o>0"),
            ("replicate_alignment", "SELECT count(*) FROM orders WHERE o_orderkey%10<>3 AND o_orderkey%100=0", "o=0"),
            ("replicate_sum", "SELECT 3*count(*) FROM orders WHERE o_orderkey%10<>3 AND o_orderkey%100=0", "o<=0.5"),
            ("keys_only_left", "SELECT count(*) FROM orders WHERE o_orderkey%10=3", "o=0"),
            ("keys_only_right", "SELECT 0", "o=0"),
            ("join_keys_repeated", "SELECT 0", "o=0"),
            ("join_keys_unmatched", "SELECT count(*) FROM orders WHERE o_orderkey%10=3", "o=0"),
        ]
    ),
)
def alignment_gates(spark, sf):
    k = F.col("o_orderkey")
    main = table(spark, sf, "orders").select("o_orderkey", (1 + k % 7).cast("double").alias("w"))
    reps = main.filter(k % 10 != 3).select("o_orderkey", (F.col("w") + F.when(k % 100 == 0, 3).otherwise(0)).alias("REP0"))
    return shown(
        G.merge_gates(
            G.replicate_alignment_gate(main, reps, ["o_orderkey"], "w", "REP0", 0.5),
            G.key_sets_gate(main, reps, ["o_orderkey"]),
            G.one_to_one_gate(main, reps, "o_orderkey"),
        )
    )


@query(
    "J13 J21",
    scalar_sql(
        [
            ("o_orderstatus_domain", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F','O')", "o=0"),
            ("o_orderstatus_complete", "SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus IN ('F','O','P','X')", "o=4"),
            ("period_in_range", "SELECT count(*) FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997", "o>0"),
            ("period_outside", "SELECT count(*) FROM orders WHERE year(o_orderdate) NOT BETWEEN 1996 AND 1997", "o>=0"),
            ("period_equals", "SELECT count(*) FROM orders WHERE year(o_orderdate)<>1996", "o=0"),
        ]
    ),
)
def domain_and_period_gates(spark, sf):
    df = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return shown(
        G.run_gates(
            df,
            [
                G.domain("o_orderstatus", ["F", "O"]),
                G.domain_complete("o_orderstatus", ["F", "O", "P", "X"]),
                *G.period_in_range("year", 1996, 1997),
                G.period_equals("year", 1996),
            ],
        )
    )


@query(
    "J14",
    scalar_sql(
        [
            ("implicate_rows_per_family", "SELECT count(*) FROM (SELECT o_orderkey//5 f FROM orders WHERE o_orderkey<>7 GROUP BY 1 HAVING count(*)<>5)", "o=0"),
            ("implicate_sets", "SELECT count(*) FROM (SELECT o_orderkey//5 f FROM orders WHERE o_orderkey<>7 GROUP BY 1 HAVING count(DISTINCT o_orderkey%5)<>5)", "o=0"),
            ("implicate_lowest", "SELECT 1", "o=1"),
            ("implicate_highest", "SELECT 5", "o=5"),
        ]
    ),
)
def implicate_gates(spark, sf):
    """One record of one family is left out on purpose."""
    df = table(spark, sf, "orders").filter("o_orderkey <> 7").select(
        F.floor(F.col("o_orderkey") / 5).alias("family"), (implicate_of("o_orderkey", 5) + 1).alias("imp")
    )
    return shown(G.implicates_gate(df, "family", "imp", 5))


@query(
    "J15 J16 J17 J18 J32",
    scalar_sql(
        [
            ("share_absolute", "SELECT sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END)/sum(l_quantity) FROM lineitem", "abs(o-0.5)<=0.01"),
            ("share_relative", "SELECT sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END)/sum(l_quantity) FROM lineitem", "abs(o-0.6)/0.6<=0.01"),
            ("share_band", "SELECT sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END)/sum(l_quantity) FROM lineitem", "o BETWEEN 0.4 AND 0.6"),
            ("quantity_order", "SELECT sum(l_quantity)-sum(l_linenumber) FROM lineitem", "o>0"),
            ("flag_present", "SELECT count(*) FROM lineitem WHERE l_returnflag='R'", "o>0"),
            ("flag_absent", "SELECT count(*) FROM lineitem WHERE l_returnflag='Z'", "o>0"),
        ]
    )
    + " UNION ALL SELECT 'pinned_year', CASE WHEN max(year(l_shipdate))<>1990 THEN 'skip' ELSE 'fail' END, CAST(sum(l_quantity) AS DOUBLE) FROM lineitem",
)
def benchmark_gates(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    share = E.weighted_share(F.col("l_linestatus") == "F", "l_quantity")
    return shown(
        G.run_gates(
            df,
            [
                G.benchmark("share_absolute", share, 0.5, 0.01),
                G.benchmark("share_relative", share, 0.6, 0.01, relative=True),
                G.benchmark_band("share_band", share, 0.4, 0.6),
                G.benchmark_order("quantity_order", F.sum("l_quantity"), F.sum("l_linenumber"), strict=True),
                G.benchmark_presence("flag_present", F.col("l_returnflag") == "R"),
                G.benchmark_presence("flag_absent", F.col("l_returnflag") == "Z"),
                G.year_benchmark("pinned_year", F.sum("l_quantity"), 1.0, 0.01, "year", 1990),
            ],
        )
    )


@query(
    "J19",
    scalar_sql([("statistics_n", "SELECT 1", "o=0"), ("statistics_mean", "SELECT 1", "o=0")]),
)
def published_statistics(spark, sf):
    """The published table has one wrong count and one wrong mean."""
    orders = table(spark, sf, "orders")
    stats = orders.groupBy(F.col("o_orderstatus").alias("variable")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(cents("o_totalprice")) / F.count(F.lit(1))).alias("mean")
    )
    published = stats.select(
        "variable",
        (F.col("n") + F.when(F.col("variable") == "F", 1).otherwise(0)).alias("n"),
        (F.col("mean") + F.when(F.col("variable") == "O", 0.01).otherwise(0.0)).alias("mean"),
    )
    return shown(G.statistics_gate(stats, published))


@query(
    "J20 J28",
    scalar_sql(
        [
            ("source_code", "SELECT count(*) FROM part WHERE p_brand='Brand#7' AND p_type='PROMO' AND lower(p_name) LIKE '%red%'", "o>0"),
            ("source_code_absent", "SELECT count(*) FROM part WHERE p_brand='Brand#99'", "o>0"),
            ("codebook_size", "SELECT count(DISTINCT p_name) FROM part", "o>=10"),
            ("codebook_required", "SELECT count(DISTINCT p_brand) FROM part WHERE p_brand IN ('Brand#1','Brand#2','Brand#77')", "o=3"),
            ("codebook_option", "SELECT count(*) FROM part WHERE p_size=7", "o>0"),
        ]
    ),
)
def codebook_gates(spark, sf):
    part = table(spark, sf, "part")
    triples = G.run_gates(
        part,
        [
            G.triple_exists("source_code", ("p_brand", "Brand#7"), ("p_type", "PROMO"), ("p_name", "Red")),
            G.triple_exists("source_code_absent", ("p_brand", "Brand#99"), ("p_type", "PROMO"), ("p_name", "Red")),
        ],
    )
    size = G.codebook_gate(part, "p_name", [], 10).filter("gate = 'codebook_size'")
    brands = G.codebook_gate(part, "p_brand", ["Brand#1", "Brand#2", "Brand#77"], 10, ("p_size", "7")).filter(
        "gate <> 'codebook_size'"
    )
    return shown(G.merge_gates(triples, size, brands))


@query(
    "J22 J24",
    scalar_sql(
        [
            ("observations", "SELECT count(*) FROM events WHERE event_id%10<>0", "o>=10"),
            ("dates", "SELECT count(*) FROM events WHERE event_id%1000=1", "o=0"),
            ("v_numeric", "SELECT count(*) FROM events WHERE event_id%10=0", "o=0"),
            ("hi_numeric", "SELECT count(*) FROM events WHERE event_id%9=0", "o=0"),
            ("v_hi_pair", "SELECT count(*) FROM events WHERE (event_id%10=0)<>(event_id%9=0)", "o=0"),
        ]
    ),
)
def series_and_column_gates(spark, sf):
    k = F.col("event_id")
    df = table(spark, sf, "events").select(
        F.when(k % 10 == 0, F.lit(".")).otherwise(F.col("value").cast("string")).alias("v"),
        F.when(k % 9 == 0, F.lit("")).otherwise((F.col("value") + 1).cast("string")).alias("hi"),
        F.when(k % 1000 == 1, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("d"),
    )
    return shown(G.run_gates(df, [*G.series_quality("v", "d", 10), *G.numeric_columns(["v", "hi"], [("v", "hi")])]))


@query(
    "J23",
    scalar_sql(
        [
            ("sum_of_parts", "SELECT 0", "o=0"),
            ("share_of_total", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderpriority)", "o=0"),
        ]
    ),
)
def published_arithmetic(spark, sf):
    """Parts add up to the total; the second relation is wrong everywhere on purpose."""
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    published = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("total"), n("F").alias("f"), n("O").alias("o"), n("P").alias("p")
    )
    return shown(
        G.run_gates(
            published,
            [
                G.arithmetic("sum_of_parts", F.col("total"), F.col("f") + F.col("o") + F.col("p")),
                G.arithmetic("share_of_total", F.col("total"), F.col("f") + F.col("o")),
            ],
        )
    )


@query(
    "J25 J30",
    scalar_sql(
        [
            ("record_parses", "SELECT count(*) FROM events WHERE event_id%50=9", "o=0"),
            ("record_k_number", "SELECT count(*) FROM events WHERE event_id%50=9 OR event_id%40=1", "o=0"),
            ("record_id_string", "SELECT count(*) FROM events WHERE event_id%50=9", "o=0"),
            ("record_tags_array", "SELECT count(*) FROM events WHERE event_id%50=9", "o=0"),
            ("record_id_pattern", "SELECT count(*) FROM events WHERE event_id%50=9 OR length(CAST(event_id AS VARCHAR))>3", "o=0"),
            ("payload_status", "SELECT count(*) FROM events WHERE event_id%50<>9 AND event_id%30=2", "o=0"),
            ("payload_error", "SELECT count(*) FROM events WHERE event_id%50<>9 AND event_id%60=5", "o=0"),
        ]
    ),
)
def record_and_payload_gates(spark, sf):
    i = F.col("event_id")
    k = F.when(i % 40 == 1, F.lit('"x"')).otherwise(F.get_json_object("props", "$.k"))
    status = F.when(i % 30 == 2, F.lit("REQUEST_FAILED")).otherwise(F.lit("REQUEST_SUCCEEDED"))
    error = F.when(i % 60 == 5, F.lit(',"error_code":400')).otherwise(F.lit(""))
    record = F.concat(
        F.lit('{"id":"e-'), i.cast("string"), F.lit('","k":'), k, F.lit(',"tags":[1],"status":"'), status, F.lit('"'), error, F.lit("}")
    )
    df = table(spark, sf, "events").select(F.when(i % 50 == 9, F.lit("{broken")).otherwise(record).alias("t"))
    gates = [*G.record_contract("t", {"k": "number", "id": "string", "tags": "array"}, "id", "^e-[0-9]{1,3}$"), *G.payload_status("t")]
    return shown(G.run_gates(df, gates))


@query("J30", scalar_sql([("payloads_parse", "SELECT count(*) FROM events WHERE event_id%50=9 OR event_id%70=3", "o=0")]))
def unparsed_payloads(spark, sf):
    """Payloads of which some were cut off and some are absent."""
    i = F.col("event_id")
    record = F.concat(F.lit('{"values":['), i.cast("string"), F.when(i % 50 == 9, F.lit("")).otherwise(F.lit("]}")))
    return shown(G.run_gates(table(spark, sf, "events").select(F.when(i % 70 != 3, record).alias("t")), G.payloads_parse("t")))


@query(
    "J27",
    """SELECT o_orderpriority AS survey, CAST(3 AS BIGINT) AS checks, CAST(1+(CASE WHEN n>=3000 THEN 1 ELSE 0 END)+(CASE WHEN abs(s-0.33)<=0.005 THEN 1 ELSE 0 END) AS BIGINT) AS passed,
    CAST((CASE WHEN n>=3000 THEN 0 ELSE 1 END)+(CASE WHEN abs(s-0.33)<=0.005 THEN 0 ELSE 1 END) AS BIGINT) AS failed, CASE WHEN abs(s-0.33)<=0.005 THEN 'pass' ELSE 'fail' END AS benchmark_status
    FROM (SELECT o_orderpriority, count(*) n, sum(CASE WHEN o_orderstatus='F' THEN 1.0::DOUBLE ELSE 0 END)/count(*) s FROM orders GROUP BY 1)""",
)
def gate_summary(spark, sf):
    gates = G.run_gates(
        table(spark, sf, "orders"),
        [
            G.non_empty(),
            G.row_minimum(3000),
            G.benchmark("benchmark_share", E.weighted_share(F.col("o_orderstatus") == "F", F.lit(1.0)), 0.33, 0.005),
        ],
        ["o_orderpriority"],
    )
    return G.gate_summary(gates.withColumnRenamed("o_orderpriority", "survey"), "survey")


@query(
    "J26",
    """SELECT o_orderpriority, count(*)>=3000 AS passed, CAST(2 AS BIGINT) AS n_gates, CAST(CASE WHEN count(*)>=3000 THEN 0 ELSE 1 END AS BIGINT) AS n_failed FROM orders GROUP BY 1""",
)
def releases_passed(spark, sf):
    gates = G.run_gates(table(spark, sf, "orders"), [G.non_empty(), G.row_minimum(3000)], ["o_orderpriority"])
    return G.gates_passed(gates, ["o_orderpriority"])


@query(
    "J29",
    scalar_sql(
        [
            ("members_absent", "SELECT 1+count(*) FROM (SELECT DISTINCT source FROM documents) WHERE source='src3'", "o=0"),
            ("members_repeated", "SELECT count(*) FROM (SELECT source FROM documents WHERE source NOT IN ('src3','src4x') GROUP BY 1 HAVING count(*)>1)", "o=0"),
            ("members_overlap", "SELECT 1", "o=0"),
        ]
    ),
)
def member_sets(spark, sf):
    """One contracted member has no file, the others have many, and the contract wrongly lists
    the overlapping copy."""
    docs = table(spark, sf, "documents").select(F.col("source").alias("m"))
    copy = docs.filter("m = 'src4'").select(F.lit("src4x").alias("m"))
    files = docs.filter("m <> 'src3'").unionByName(copy)
    contract = docs.distinct().unionByName(copy.distinct())
    return shown(G.member_set_gate(files, contract, "m", "4x"))


@query(
    "J31 J33",
    """SELECT lang, count(*) AS n, (SELECT CAST(count(CASE WHEN doc_id%13=0 THEN 1 END) AS BIGINT) FROM documents) AS without_source FROM documents WHERE source IN (SELECT source FROM documents WHERE source<>'src4') GROUP BY 1""",
)
def provenance_and_redistribution(spark, sf):
    docs = table(spark, sf, "documents")
    ledger = docs.select("source", (F.col("source") != "src4").alias("redistributable")).distinct()
    recorded = docs.select(F.when(F.col("doc_id") % 13 != 0, F.col("source")).alias("source"))
    missing = G.run_gates(recorded, G.provenance_recorded(["source"])).select(F.col("observed").cast("bigint").alias("without_source"))
    open_docs = G.redistributable(docs, ledger, ["source"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return with_one_row(open_docs, missing)
