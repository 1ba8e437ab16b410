"""Recodes, predicates and the scalar function surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import frames, numeric, recode, text
from ..operators import estimators
from .registry import query, rounded, table

NAMES = ("part_code", "n", "total")


@query(
    "B1 I3",
    """SELECT CAST(count(v) AS BIGINT) AS n_number, CAST(count(*)-count(v) AS BIGINT) AS n_null,
    CAST(sum(round(v*100)) AS BIGINT) AS total_cents FROM (
      SELECT CASE WHEN o_orderkey%13 IN (0,1,2) THEN NULL ELSE o_totalprice END v FROM orders)""",
)
def coerce_numeric_text(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 13 == 0, "n/a")
        .when(F.col("o_orderkey") % 13 == 1, F.lit("1.0d"))
        .when(F.col("o_orderkey") % 13 == 2, F.lit("NaN"))
        .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .alias("v")
    )
    return numeric.coerce_numeric(raw, ["v"]).agg(
        F.count("v").alias("n_number"),
        F.count_if(F.col("v").isNull()).alias("n_null"),
        F.sum(F.round(F.col("v") * 100)).cast("bigint").alias("total_cents"),
    )


@query(
    "B2 I2",
    """SELECT strftime(o_orderdate,'%Y-%m-%d') AS day, count(*) AS n,
    CAST(sum(CASE WHEN o_orderkey%17=0 THEN 1 ELSE 0 END) AS BIGINT) AS unreadable FROM orders GROUP BY 1""",
)
def coerce_date_text(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit("31.12.")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t"),
    )
    dated = raw.select("day", text.to_date_strict("day").alias("s"), text.to_date_lenient("t").alias("d"))
    return dated.groupBy(F.date_format("s", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("d").isNull()).alias("unreadable")
    )


@query(
    "B3 I1",
    """SELECT CASE WHEN l_orderkey%19=0 THEN 'missing' ELSE l_returnflag END AS code, count(*) AS n FROM lineitem GROUP BY 1""",
)
def normalize_quoted_codes(spark, sf):
    li = table(spark, sf, "lineitem")
    quoted = F.when(F.col("l_orderkey") % 19 == 0, F.lit(" 'NaN' ")).otherwise(
        F.concat(F.lit(" '"), F.col("l_returnflag"), F.lit("' "))
    )
    code = F.coalesce(text.normalize_code(quoted), F.lit("missing"))
    return li.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "B4",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS label,
    CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE o_orderstatus END AS kept,
    coalesce(CASE o_orderstatus WHEN 'F' THEN 'finished' END,'none') AS strict, count(*) AS n
    FROM orders GROUP BY ALL""",
)
def recode_labels(spark, sf):
    c = F.col("o_orderstatus")
    return (
        table(spark, sf, "orders")
        .select(
            recode.recode(c, {"F": "finished", "O": "open"}, default="other").alias("label"),
            recode.recode(c, {"F": "finished"}, keep=True).alias("kept"),
            F.coalesce(recode.recode(c, {"F": "finished"}), F.lit("none")).alias("strict"),
        )
        .groupBy("label", "kept", "strict")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "B4",
    """SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1""",
)
def recode_by_table(spark, sf):
    joined = recode.recode_join(
        table(spark, sf, "customer"), "c_nationkey", table(spark, sf, "nation"), "n_nationkey", "n_name"
    )
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "B5",
    """SELECT CASE WHEN p_size<1 OR p_size>50 THEN 'outside' WHEN p_size<=10 THEN 'small' WHEN p_size<=25 THEN 'medium' ELSE 'large' END AS band,
    count(*) AS n, min(p_size) AS lowest, max(p_size) AS highest FROM part GROUP BY 1""",
)
def band_right_closed(spark, sf):
    label = F.coalesce(recode.band("p_size", [1, 10, 25, 50], ["small", "medium", "large"]), F.lit("outside"))
    return (
        table(spark, sf, "part")
        .groupBy(label.alias("band"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("p_size").alias("lowest"), F.max("p_size").alias("highest"))
    )


@query(
    "B6 B7 B9",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(round(o_totalprice*100)) AS BIGINT) AS total_cents FROM orders
    WHERE o_orderpriority='1-URGENT' AND o_orderstatus IN ('F','O') AND o_totalprice BETWEEN 1000 AND 250000 GROUP BY 1""",
)
def universe_and_code_filters(spark, sf):
    df = frames.filter_codes(table(spark, sf, "orders"), {"o_orderpriority": "1-URGENT"})
    df = frames.between_closed(frames.in_universe(df, "o_orderstatus", ["F", "O"]), "o_totalprice", 1000, 250000)
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100)).cast("bigint").alias("total_cents")
    )


@query(
    "B8",
    """SELECT CASE WHEN w>0 THEN true ELSE false END AS valid, CASE WHEN w>=0 THEN true ELSE false END AS valid_or_zero, count(*) AS n
    FROM (SELECT CASE o_orderkey%11 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN -1 ELSE o_totalprice END w FROM orders)
    GROUP BY 1,2""",
)
def valid_weights(spark, sf):
    k = F.col("o_orderkey") % 11
    w = (
        F.when(k == 0, F.lit(None))
        .when(k == 1, F.lit(float("nan")))
        .when(k == 2, F.lit(0.0))
        .when(k == 3, F.lit(-1.0))
        .otherwise(F.col("o_totalprice"))
    )
    df = table(spark, sf, "orders").select(w.alias("w"))
    return df.groupBy(
        numeric.valid_weight("w").alias("valid"), numeric.valid_weight("w", True).alias("valid_or_zero")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "B10",
    """SELECT CAST(substr(p_brand,7) AS INTEGER) AS level, count(*) AS n FROM part WHERE p_brand LIKE 'Brand#%' GROUP BY 1""",
)
def prefix_levels(spark, sf):
    kept = frames.filter_prefix(table(spark, sf, "part"), "p_brand", "Brand#")
    return kept.groupBy(recode.strip_prefix_int("p_brand", "Brand#").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "B11 B12",
    """SELECT c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey=n_nationkey
    WHERE regexp_full_match(n_name,'NATION_[0-9]') AND n_nationkey NOT IN (3,4)
    AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey=1) GROUP BY 1""",
)
def regex_and_exclusions(spark, sf):
    nation = table(spark, sf, "nation")
    named = frames.filter_regex(nation, "n_name", "^NATION_[0-9]$")
    named = frames.exclude_codes(named, "n_nationkey", [3, 4])
    aggregates = nation.filter("n_regionkey = 1").select("n_nationkey")
    kept = frames.exclude_codes(table(spark, sf, "customer"), "c_nationkey", aggregates)
    joined = kept.join(named, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "B13 E2",
    """SELECT coalesce(r>0.5,false) AS over_half, count(*) AS n, CAST(count(r) AS BIGINT) AS with_ratio FROM (
    SELECT 12*s_acctbal/nullif(CASE WHEN s_suppkey%7=0 THEN 0 ELSE s_acctbal*20+s_suppkey END,0) r FROM supplier) GROUP BY 1""",
)
def ratio_and_flag(spark, sf):
    base = F.when(F.col("s_suppkey") % 7 == 0, F.lit(0.0)).otherwise(F.col("s_acctbal") * 20 + F.col("s_suppkey"))
    df = table(spark, sf, "supplier").select(numeric.ratio(F.col("s_acctbal") * 12, base).alias("r"))
    return df.groupBy(F.coalesce(numeric.flag_over("r", 0.5), F.lit(False)).alias("over_half")).agg(
        F.count(F.lit(1)).alias("n"), F.count("r").alias("with_ratio")
    )


@query(
    "B14 B15",
    """SELECT CAST(o_orderkey%10 AS INTEGER) AS implicate, round(sum(CASE WHEN y=1996 AND m<=3 THEN (m-1)/3.0::DOUBLE WHEN y=1997 THEN (4-m)/3.0::DOUBLE ELSE 1.0::DOUBLE END),6) AS factor_sum,
    count(*) AS n FROM (SELECT o_orderkey, year(o_orderdate) y, month(o_orderdate) m FROM orders) GROUP BY 1""",
)
def implicates_and_calendar_factor(spark, sf):
    df = table(spark, sf, "orders").select(
        recode.implicate_of("o_orderkey").alias("implicate"),
        recode.calendar_factor(F.month("o_orderdate"), F.year("o_orderdate"), 1996).alias("f"),
    )
    out = df.groupBy("implicate").agg(F.sum("f").alias("factor_sum"), F.count(F.lit(1)).alias("n"))
    return rounded(out, 6, "factor_sum")


@query(
    "B16",
    """SELECT l_returnflag, round(avg((l_tax*100/100.0::DOUBLE*l_extendedprice+500)/(l_extendedprice+300)*100),6) AS mean_rate
    FROM lineitem GROUP BY 1""",
)
def premium_adjusted_rates(spark, sf):
    rate = recode.premium_adjusted_rate(F.col("l_tax") * 100, "l_extendedprice", 500.0, 300.0)
    out = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.avg(rate).alias("mean_rate"))
    return rounded(out, 6, "mean_rate")


@query(
    "B17 B19 U1",
    """SELECT CAST(r AS INTEGER) AS replicate, CAST(sum(w*m) AS BIGINT) AS weight FROM (
    SELECT r, 1+(o_orderkey*r)%7 w, (o_orderkey+r)%3 m FROM orders, range(1,6) t(r)) GROUP BY 1""",
)
def replicate_columns_and_products(spark, sf):
    k = F.col("o_orderkey")
    wide = table(spark, sf, "orders").select(
        *[(1 + (k * r) % 7).alias(f"W{r:02d}") for r in (3, 1, 5, 2, 4)], *[((k + r) % 3).alias(f"M{r}") for r in range(1, 6)]
    )
    from ..operators.uncertainty import to_replicates

    product = recode.product_weight(frames.weight_array(wide, "W", 5), frames.weight_array(wide, "M", 5))
    long = to_replicates(wide, product, [])
    return long.groupBy("replicate").agg(F.sum("w").cast("bigint").alias("weight"))


@query(
    "B18",
    "SELECT 'o_totalprice' AS chosen, CAST(sum(round(o_totalprice*100)) AS BIGINT) AS total_cents FROM orders",
)
def first_present_column(spark, sf):
    df = table(spark, sf, "orders")
    chosen = frames.first_present(df, ["PERWT", "O_TOTALPRICE", "o_custkey"])
    return df.agg(
        F.lit(chosen).alias("chosen"), F.sum(F.round(F.col(chosen) * 100)).cast("bigint").alias("total_cents")
    )


@query(
    "I1",
    """SELECT regexp_replace(lower(p_brand||' '||p_name),'[^a-z0-9]+','_','g') AS slug, split_part(p_name,' ',1) AS head,
    count(*) AS n FROM part GROUP BY ALL""",
)
def string_functions(spark, sf):
    df = table(spark, sf, "part").select(
        text.slug(F.concat_ws(" ", "p_brand", text.collapse_whitespace(F.concat(F.lit("  "), "p_name")))).alias("slug"),
        F.element_at(F.split("p_name", " "), 1).alias("head"),
    )
    return df.groupBy("slug", "head").agg(F.count(F.lit(1)).alias("n"))


@query(
    "I2",
    """SELECT year(o_orderdate)||'-Q'||quarter(o_orderdate) AS quarter, 'M'||strftime(o_orderdate,'%m') AS month, count(*) AS n,
    CAST(max(date_diff('day', DATE '1996-07-01', CAST(o_orderdate AS DATE))) AS BIGINT) AS last_offset FROM orders GROUP BY 1,2""",
)
def date_functions(spark, sf):
    df = table(spark, sf, "orders").select(
        text.quarter_label("o_orderdate").alias("quarter"),
        text.month_code(F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
        F.datediff("o_orderdate", F.lit("1996-07-01").cast("date")).alias("d"),
    )
    return df.groupBy("quarter", "month").agg(
        F.count(F.lit(1)).alias("n"), F.max("d").cast("bigint").alias("last_offset")
    )


@query(
    "I3 I4",
    """SELECT CAST(sum(CASE WHEN p_size%2=0 THEN p_size//2 WHEN ((p_size-1)//2)%2=0 THEN (p_size-1)//2 ELSE (p_size+1)//2 END) AS BIGINT) AS half_even,
    CAST(sum(least(greatest(p_size-10,0),20)) AS BIGINT) AS clamped, round(max(abs(p_retailprice-1000)/greatest(1000,1e-9)),6) AS largest_gap FROM part""",
)
def math_and_conditionals(spark, sf):
    df = table(spark, sf, "part").select(
        numeric.half_even(F.col("p_size") / 2).alias("h"),
        numeric.clamp(F.col("p_size") - 10, 0, 20).alias("c"),
        numeric.relative_difference("p_retailprice", F.lit(1000.0)).alias("g"),
    )
    out = df.agg(
        F.sum("h").cast("bigint").alias("half_even"),
        F.sum("c").cast("bigint").alias("clamped"),
        F.max("g").alias("largest_gap"),
    )
    return rounded(out, 6, "largest_gap")


@query(
    "I5",
    """SELECT CASE WHEN p_size%6<5 THEN ['A','B','C','D','E'][p_size%6+1] ELSE 'idx_'||(p_size%6) END AS code,
    CASE WHEN p_size%6=0 THEN 'first' ELSE 'later' END || '|' || CAST(p_size%6 AS VARCHAR) AS joined, count(*) AS n FROM part GROUP BY 1,2""",
)
def array_and_map_functions(spark, sf):
    i = F.col("p_size") % 6
    codes = F.array(*[F.lit(c) for c in "ABCDE"])
    reverse = F.map_from_entries(F.transform(F.map_entries(F.create_map(F.lit("first"), F.lit(0))), lambda e: F.struct(e["value"], e["key"])))
    df = table(spark, sf, "part").select(
        F.coalesce(F.try_element_at(codes, i + 1), F.concat(F.lit("idx_"), i)).alias("code"),
        F.array_join(F.array(F.coalesce(F.try_element_at(reverse, i), F.lit("later")), i.cast("string")), "|").alias("joined"),
    )
    return df.groupBy("code", "joined").agg(F.count(F.lit(1)).alias("n"))


@query(
    "I6",
    """SELECT event_type, CAST(sum(CAST(json_extract(props,'$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(*) AS n FROM events GROUP BY 1""",
)
def json_functions(spark, sf):
    df = table(spark, sf, "events").select(
        "event_type",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k2"),
    )
    return df.groupBy("event_type").agg(
        F.sum(F.when(F.col("k") == F.col("k2"), F.col("k"))).alias("k_sum"), F.count(F.lit(1)).alias("n")
    )


@query(
    "I7",
    """SELECT lang, min(sha256(text)) AS first_digest, CAST(count(DISTINCT sha256(text)) AS BIGINT) AS n_contents FROM documents GROUP BY 1""",
)
def content_hashes(spark, sf):
    df = table(spark, sf, "documents").select("lang", text.content_sha256("text").alias("sha"))
    return df.groupBy("lang").agg(F.min("sha").alias("first_digest"), F.countDistinct("sha").alias("n_contents"))


@query(
    "D11 D12 D14",
    """SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1""",
)
def category_value_counts(spark, sf):
    orders = table(spark, sf, "orders")
    counts = estimators.category_counts(orders, "o_orderpriority")
    domain = estimators.distinct_domain(orders, "o_orderpriority").withColumnRenamed("o_orderpriority", "value")
    return domain.join(counts, F.col("value") == F.col("o_orderpriority")).select("value", "n")


@query(
    "D14",
    """SELECT 'o_totalprice' AS "column", CAST(count(*)-count(CASE WHEN o_orderkey%11<>0 THEN 1 END) AS BIGINT) AS n_missing, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'o_orderdate', CAST(count(*)-count(CASE WHEN o_custkey%5<>0 THEN 1 END) AS BIGINT), count(*) FROM orders""",
)
def missing_values(spark, sf):
    df = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderdate")).alias("o_orderdate"),
    )
    return estimators.missingness(df, ["o_totalprice", "o_orderdate"])
