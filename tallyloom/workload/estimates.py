"""Point estimators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import calendar_factor, implicate_of
from ..operators import estimators as E
from ..operators.ordering import median_unweighted
from .registry import cents, query, rounded, table


@query(
    "D1 D2 D15",
    """SELECT l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS weight, CAST(sum(CASE WHEN l_discount>=0.05 THEN l_quantity ELSE 0 END) AS BIGINT) AS weight_high,
    count(*) AS n FROM lineitem GROUP BY 1""",
)
def weighted_totals(spark, sf):
    profile = E.group_profile("l_quantity")
    return E.estimate(
        table(spark, sf, "lineitem"),
        ["l_returnflag"],
        weight=E.weighted_total("l_quantity").cast("bigint"),
        weight_high=E.weighted_count_where("l_quantity", F.col("l_discount") >= 0.05).cast("bigint"),
        n=profile["n"],
    )


@query(
    "D3 D4 E3",
    """SELECT l_linestatus, round(sum(v*w)/sum(w),6) AS mean_keep, round(sum(v*w)/sum(CASE WHEN v IS NOT NULL THEN w END),6) AS mean_drop,
    round(sum(v*w)/sum(w)/60,6) AS mean_hours FROM (SELECT l_linestatus, l_quantity w, CASE WHEN l_partkey%11<>0 THEN round(l_extendedprice*100) END v FROM lineitem) GROUP BY 1""",
)
def weighted_means(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_linestatus", F.col("l_quantity").alias("w"), F.when(F.col("l_partkey") % 11 != 0, cents("l_extendedprice")).alias("v")
    )
    out = E.estimate(
        df,
        ["l_linestatus"],
        mean_keep=E.weighted_mean("v", "w"),
        mean_drop=E.weighted_mean("v", "w", missing=E.DROP),
        mean_hours=E.weighted_mean_scaled("v", "w", 60),
    )
    return rounded(out, 6, "mean_keep", "mean_drop", "mean_hours")


@query(
    "D5 E4",
    """SELECT o_orderpriority, round(sum(CASE WHEN a='F' THEN w ELSE 0 END)/sum(w),9) AS share_all, round(sum(CASE WHEN a='F' THEN w ELSE 0 END)/sum(CASE WHEN a IS NOT NULL THEN w END),9) AS share_valid
    FROM (SELECT o_orderpriority, 1.0::DOUBLE+o_orderkey%7 w, CASE WHEN o_orderkey%9<>0 THEN o_orderstatus END a FROM orders) GROUP BY 1""",
)
def weighted_shares(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderpriority",
        (F.lit(1.0) + F.col("o_orderkey") % 7).alias("w"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")).alias("a"),
    )
    out = E.estimate(
        df,
        ["o_orderpriority"],
        share_all=E.weighted_share(F.col("a") == "F", "w"),
        share_valid=E.weighted_share(F.col("a") == "F", "w", missing=E.DROP),
    )
    return rounded(out, 9, "share_all", "share_valid")


@query(
    "D6 E10",
    """SELECT l_returnflag, round(100*sum(CASE WHEN ok THEN num END)/sum(CASE WHEN ok THEN den END),6) AS masked, round(100*sum(num)/sum(den),6) AS unmasked FROM (
    SELECT *, num IS NOT NULL AND den IS NOT NULL AND den>0 ok FROM (SELECT l_returnflag, CASE WHEN l_suppkey%13<>0 THEN round(l_extendedprice*100) END num, CASE WHEN l_partkey%17=0 THEN NULL ELSE l_quantity END den FROM lineitem)) GROUP BY 1""",
)
def ratio_of_totals(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_suppkey") % 13 != 0, cents("l_extendedprice")).alias("num"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_quantity")).alias("den"),
    )
    out = E.estimate(
        df,
        ["l_returnflag"],
        masked=E.ratio_of_totals("num", "den", 100.0),
        unmasked=E.ratio_of_totals("num", "den", 100.0, mask=False),
    )
    return rounded(out, 6, "masked", "unmasked")


@query(
    "D7 D13",
    """SELECT o_orderpriority, round(sum(v*w)/sum(f*w/4),4) AS mean, CAST(sum(CASE WHEN v>0 THEN 1 ELSE 0 END) AS BIGINT) AS reporters FROM (
    SELECT o_orderpriority, w, v, CASE WHEN y=1997 AND m<=3 THEN (m-1)/3.0::DOUBLE WHEN y=1998 THEN (4-m)/3.0::DOUBLE ELSE 1.0::DOUBLE END f FROM (
      SELECT o_orderpriority, 1.0::DOUBLE+o_orderkey%7 w, CASE WHEN o_orderkey%3=0 THEN 0 ELSE round(o_totalprice*100) END v, year(o_orderdate) y, month(o_orderdate) m FROM orders)) GROUP BY 1""",
)
def calendar_ratio_mean(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderpriority",
        (F.lit(1.0) + F.col("o_orderkey") % 7).alias("w"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0.0)).otherwise(cents("o_totalprice")).alias("v"),
        calendar_factor(F.month("o_orderdate"), F.year("o_orderdate"), 1997).alias("f"),
    )
    out = E.estimate(
        df, ["o_orderpriority"], mean=E.ratio_mean_with_denominator("v", "w", "f"), reporters=E.reporters("v")
    )
    return rounded(out, 4, "mean")


@query(
    "D8",
    """SELECT c_mktsegment, round(sum(round(v*100))/count(v)/100,6) AS mean, CAST(sum(round(v*100)) AS BIGINT) AS total_cents, count(v) AS n_present, count(*) AS n
    FROM (SELECT c_mktsegment, CASE WHEN c_custkey%8<>0 THEN c_acctbal END v FROM customer) GROUP BY 1""",
)
def unweighted_summary(spark, sf):
    df = table(spark, sf, "customer").select("c_mktsegment", F.when(F.col("c_custkey") % 8 != 0, cents("c_acctbal")).alias("v"))
    u = E.unweighted("v")
    out = E.estimate(
        df,
        ["c_mktsegment"],
        mean=u["mean"] / 100,
        total_cents=u["total"].cast("bigint"),
        n_present=u["n_present"],
        n=u["n"],
    )
    return rounded(out, 6, "mean")


@query(
    "D9",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice),6) AS median FROM lineitem GROUP BY 1,2""",
)
def median_by_group(spark, sf):
    out = median_unweighted(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linestatus"])
    return rounded(out, 6, "median")


@query(
    "D9",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice),6) AS median FROM lineitem GROUP BY 1,2""",
)
def median_by_group_ranged(spark, sf):
    """The range form that large groups take."""
    out = median_unweighted(
        table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linestatus"]
    )
    return rounded(out, 6, "median")


@query(
    "D10",
    """SELECT CASE WHEN l_linenumber<=2 THEN 'front' ELSE 'rest' END AS band, year(l_shipdate) AS year, CAST(sum(round(l_extendedprice*100)) AS BIGINT) AS total_cents FROM lineitem GROUP BY 1,2""",
)
def band_sums(spark, sf):
    coded = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") <= 2, "front").otherwise("rest").alias("band"),
        F.year("l_shipdate").alias("year"),
        cents("l_extendedprice").alias("v"),
    )
    return E.group_sum(coded, ["band", "year"], "v", "total_cents").withColumn("total_cents", F.col("total_cents").cast("bigint"))


_MEANS = """WITH m AS (SELECT n_name AS area, sum(round(c_acctbal*100))/count(*) AS v FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) """


def _nation_means(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("n_name").alias("area")).agg((F.sum(cents("c_acctbal")) / F.count(F.lit(1))).alias("v"))


@query(
    "D16",
    _MEANS
    + """SELECT round(avg(v),4) AS peer_mean, round(min(v),4) AS peer_min, round(max(v),4) AS peer_max FROM m WHERE area IN ('NATION_1','NATION_2','NATION_3','NATION_4')""",
)
def peer_group_summary(spark, sf):
    out = E.reference_group(_nation_means(spark, sf), "area", [f"NATION_{i}" for i in (1, 2, 3, 4)], "v")
    return rounded(out, 4, "peer_mean", "peer_min", "peer_max")


@query(
    "D17",
    """WITH p AS (SELECT l_linestatus, l_returnflag, sum(round(l_extendedprice*100))/sum(l_quantity) v FROM lineitem GROUP BY 1,2)
    SELECT l_linestatus, round(a.v,4) AS a_value, round(b.v,4) AS b_value, round(a.v/b.v,9) AS ratio, round((a.v/b.v-1)*100,7) AS percent_difference
    FROM p a JOIN p b USING (l_linestatus) WHERE a.l_returnflag='A' AND b.l_returnflag='R'""",
)
def group_price_ratio(spark, sf):
    prices = E.estimate(
        table(spark, sf, "lineitem").withColumn("c", cents("l_extendedprice")),
        ["l_linestatus", "l_returnflag"],
        v=E.ratio_of_totals("c", "l_quantity"),
    )
    out = E.group_ratio(prices, "l_returnflag", "A", "R", "v", ["l_linestatus"])
    return rounded(rounded(rounded(out, 4, "a_value", "b_value"), 9, "ratio"), 7, "percent_difference")


@query(
    "D18",
    """SELECT o_orderstatus, round(sum((1.0::DOUBLE+o_orderkey%7)/4),6) AS weighted_n, CAST(round_even(count(*)/5.0::DOUBLE,0) AS BIGINT) AS unweighted_n FROM orders GROUP BY 1""",
)
def population_rescaled(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderstatus", implicate_of("o_orderkey", 5).alias("imp"), ((F.lit(1.0) + F.col("o_orderkey") % 7) / 4).alias("w")
    )
    return rounded(E.population_rescale(df, "w", "imp", 5, ["o_orderstatus"]), 6, "weighted_n")


@query(
    "D19",
    """SELECT round(sum(round(o_totalprice*100)*(1+o_orderkey%7))/sum(1+o_orderkey%7)*4/100000000,9) AS coverage FROM orders""",
)
def coverage_of_published(spark, sf):
    w = F.lit(1.0) + F.col("o_orderkey") % 7
    one = table(spark, sf, "orders").agg(E.weighted_mean(cents("o_totalprice"), w).alias("mean"))
    return rounded(one.select(E.coverage_ratio("mean", 4, 1e8).alias("coverage")), 9, "coverage")


@query(
    "D20",
    """WITH c AS (SELECT l_returnflag AS cat, sum(CASE WHEN l_linestatus='F' THEN round(l_extendedprice*100) END)/100000 a, sum(CASE WHEN l_linestatus='O' THEN round(l_extendedprice*100) END)/100000 b FROM lineitem GROUP BY 1)
    SELECT cat, round(a,3) AS a_value, round(b,3) AS b_value, round(abs(a-b),3) AS gap, abs(a-b)=(SELECT max(abs(a-b)) FROM c) AS widest FROM c""",
)
def two_series_gap(spark, sf):
    cells = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("cat"), "l_linestatus").agg(
        (F.sum(cents("l_extendedprice")) / 100000).alias("v")
    )
    return rounded(E.two_series_gap(cells, "cat", "l_linestatus", "F", "O", "v"), 3, "a_value", "b_value", "gap")


@query(
    "D21",
    """WITH s AS (SELECT l_returnflag, sum(CASE WHEN l_linestatus='F' THEN l_quantity ELSE 0 END)/sum(l_quantity) v FROM lineitem GROUP BY 1)
    SELECT l_returnflag, 'share' AS part, round(v,9) AS value FROM s UNION ALL SELECT l_returnflag, 'complement', round(1-v,9) FROM s""",
)
def share_and_complement(spark, sf):
    shares = E.estimate(
        table(spark, sf, "lineitem"), ["l_returnflag"], v=E.weighted_share(F.col("l_linestatus") == "F", "l_quantity")
    )
    return rounded(E.share_complement(shares, ["l_returnflag"], "v"), 9, "value")
