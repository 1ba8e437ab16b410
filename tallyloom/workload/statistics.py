"""Replicate variance, imputation, cumulative weights and quantile groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..operators import estimators as E
from ..operators import ordering, uncertainty
from ..operators.replicate_groups import replicate_quantile_group_means
from ..operators.uncertainty import REPLICATE, W, Replicates
from .registry import cents, query, replicate_factor, replicate_factor_sql, replicate_weights, rounded, table

R = 20


def design(method: str, key: str = "l_orderkey", line: str = "l_linenumber", full: str = "l_quantity", count: int = R, **kw) -> Replicates:
    vector = None
    if method == "half_sample":
        rule = lambda r: F.when(
            replicate_factor(F.col(key), F.col(line), r) > 1, F.col(full) * 2.0
        )
    else:
        rule = lambda r: F.col(full) * replicate_factor(F.col(key), F.col(line), r)
        vector = replicate_weights(F.col(full), F.col(key), F.col(line))
    return Replicates(full=full, method=method, rule=rule, count=count, vector=vector, **kw)


def high_discount(spark, sf):
    return table(spark, sf, "lineitem").withColumn("hit", (F.col("l_discount") >= 0.05).cast("double"))


_FACTOR = replicate_factor_sql("l_orderkey", "l_linenumber")


def share_sql(by: str, weight: str, scale: str, center: str = "f.est", count: int = R, keep: str = "true") -> str:
    """SQL for a weighted share with replicate variance; ``keep`` filters replicate rows."""
    return f"""WITH base AS (SELECT {by} g, l_quantity w, CASE WHEN l_discount>=0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END v, l_orderkey, l_linenumber FROM lineitem),
    rep AS (SELECT g, r, sum(v*wr)/sum(wr) est FROM (SELECT g, v, r, {weight} wr FROM base, range(1,{count}+1) t(r)) WHERE {keep} GROUP BY 1,2),
    mean AS (SELECT g, avg(est) am, count(*) n FROM rep GROUP BY 1),
    f AS (SELECT g, sum(v*w)/sum(w) est FROM base GROUP BY 1)
    SELECT f.g AS {by}, round(f.est,9) AS estimate, round(sqrt(sum((rep.est-{center})*(rep.est-{center}))*{scale}),9) AS standard_error, CAST(max(mean.n) AS INTEGER) AS replicates
    FROM f JOIN rep ON f.g=rep.g JOIN mean ON f.g=mean.g GROUP BY f.g, f.est"""


def _share(spark, sf, method: str, **kw):
    table_ = design(method, **kw).estimate(
        high_discount(spark, sf), E.WeightedMean("hit"), ["l_returnflag"], ["hit"]
    )
    return rounded(table_, 9, "estimate", "standard_error")


@query("U1 U2 U3", share_sql("l_returnflag", f"w*{_FACTOR}", f"4.0/{R}"))
def sdr_share(spark, sf):
    return _share(spark, sf, "sdr")


@query("U4", share_sql("l_returnflag", f"w*{_FACTOR}", f"1.0/({R}*0.25)"))
def fay_share(spark, sf):
    return _share(spark, sf, "fay", rho=0.5)


@query("U5", share_sql("l_returnflag", f"w*{_FACTOR}", f"1.0/{R}"))
def brr_share(spark, sf):
    return _share(spark, sf, "brr")


@query(
    "U6",
    share_sql("l_returnflag", f"CASE WHEN {_FACTOR}>1 THEN w*2 END", f"(1.0/{R})", "mean.am", keep="wr>0"),
)
def half_sample_share(spark, sf):
    return _share(spark, sf, "half_sample")


@query("U7", share_sql("l_returnflag", f"w*{_FACTOR}", f"(1.0/({R}-1))", "mean.am"))
def bootstrap_share(spark, sf):
    return _share(spark, sf, "bootstrap")


@query("U1 U2 U3", share_sql("l_returnflag", f"w*{_FACTOR}", "4.0/160", count=160))
def sdr_share_160(spark, sf):
    """The number of replicates of the housing survey."""
    return _share(spark, sf, "sdr", count=160)


@query("U7", share_sql("l_returnflag", f"w*{_FACTOR}", "(1.0/998)", "mean.am", count=999))
def bootstrap_share_999(spark, sf):
    """The number of replicates of the survey of finances."""
    return _share(spark, sf, "bootstrap", count=999)


@query(
    "U2",
    f"""SELECT l_linestatus, CAST(r AS INTEGER) AS replicate, round(sum(wr*v)/sum(wr),6) AS mean, CAST(2*sum(wr) AS BIGINT) AS double_weight FROM (
    SELECT l_linestatus, r, round(l_extendedprice*100) v, CASE WHEN r=0 THEN l_quantity ELSE l_quantity*{_FACTOR} END wr FROM lineitem, range(0,{R}+1) t(r)) GROUP BY 1,2""",
)
def replicate_estimate_table(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("v", cents("l_extendedprice"))
    long = design("sdr").long(df, ["l_linestatus", "v"])
    out = uncertainty.replicate_estimates(
        long, ["l_linestatus"], mean=E.weighted_mean("v", W), double_weight=(2 * F.sum(W)).cast("bigint")
    )
    return rounded(out, 6, "mean")


@query(
    "U9 U11",
    """WITH b AS (SELECT c_mktsegment g, coalesce(CASE WHEN c_custkey%9<>0 THEN round(c_acctbal*100) END,0) v, 1.0::DOUBLE+c_custkey%5 w FROM customer),
    m AS (SELECT g, sum(v*w)/sum(w) mu, sum(w) sw, count(*) n FROM b GROUP BY 1)
    SELECT g AS c_mktsegment, round(mu,4) AS estimate, round(se,4) AS standard_error, round(mu-1.96*se,4) AS ci_low, round(mu+1.96*se,4) AS ci_high, n, sw AS weighted_n
    FROM (SELECT b.g, any_value(mu) mu, sqrt(sum((w*(v-mu))*(w*(v-mu))))/any_value(sw) se, any_value(n) n, any_value(sw) sw FROM b JOIN m ON b.g=m.g GROUP BY 1)""",
)
def linearized_means(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_mktsegment",
        F.when(F.col("c_custkey") % 9 != 0, cents("c_acctbal")).alias("v"),
        (F.lit(1.0) + F.col("c_custkey") % 5).alias("w"),
    )
    out = uncertainty.with_ci(uncertainty.linearized_se(df, "v", "w", ["c_mktsegment"]))
    return rounded(out, 4, "estimate", "standard_error", "ci_low", "ci_high")


@query(
    "U10 U11 U12",
    """SELECT o_orderpriority, n, round(p,9) AS share, round(sqrt(p*(1-p)/n),9) AS standard_error, round(greatest(0,p-1.96*sqrt(p*(1-p)/n)),9) AS ci_low,
    round(least(1,p+1.96*sqrt(p*(1-p)/n)),9) AS ci_high, round(1.645*sqrt(p*(1-p)/n),9) AS moe90 FROM (
    SELECT o_orderpriority, count(*) n, sum(CASE WHEN o_orderstatus='F' THEN 1.0::DOUBLE+o_orderkey%7 ELSE 0 END)/sum(1.0::DOUBLE+o_orderkey%7) p FROM orders GROUP BY 1)""",
)
def binomial_shares(spark, sf):
    w = F.lit(1.0) + F.col("o_orderkey") % 7
    shares = E.estimate(
        table(spark, sf, "orders"),
        ["o_orderpriority"],
        n=F.count(F.lit(1)),
        share=E.weighted_share(F.col("o_orderstatus") == "F", w),
    ).withColumn("standard_error", uncertainty.binomial_se("share", "n"))
    low, high = uncertainty.normal_ci("share", "standard_error", low=0.0, high=1.0)
    out = shares.withColumns({"ci_low": low, "ci_high": high, "moe90": uncertainty.margin_of_error("standard_error")})
    return rounded(out, 9, "share", "standard_error", "ci_low", "ci_high", "moe90")


# --- ordered weights -------------------------------------------------------------------------------

_ORD = "(SELECT *, 1.0::DOUBLE+o_orderkey%7 w FROM orders)"


def weighted_orders(spark, sf):
    return table(spark, sf, "orders").withColumn("w", F.lit(1.0) + F.col("o_orderkey") % 7)


_CUM_SQL = f"""SELECT o_orderstatus, CAST(sum(cw) AS BIGINT) AS cum_sum, CAST(max(cw) AS BIGINT) AS cum_max, CAST(sum(cw*(o_orderkey%1000)) AS BIGINT) AS keyed_sum, CAST(min(tw) AS BIGINT) AS total FROM (
    SELECT o_orderstatus, o_orderkey, sum(w) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) cw,
    sum(w) OVER (PARTITION BY o_orderstatus) tw FROM {_ORD}) GROUP BY 1"""


def _cumulative(spark, sf, ranges=None):
    run = ordering.cumulative_weight(
        weighted_orders(spark, sf), "w", "o_orderdate", "o_orderkey", ["o_orderstatus"], ranges
    )
    return run.groupBy("o_orderstatus").agg(
        F.sum("cum_weight").cast("bigint").alias("cum_sum"),
        F.max("cum_weight").cast("bigint").alias("cum_max"),
        F.sum(F.col("cum_weight") * (F.col("o_orderkey") % 1000)).cast("bigint").alias("keyed_sum"),
        F.min("total_weight").cast("bigint").alias("total"),
    )


@query("F2", _CUM_SQL)
def cumulative_weights(spark, sf):
    return _cumulative(spark, sf)


@query("F2", _CUM_SQL)
def cumulative_weights_ranged(spark, sf):
    """Cut into more ranges than there are groups."""
    return _cumulative(spark, sf, 48)


_QSQL = f"""WITH p AS (SELECT o_orderstatus, o_totalprice v, sum(w) w FROM {_ORD} GROUP BY 1,2),
    c AS (SELECT *, sum(w) OVER (PARTITION BY o_orderstatus ORDER BY v) cw, sum(w) OVER (PARTITION BY o_orderstatus) tw FROM p)
    SELECT o_orderstatus, min(CASE WHEN cw>=0.25::DOUBLE*tw THEN v END) AS q_25, min(CASE WHEN cw>=0.5::DOUBLE*tw THEN v END) AS q_50, min(CASE WHEN cw>=0.9::DOUBLE*tw THEN v END) AS q_90 FROM c GROUP BY 1"""


@query("F1", _QSQL)
def weighted_quantiles(spark, sf):
    return ordering.weighted_quantile(
        weighted_orders(spark, sf), "o_totalprice", "w", [0.25, 0.5, 0.9], ["o_orderstatus"]
    )


@query("F1", _QSQL)
def weighted_quantiles_ranged(spark, sf):
    return ordering.weighted_quantile(
        weighted_orders(spark, sf), "o_totalprice", "w", [0.25, 0.5, 0.9], ["o_orderstatus"]
    )


@query(
    "F1",
    f"""WITH c AS (SELECT o_orderkey%5 i, o_totalprice v, sum(w) OVER (PARTITION BY o_orderkey%5 ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) cw,
    sum(w) OVER (PARTITION BY o_orderkey%5) tw FROM {_ORD}) SELECT round(avg(q),6) AS quantile FROM (SELECT i, min(CASE WHEN cw>=tw/2 THEN v END) q FROM c GROUP BY 1)""",
)
def imputed_median(spark, sf):
    df = weighted_orders(spark, sf).withColumn("imp", F.col("o_orderkey") % 5)
    return rounded(ordering.imputed_quantile(df, "o_totalprice", "w", "imp"), 6, "quantile")


_MID_SQL = f"""SELECT CAST(g AS INTEGER) AS quantile_group, count(*) AS n, CAST(sum(w) AS BIGINT) AS weight, min(v) AS lowest, max(v) AS highest FROM (
    SELECT v, w, least(10, floor((cw-w/2)/tw*10)+1) g FROM (SELECT o_totalprice v, w, sum(w) OVER (ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) cw, sum(w) OVER () tw FROM {_ORD})) GROUP BY 1"""


def _group_profile(df):
    return df.groupBy("quantile_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("w").cast("bigint").alias("weight"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


@query("F3", _MID_SQL)
def midpoint_deciles(spark, sf):
    return _group_profile(
        ordering.quantile_groups_midpoint(weighted_orders(spark, sf), "o_totalprice", "w", "o_orderkey", 10)
    )


@query("F3", _MID_SQL)
def midpoint_deciles_ranged(spark, sf):
    return _group_profile(
        ordering.quantile_groups_midpoint(weighted_orders(spark, sf), "o_totalprice", "w", "o_orderkey", 10)
    )


@query(
    "F4 E7",
    f"""SELECT CAST(g AS INTEGER) AS quantile_group, count(*) AS n, CAST(sum(w) AS BIGINT) AS weight, min(v) AS lowest, max(v) AS highest FROM (
    SELECT v, w, 1+(CASE WHEN s>=0.2::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN s>=0.4::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN s>=0.6::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN s>=0.8::DOUBLE THEN 1 ELSE 0 END) g FROM (
      SELECT o_totalprice v, w, sum(w) OVER (ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING)/sum(w) OVER () s FROM {_ORD})) GROUP BY 1""",
)
def right_edge_quintiles(spark, sf):
    return _group_profile(
        ordering.quantile_groups_right_edge(weighted_orders(spark, sf), "o_totalprice", "w", "o_orderkey")
    )


# --- quantile groups inside replicates, imputation --------------------------------------------------

B = 8
_BOOT = f"""(SELECT o_totalprice v, (o_custkey%1000)::DOUBLE bal, o_orderkey k, r, (1+(o_orderkey*r)%7)*((o_orderkey+r)%3)::DOUBLE w FROM orders, range(1,{B}+1) t(r))"""
_REP_GROUPS_SQL = f"""SELECT CAST(r AS INTEGER) AS replicate, CAST(g AS INTEGER) AS quantile_group, round(sum(w*bal)/sum(w),6) AS mean, CAST(sum(w) AS BIGINT) AS weight, count(*) AS n FROM (
    SELECT r, bal, w, least(10, floor((cw-w/2)/tw*10)+1) g FROM (SELECT *, sum(w) OVER (PARTITION BY r ORDER BY v,k ROWS UNBOUNDED PRECEDING) cw, sum(w) OVER (PARTITION BY r) tw FROM {_BOOT} WHERE w>0)) GROUP BY 1,2"""


def bootstrap_weights():
    k = F.col("o_orderkey")
    return F.array(*[((1 + (k * r) % 7) * ((k + r) % 3)).cast("double") for r in range(1, B + 1)])


def _replicate_groups(spark, sf, ranges=None):
    df = table(spark, sf, "orders").withColumn("bal", F.col("o_custkey") % 1000)
    out = replicate_quantile_group_means(
        df, "o_totalprice", "bal", "o_orderkey", bootstrap_weights(), 10, ranges
    )
    return rounded(out, 6, "mean").select(
        REPLICATE, "quantile_group", "mean", F.col("weighted_n").cast("bigint").alias("weight"), "n"
    )


@query("U13", _REP_GROUPS_SQL)
def replicate_decile_means(spark, sf):
    return _replicate_groups(spark, sf)


@query("U13", _REP_GROUPS_SQL)
def replicate_decile_means_ranged(spark, sf):
    """Cut into more ranges than there are deciles."""
    return _replicate_groups(spark, sf, 48)


@query(
    "U7 U8",
    f"""WITH e AS (SELECT o_orderstatus g, o_orderkey%5 i, sum(w*round(o_totalprice*100))/sum(w) m FROM {_ORD} GROUP BY 1,2),
    b AS (SELECT o_orderstatus g, r, sum((1+(o_orderkey*r)%7)*round(o_totalprice*100))/sum(1+(o_orderkey*r)%7) m FROM orders, range(1,{B}+1) t(r) WHERE o_orderkey%5=1 GROUP BY 1,2),
    s AS (SELECT g, var_samp(m) v FROM b GROUP BY 1), c AS (SELECT g, avg(m) est, var_samp(m) iv FROM e GROUP BY 1)
    SELECT g AS o_orderstatus, round(est,3) AS estimate, round(sqrt(s.v+1.2::DOUBLE*iv),3) AS standard_error FROM c JOIN s USING (g)""",
)
def imputation_combined(spark, sf):
    df = weighted_orders(spark, sf).withColumns({"imp": F.col("o_orderkey") % 5, "v": cents("o_totalprice")})
    per = df.groupBy("o_orderstatus", "imp").agg(E.weighted_mean("v", "w").alias("mean"))
    k = F.col("o_orderkey")
    weights = F.array(*[(1 + (k * r) % 7).cast("double") for r in range(1, B + 1)])
    long = uncertainty.to_replicates(df.filter("imp = 1"), weights, ["o_orderstatus", "v"])
    reps = uncertainty.replicate_estimates(long, ["o_orderstatus"], mean=ratio(F.sum(F.col(W) * F.col("v")), F.sum(W)))
    sampling = reps.groupBy("o_orderstatus").agg(F.var_samp("mean").alias("variance"))
    out = uncertainty.combine_imputations(per, sampling, "mean", 5, ["o_orderstatus"])
    return rounded(out.select("o_orderstatus", "estimate", "standard_error"), 3, "estimate", "standard_error")
