"""Composite recipes on stand-in columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import valid_weight
from ..operators import estimators as E
from ..operators.series import order_by_labels
from ..operators.uncertainty import with_ci
from ..plans import recipes
from .contracts import shown
from .registry import cents, query, replicate_factor_sql, rounded, table
from .seriesq import CUTOFF, cutoff
from .statistics import B, bootstrap_weights, design, high_discount

R = 20
_FACTOR = replicate_factor_sql("l_orderkey", "l_linenumber")


def variance_sql(base: str, estimate: str, factor: str, scale: str, extra: str = "", count: int = R) -> str:
    """Common table expressions ``f`` (full sample) and ``s`` (standard error) per group ``g``.

    ``estimate`` and ``extra`` are aggregates over the weight ``wt``; ``base`` has ``g`` and ``w``.
    """
    return f"""base AS ({base}),
    rep AS (SELECT g, r, {estimate} est FROM (SELECT *, w*({factor}) wt FROM base, range(1,{count}+1) t(r)) GROUP BY 1,2),
    f AS (SELECT g, {estimate} est{extra} FROM (SELECT *, w wt FROM base) GROUP BY 1),
    s AS (SELECT f.g, sqrt(sum((rep.est-f.est)*(rep.est-f.est))*{scale}) se FROM f JOIN rep ON f.g=rep.g GROUP BY 1)"""


# --- the flagship ------------------------------------------------------------------------------------


@query(
    "D5 U1 U2 U3 U11 G2",
    "WITH "
    + variance_sql(
        "SELECT l_returnflag g, l_quantity w, CASE WHEN l_discount>=0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END v, l_orderkey, l_linenumber FROM lineitem",
        "sum(v*wt)/sum(wt)",
        _FACTOR,
        f"4.0/{R}",
        ", count(*) n, sum(wt) wn",
    )
    + """ SELECT f.g AS l_returnflag, round(est,9) AS estimate, round(se,9) AS standard_error, round(greatest(0,est-1.96*se),9) AS ci_low, round(least(1,est+1.96*se),9) AS ci_high, n, CAST(wn AS BIGINT) AS weighted_n FROM f JOIN s ON f.g=s.g""",
)
def flagship(spark, sf):
    """Weighted share of high-discount quantity with replicate error and a clamped interval."""
    lines = high_discount(spark, sf).filter(valid_weight("l_quantity"))
    out = design("sdr").estimate(
        lines,
        lambda w: E.weighted_mean("hit", w),
        ["l_returnflag"],
        ["hit"],
        n=lambda w: F.count(F.lit(1)),
        weighted_n=lambda w: F.sum(w).cast("bigint"),
    )
    out = rounded(with_ci(out, low=0.0, high=1.0), 9, "estimate", "standard_error", "ci_low", "ci_high").drop("replicates")
    return order_by_labels(out, "l_returnflag", ["R", "A", "N"])


# --- survey recipes ------------------------------------------------------------------------------------

GROUPS = {"A": "Assisted", "R": "Rented", "N": "None"}
BANDS = ["low", "middle", "high", "top"]
EDGES = [1, 2, 3, 5, 7]

_M1_BASE = """SELECT CASE l_returnflag WHEN 'A' THEN 'Assisted' WHEN 'R' THEN 'Rented' ELSE 'None' END||'|'||CASE WHEN l_linenumber<=2 THEN 'low' WHEN l_linenumber<=3 THEN 'middle' WHEN l_linenumber<=5 THEN 'high' ELSE 'top' END g,
    l_quantity w, CASE WHEN 12*(round(l_extendedprice*100)/1200)/(round(l_extendedprice*100)/100*(1+l_suppkey%3))>0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END v, l_orderkey, l_linenumber
    FROM lineitem WHERE l_linestatus='F' AND l_linenumber BETWEEN 2 AND 7 AND l_extendedprice>0"""


def _renters(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_linestatus",
        F.concat(F.lit("'"), "l_returnflag", F.lit("'")).alias("code"),
        (cents("l_extendedprice") / 1200).alias("cost"),
        (cents("l_extendedprice") / 100 * (1 + F.col("l_suppkey") % 3)).alias("income"),
    )


def _m1_sql(count: int) -> str:
    return (
        "WITH "
        + variance_sql(_M1_BASE, "sum(v*wt)/sum(wt)", _FACTOR, f"4.0/{count}", ", count(*) n, sum(wt) wn", count)
        + """ SELECT split_part(f.g,'|',2) AS poverty_band, split_part(f.g,'|',1) AS "group", round(est,9) AS estimate, round(se,9) AS standard_error, round(greatest(0,est-1.96*se),9) AS ci_low, round(least(1,est+1.96*se),9) AS ci_high,
    CAST(n AS BIGINT) AS unweighted_households, CAST(wn AS BIGINT) AS weighted_households, split_part(f.g,'|',1) IN ('Assisted','None') AS published FROM f JOIN s ON f.g=s.g"""
    )


@query(
    "M1 H4",
    _m1_sql(R),
)
def cost_burden(spark, sf):
    return _cost_burden(spark, sf, R)


@query("M1 U3", _m1_sql(160))
def cost_burden_160(spark, sf):
    """With as many replicates as the survey has."""
    return _cost_burden(spark, sf, 160)


def _cost_burden(spark, sf, count):
    out = recipes.cost_burden(
        _renters(spark, sf),
        design("sdr", count=count),
        code="code",
        groups=GROUPS,
        income="income",
        monthly_cost="cost",
        poverty="l_linenumber",
        edges=EDGES,
        bands=BANDS,
        poverty_range=(2, 7),
        universe=F.col("l_linestatus") == "F",
        published=["Assisted", "None"],
    )
    out = out.withColumn("weighted_households", F.col("weighted_households").cast("bigint")).drop("replicates")
    return rounded(out, 9, "estimate", "standard_error", "ci_low", "ci_high")


@query(
    "M1 J15 U12",
    "WITH "
    + variance_sql(
        "SELECT 1 g, l_quantity w, l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus='F'",
        "sum(wt)/1000",
        _FACTOR,
        f"4.0/{R}",
    )
    + """ SELECT 'benchmark_total' AS gate, CASE WHEN abs(est-750)<=10 THEN 'pass' ELSE 'fail' END AS status, round(est,6) AS observed FROM f
    UNION ALL SELECT 'benchmark_margin_of_error', CASE WHEN abs(1.645*se-8)<=10 THEN 'pass' ELSE 'fail' END, round(1.645*se,6) FROM s""",
)
def occupied_total(spark, sf):
    return shown(recipes.total_benchmark(_renters(spark, sf), design("sdr"), F.col("l_linestatus") == "F", 750.0, 8.0, 10.0))


_M2_GROUPS = """SELECT *, 1+(CASE WHEN sh>=0.2::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN sh>=0.4::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN sh>=0.6::DOUBLE THEN 1 ELSE 0 END)+(CASE WHEN sh>=0.8::DOUBLE THEN 1 ELSE 0 END) g
    FROM (SELECT o_orderkey k, o_totalprice inc, round(o_totalprice*100) ic, (o_custkey%1000)::DOUBLE sp, 1.0::DOUBLE+o_orderkey%7 w, sum(1.0::DOUBLE+o_orderkey%7) OVER (ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING)/sum(1.0::DOUBLE+o_orderkey%7) OVER () sh FROM orders)"""


def _families(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        cents("o_totalprice").alias("income"),
        (F.col("o_custkey") % 1000).cast("double").alias("spending"),
        (F.lit(1.0) + F.col("o_orderkey") % 7).alias("w_full"),
        F.lit(1).alias("one"),
    )


def _m2_sql(count: int) -> str:
    return f"""WITH b AS ({_M2_GROUPS}), rep AS (SELECT g, r, sum(sp*w)/sum(w) est FROM b, range(1,{count}+1) t(r) WHERE (k*(2*r+1)+r*r)%97<48 GROUP BY 1,2),
    m AS (SELECT g, stddev_pop(est) se FROM rep GROUP BY 1), f AS (SELECT g, sum(sp*w)/sum(w) est, sum(ic*w)/sum(w) mi, count(*) n FROM b GROUP BY 1)
    SELECT 'Q'||f.g AS quantile_group, round(est,7) AS estimate, round(se,7) AS standard_error, round(est-1.96*se,7) AS ci_low, round(est+1.96*se,7) AS ci_high, round(mi,3) AS mean_income, n AS unweighted_n FROM f JOIN m ON f.g=m.g"""


@query("M2 E7", _m2_sql(R))
def spending_by_quintile(spark, sf):
    return _spending_by_quintile(spark, sf, R)


@query("M2 U6", _m2_sql(44))
def spending_by_quintile_44(spark, sf):
    """With as many half samples as the survey has."""
    return _spending_by_quintile(spark, sf, 44)


def _spending_by_quintile(spark, sf, count):
    half = design("half_sample", "o_orderkey", "one", "w_full", count)
    out = recipes.spending_by_quantile(
        _families(spark, sf),
        half,
        income="income",
        spending="spending",
        tie="o_orderkey",
        cuts=(0.2, 0.4, 0.6, 0.8),
        labels=["Q1", "Q2", "Q3", "Q4", "Q5"],
    )
    out = rounded(out, 7, "estimate", "standard_error", "ci_low", "ci_high").drop("replicates", "group_no")
    return rounded(out, 3, "mean_income")


@query(
    "M2 D19 J17",
    """SELECT 'coverage_ratio' AS gate, CASE WHEN o BETWEEN 0.55 AND 0.75 THEN 'pass' ELSE 'fail' END AS status, round(o,6) AS observed FROM (SELECT sum((o_custkey%1000)*(1.0::DOUBLE+o_orderkey%7))/sum(1.0::DOUBLE+o_orderkey%7)*4/3000 o FROM orders)""",
)
def annual_coverage(spark, sf):
    return shown(recipes.annual_coverage(_families(spark, sf), "spending", "w_full", 4, 3000.0, 0.55, 0.75))


_M3 = f"""WITH a AS (SELECT o_orderkey k, o_orderkey%5+1 i, o_totalprice v, (o_custkey%1000)::DOUBLE bal, (1.0::DOUBLE+o_orderkey%7)/4 w FROM orders),
    c AS (SELECT *, sum(w) OVER (PARTITION BY i ORDER BY v,k ROWS UNBOUNDED PRECEDING) cw, sum(w) OVER (PARTITION BY i) tw FROM a),
    per AS (SELECT i, least(10, floor((cw-w/2)/tw*10)+1) g, sum(bal*w)/sum(w) m, sum(w) sw, count(*) n FROM c GROUP BY 1,2),
    pt AS (SELECT g, avg(m) est, var_samp(m) iv, sum(sw) hh, CAST(round_even(sum(n)/5.0::DOUBLE,0) AS BIGINT) fam FROM per GROUP BY 1),
    rb AS (SELECT k, v, bal, r, (1+(k*r)%7)*((k+r)%3)::DOUBLE w FROM a, range(1,{B}+1) t(r) WHERE i=1),
    rc AS (SELECT *, sum(w) OVER (PARTITION BY r ORDER BY v,k ROWS UNBOUNDED PRECEDING) cw, sum(w) OVER (PARTITION BY r) tw FROM rb WHERE w>0),
    rm AS (SELECT r, least(10, floor((cw-w/2)/tw*10)+1) g, sum(bal*w)/sum(w) m FROM rc GROUP BY 1,2),
    sv AS (SELECT g, var_samp(m) v FROM rm GROUP BY 1)
    SELECT CAST(pt.g AS INTEGER) AS quantile_group, round(est,6) AS estimate, round(sqrt(sv.v+1.2::DOUBLE*iv),6) AS standard_error, round(est-1.96*sqrt(sv.v+1.2::DOUBLE*iv),6) AS ci_low, round(est+1.96*sqrt(sv.v+1.2::DOUBLE*iv),6) AS ci_high, hh AS weighted_households, fam AS unweighted_families FROM pt JOIN sv ON pt.g=sv.g"""


def _balance(spark, sf, weights=None):
    orders = table(spark, sf, "orders")
    summary = orders.select(
        "o_orderkey",
        F.col("o_orderkey").alias("record"),
        (F.col("o_orderkey") % 5 + 1).alias("imp"),
        "o_totalprice",
        (F.col("o_custkey") % 1000).cast("double").alias("balance"),
        ((F.lit(1.0) + F.col("o_orderkey") % 7) / 4).alias("w"),
    )
    out = recipes.balance_by_quantile(
        summary,
        orders.select("o_orderkey"),
        family="o_orderkey",
        record="record",
        implicate="imp",
        wealth="o_totalprice",
        balance="balance",
        weight="w",
        replicate_key="o_orderkey",
        replicate_weights=bootstrap_weights() if weights is None else weights,
        implicates=5,
    )
    columns = ["estimate", "standard_error", "ci_low", "ci_high"]
    return rounded(out, 6, *columns).select("quantile_group", *columns, "weighted_households", "unweighted_families")


@query("M3 C2 B14 D18", _M3)
def balance_by_decile(spark, sf):
    return _balance(spark, sf)


@query("M3 U13", _M3)
def balance_by_decile_ranged(spark, sf):
    return _balance(spark, sf)


@query("M3 U7 U13", _M3.replace(f"range(1,{B}+1)", "range(1,1000)"))
def balance_by_decile_999(spark, sf):
    """With as many bootstrap replicates as the survey has."""
    k = F.col("o_orderkey")
    weights = F.transform(F.sequence(F.lit(1), F.lit(999)), lambda r: ((1 + (k * r) % 7) * ((k + r) % 3)).cast("double"))
    return _balance(spark, sf, weights)


def _gate_sql(rows: list[tuple[str, str, str]], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{gate}' AS gate, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status, round(CAST({seen} AS DOUBLE),6) AS observed FROM {source}" for gate, seen, ok in rows)


@query(
    "M3 J12 J14",
    "WITH x AS (SELECT count(*) FILTER (o_orderkey%97=0) AS few, count(*) FILTER (o_orderkey%89=0) AS lost FROM orders) "
    + _gate_sql(
        [("implicate_rows_per_family", "few", "few=0"), ("implicate_sets", "few", "few=0"), ("implicate_lowest", "1", "true"), ("implicate_highest", "5", "true"),
         ("join_keys_repeated", "0", "true"), ("join_keys_unmatched", "lost", "lost=0")],
        "x",
    ),
)
def balance_gates(spark, sf):
    """Some families lack an implicate and others their replicate weights."""
    orders = table(spark, sf, "orders")
    summary = orders.select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("imp")).filter("NOT (imp = 5 AND o_orderkey % 97 = 0)")
    summary = summary.withColumn("record", F.col("o_orderkey"))
    lacking = orders.filter("o_orderkey % 89 <> 0")
    return shown(recipes.balance_gates(summary, lacking, family="o_orderkey", record="record", implicate="imp", replicate_key="o_orderkey", implicates=5))


@query(
    "M4 E15",
    """WITH b AS (SELECT c_mktsegment g, coalesce(CASE WHEN c_custkey%9<>0 THEN c_acctbal END,0) v, 1.0::DOUBLE+c_custkey%5 w FROM customer),
    m AS (SELECT g, sum(round(v*100)*w)/sum(w)/100 mu, sum(w) sw, count(*) n, median(v) md FROM b GROUP BY 1),
    e AS (SELECT m.g, mu, sqrt(sum((w*(v-mu))*(w*(v-mu))))/sw se, sw, n, md FROM b JOIN m ON b.g=m.g GROUP BY m.g, mu, sw, n, md)
    SELECT CASE g WHEN 'BUILDING' THEN 'Building trade' ELSE g END AS c_mktsegment, n, CAST(sw AS BIGINT) AS weighted_n, round(mu,1) AS estimate, round(se,1) AS standard_error, round(mu-1.96*se,1) AS ci_low, round(mu+1.96*se,1) AS ci_high, round(md,1) AS median FROM e""",
)
def spending_by_coverage(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_mktsegment",
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("v"),
        (F.lit(1.0) + F.col("c_custkey") % 5).alias("w"),
    )
    out = recipes.spending_by_coverage(df, "c_mktsegment", "v", "w", {"BUILDING": "Building trade"}, digits=1)
    return out.withColumn("weighted_n", F.col("weighted_n").cast("bigint"))


@query(
    "M5",
    """SELECT o_orderpriority, round(p,4) AS estimate, round(sqrt(p*(1-p)/n),4) AS standard_error, round(greatest(0,p-1.96*sqrt(p*(1-p)/n)),4) AS ci_low, round(least(1,p+1.96*sqrt(p*(1-p)/n)),4) AS ci_high, n AS unweighted_n, CAST(sw AS BIGINT) AS weighted_n FROM (
    SELECT o_orderpriority, count(*) n, sum(w) sw, sum(CASE WHEN a='F' THEN w ELSE 0 END)/sum(w) p FROM (SELECT o_orderpriority, CASE WHEN o_orderkey%9<>0 THEN o_orderstatus END a, CASE WHEN o_orderkey%13=0 THEN 0 ELSE 1.0::DOUBLE+o_orderkey%7 END w FROM orders) GROUP BY 1)""",
)
def share_by_category(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_orderkey") % 13 != 0, F.lit(1.0) + F.col("o_orderkey") % 7).alias("w"),
    )
    out = recipes.share_by_category(df, "o_orderpriority", F.col("a") == "F", "w", ["5-LOW", "1-URGENT"])
    return out.withColumn("weighted_n", F.col("weighted_n").cast("bigint"))


_CF = "(CASE WHEN y=1997 AND m<=3 THEN (m-1)/3.0::DOUBLE WHEN y=1998 THEN (4-m)/3.0::DOUBLE ELSE 1.0::DOUBLE END)"
_M21_BASE = f"""SELECT 1 g, o_orderkey k, w, coalesce(c,0) c, {_CF} f FROM (SELECT o_orderkey, 1.0::DOUBLE+o_orderkey%7 w, year(o_orderdate) y, month(o_orderdate) m FROM orders)
    LEFT JOIN (SELECT l_orderkey, sum(round(l_extendedprice*100)) c FROM lineitem WHERE l_partkey%10=3 GROUP BY 1) ON o_orderkey=l_orderkey"""


@query(
    "M21 U5 D7 D13 C1",
    "WITH "
    + variance_sql(_M21_BASE, "sum(c*wt)/sum(f*wt/4)", "CASE WHEN (k*(2*r+1)+r*r)%97<48 THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END", f"1.0/{R}", ", sum(f*wt/4)/1000 pop, count(CASE WHEN c>0 THEN 1 END) rp")
    + """ SELECT round(est,2) AS estimate, round(se,2) AS standard_error, round(pop,6) AS population_thousands, CAST(rp AS BIGINT) AS reporters FROM f JOIN s ON f.g=s.g""",
)
def calendar_year_mean(spark, sf):
    out = _calendar_year(spark, sf)[1]
    return rounded(rounded(out, 2, "estimate", "standard_error"), 6, "population_thousands").drop("replicates")


def _calendar_year(spark, sf):
    families = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.lit(1.0) + F.col("o_orderkey") % 7).alias("w_full"),
        F.month("o_orderdate").alias("month"),
        F.year("o_orderdate").alias("year"),
        F.lit(1).alias("one"),
    )
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", cents("l_extendedprice").alias("cost"))
    out = recipes.calendar_year_mean(
        families,
        lines,
        design("brr", "o_orderkey", "one", "w_full"),
        key="o_orderkey",
        cost="cost",
        month="month",
        year="year",
        selected=F.col("l_partkey") % 10 == 3,
        reference_year=1997,
    )
    return families, out


@query(
    "M21 J15 J21",
    "WITH "
    + variance_sql(_M21_BASE, "sum(c*wt)/sum(f*wt/4)", "CASE WHEN (k*(2*r+1)+r*r)%97<48 THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END", f"1.0/{R}", ", sum(f*wt/4)/1000 pop, count(CASE WHEN c>0 THEN 1 END) rp")
    + """, y AS (SELECT count(DISTINCT CASE WHEN year(o_orderdate) IN (1997,1998) THEN year(o_orderdate) END) inside, count(*) FILTER (year(o_orderdate) NOT IN (1997,1998)) strange FROM orders),
    x AS (SELECT round(est,2) est, round(se,2) se, round(pop,6) pop, rp, inside, strange FROM f JOIN s ON f.g=s.g, y) """
    + _gate_sql(
        [("benchmark_mean", "est", "abs(est-1000000)<=2000000"), ("benchmark_standard_error", "se", "abs(se-0.5)<=0.4"), ("benchmark_population", "pop", "abs(pop-1)<=10000"),
         ("benchmark_reporters", "rp", "rp=12"), ("reference_years", "inside", "inside=2"), ("other_years", "strange", "strange=0")],
        "x",
    ),
)
def calendar_year_gates(spark, sf):
    """The published figures are invented, so some gates fail; orders of other years fail the year's gate."""
    families, out = _calendar_year(spark, sf)
    out = rounded(rounded(out, 2, "estimate", "standard_error"), 6, "population_thousands")
    gates = [recipes.calendar_year_gates(
        out, families, "year", 1997, mean=1e6, standard_error=0.5, tolerance=t, population_thousands=1.0, population_tolerance=1e4, reporters=12
    ).filter(F.col("gate").isin(*names)) for t, names in ((2e6, ["benchmark_mean"]), (0.4, ["benchmark_standard_error", "benchmark_population", "benchmark_reporters", "reference_years", "other_years"]))]
    return shown(gates[0].unionByName(gates[1]))


# --- macro recipes ---------------------------------------------------------------------------------------


def _daily_series(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("date")).agg(
        F.sum(cents("value")).alias("value")
    )


_DAILY = "(SELECT event_type series, CAST(ts AS DATE) d, sum(round(value*100)) v FROM events GROUP BY 1,2)"


@query(
    "M6 C7 F6 F7",
    f"""SELECT x.series, CAST(date_diff('day',DATE '{CUTOFF}',x.d) AS INTEGER) AS days_since_event, round(x.v/b.v*100,6) AS "index", CAST(x.v AS BIGINT) AS value FROM {_DAILY} x JOIN (SELECT series, arg_max(v,d) v FROM {_DAILY} WHERE d<=DATE '{CUTOFF}' GROUP BY 1) b ON x.series=b.series""",
)
def event_watch(spark, sf):
    out = recipes.event_watch(_daily_series(spark, sf), "series", "date", "value", cutoff().cast("date"))
    return rounded(out, 6, "index").select("series", "days_since_event", "index", F.col("value").cast("bigint").alias("value"))


@query(
    "M6 J15 F8",
    f"""SELECT 'baseline_'||series AS gate, CASE WHEN abs(v-CASE series WHEN 'click' THEN 0 ELSE 200000 END)<=180000 THEN 'pass' ELSE 'fail' END AS status, v AS observed FROM (SELECT series, arg_max(v,d) v FROM {_DAILY} WHERE d<=DATE '{CUTOFF}' AND series IN ('click','view') GROUP BY 1)""",
)
def event_watch_gates(spark, sf):
    at = F.lit(CUTOFF).cast("date")
    expected = {"click": 0.0, "view": 200000.0}
    return shown(recipes.event_watch_gates(_daily_series(spark, sf), "series", "date", "value", at, expected, 180000.0))


def _nation_cells(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("n_name").alias("area"), F.col("c_mktsegment").alias("item")).agg(
        F.sum(cents("c_acctbal")).cast("bigint").alias("value")
    )


_NATION_CELLS = "(SELECT n_name area, c_mktsegment item, CAST(sum(round(c_acctbal*100)) AS BIGINT) AS value FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1,2)"


@query(
    "M7 B9 B12",
    f"SELECT area, value FROM {_NATION_CELLS} WHERE item='BUILDING' AND area IN ('NATION_1','NATION_2','NATION_3','NATION_10','NATION_99')",
)
def member_ranking(spark, sf):
    members = [f"NATION_{i}" for i in (1, 2, 3, 10, 99)]
    return recipes.member_ranking(_nation_cells(spark, sf), {"item": "BUILDING"}, "area", members, "value")


_QUARTERS = """(SELECT c_nationkey area, year(o_orderdate)||'-Q'||quarter(o_orderdate) period, o_orderstatus item, CAST(sum(round(o_totalprice*100)) AS BIGINT) AS v FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY ALL)"""


@query(
    "M8 F5 G1 E8",
    f"""SELECT CAST(area AS BIGINT) AS area, period, v AS growth FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY period DESC) rn FROM {_QUARTERS} WHERE item='F' AND period>='1997-Q1') WHERE rn=1 ORDER BY v DESC, area LIMIT 10""",
)
def latest_growth(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    period = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    cells = joined.groupBy(F.col("c_nationkey").cast("bigint").alias("area"), period.alias("period"), F.col("o_orderstatus").alias("item")).agg(
        F.sum(cents("o_totalprice")).alias("v")
    )
    out = recipes.latest_growth(cells, {"item": "F"}, "area", "period", "v", 10, "v", min_period="1997-Q1", digits=0)
    return out.withColumn("growth", F.col("growth").cast("bigint"))


@query(
    "M9 B11 B12 G1",
    f"SELECT area, value FROM (SELECT area, CAST(sum(value) AS BIGINT) AS value FROM {_NATION_CELLS} GROUP BY 1) WHERE regexp_full_match(area,'NATION_[0-9]+') AND area NOT IN ('NATION_0','NATION_5') ORDER BY value DESC, area LIMIT 15",
)
def top_economies(spark, sf):
    totals = _nation_cells(spark, sf).groupBy("area").agg(F.sum("value").alias("value"))
    return recipes.top_economies(totals, "area", "^NATION_[0-9]+$", ["NATION_0", "NATION_5"], "value", 15)


@query(
    "M10 B4 D10 G2",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CASE l_linenumber WHEN 1 THEN 'public' WHEN 2 THEN 'public' WHEN 3 THEN 'compulsory' ELSE 'own' END AS band, CAST(sum(round(l_extendedprice*100)) AS DOUBLE) AS value
    FROM lineitem WHERE l_returnflag='R' AND l_linenumber<=4 AND year(l_shipdate)<=1999 GROUP BY 1,2""",
)
def financing_bands(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.concat(F.lit("HF"), "l_linenumber").alias("scheme"),
        F.year("l_shipdate").cast("string").alias("period"),
        cents("l_extendedprice").alias("v"),
    )
    schemes = {"HF1": "public", "HF2": "public", "HF3": "compulsory", "HF4": "own"}
    return recipes.financing_bands(df, {"l_returnflag": "R"}, "scheme", schemes, "period", "v", ["own", "compulsory", "public"], 1999)


@query(
    "M11 D16",
    f"""WITH l AS (SELECT CASE area WHEN 'NATION_1' THEN 'One' WHEN 'NATION_2' THEN 'Two' WHEN 'NATION_3' THEN 'Three' END country, value AS level FROM {_NATION_CELLS} WHERE item='MACHINERY' AND area IN ('NATION_1','NATION_2','NATION_3'))
    SELECT country, level, round((SELECT avg(level) FROM l WHERE country IN ('Two','Three')),4) AS peer_mean, (SELECT min(level) FROM l WHERE country IN ('Two','Three')) AS peer_min, (SELECT max(level) FROM l WHERE country IN ('Two','Three')) AS peer_max FROM l""",
)
def level_versus_peers(spark, sf):
    names = {"NATION_1": "One", "NATION_2": "Two", "NATION_3": "Three"}
    cells = _nation_cells(spark, sf).filter(F.col("area").isin(*names))
    return rounded(recipes.level_versus_peers(cells, {"item": "MACHINERY"}, "area", names, "value", ["Two", "Three"]), 4, "peer_mean")


COUNTRIES = {"A": "Alpha", "R": "Romeo", "N": "November"}
_GRID = """(SELECT l_returnflag area, l_linestatus kids, 'AW'||(l_linenumber*25) grid, l_linenumber*25 lvl, sum(round(l_tax*100)*l_quantity)/sum(l_quantity) rate, sum(round(l_extendedprice*100))/sum(l_quantity)/100 cost FROM lineitem GROUP BY ALL)"""
_NAME_SQL = "CASE area WHEN 'A' THEN 'Alpha' WHEN 'R' THEN 'Romeo' ELSE 'November' END"


def _grid(spark, sf):
    """Long table of two measures over a grid of levels."""
    cells = table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("kids"), F.concat(F.lit("AW"), F.col("l_linenumber") * 25).alias("grid")
    ).agg(
        (F.sum(F.round(F.col("l_tax") * 100) * F.col("l_quantity")) / F.sum("l_quantity")).alias("TW"),
        (F.sum(cents("l_extendedprice")) / F.sum("l_quantity") / 100).alias("LC"),
    )
    return cells.unpivot(["area", "kids", "grid"], ["TW", "LC"], "measure", "value")


def _wage_sql(kids: str) -> str:
    return f"SELECT CAST(lvl AS INTEGER) AS wage_pct, {_NAME_SQL} AS country, round(rate,6) AS rate FROM {_GRID} WHERE kids='{kids}' AND lvl BETWEEN 50 AND 150"


@query("M12 B10 B7", _wage_sql("F"))
def wage_grid_single(spark, sf):
    return rounded(recipes.wage_grid(_grid(spark, sf), {"measure": "TW", "kids": "F"}, "area", COUNTRIES, "grid", "AW", 50, 150, "value"), 6, "rate")


@query("M13 B10 B7", _wage_sql("O"))
def wage_grid_family(spark, sf):
    return rounded(recipes.wage_grid(_grid(spark, sf), {"measure": "TW", "kids": "O"}, "area", COUNTRIES, "grid", "AW", 50, 150, "value"), 6, "rate")


def _premium(spark, sf, kids, add_num, add_den):
    df = _grid(spark, sf).filter(F.col("kids") == kids)
    return recipes.premium_adjusted_grid(
        df, "measure", "TW", "LC", "area", COUNTRIES, "grid", "AW", 50, 150, "value", "A", "Alpha + premium", add_num, add_den
    )


def _premium_sql(kids: str, add_num: float, add_den: float) -> str:
    return f"""{_wage_sql(kids)} UNION ALL SELECT CAST(lvl AS INTEGER), 'Alpha + premium', round((rate/100*cost+{add_num})/(cost+{add_den})*100,6) FROM {_GRID} WHERE kids='{kids}' AND area='A' AND lvl BETWEEN 50 AND 150"""


@query("M14 C3 B16 H1", _premium_sql("F", 500, 300))
def premium_grid_single(spark, sf):
    return rounded(_premium(spark, sf, "F", 500.0, 300.0), 6, "rate")


@query("M15 C3 B16 H1", _premium_sql("O", 900, 700))
def premium_grid_family(spark, sf):
    return rounded(_premium(spark, sf, "O", 900.0, 700.0), 6, "rate")


@query(
    "M14 M15 D16 J17",
    f"""WITH g AS ({_premium_sql("F", 500, 300)}), x AS (SELECT max(CASE WHEN country='Alpha + premium' THEN rate END) a, max(CASE WHEN country='Alpha' THEN rate END) b, min(CASE WHEN country IN ('Romeo','November') THEN rate END) p FROM g WHERE wage_pct=100)
    SELECT 'adjusted_above_plain' AS gate, CASE WHEN a>b THEN 'pass' ELSE 'fail' END AS status, round(a-b,4) AS observed FROM x UNION ALL SELECT 'adjusted_above_lowest_peer', CASE WHEN a>=p THEN 'pass' ELSE 'fail' END, round(a-p,4) FROM x""",
)
def premium_ordering(spark, sf):
    return rounded(shown(recipes.premium_gates(_premium(spark, sf, "F", 500.0, 300.0), "Alpha + premium", "Alpha", ["Romeo", "November"], 100)), 4, "observed")


def _sales(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_linestatus",
        "l_suppkey",
        F.col("l_returnflag").alias("owner"),
        F.when(F.col("l_suppkey") % 13 != 0, cents("l_extendedprice")).alias("revenue"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_quantity") * 1000).alias("sales"),
    )


_SALES = """(SELECT l_returnflag "owner", CASE WHEN l_suppkey%13<>0 AND l_partkey%17<>0 THEN round(l_extendedprice*100) END rev, CASE WHEN l_suppkey%13<>0 AND l_partkey%17<>0 THEN l_quantity*1000 END mwh FROM lineitem WHERE l_linestatus='O')"""


@query(
    "M16 D6 E10",
    f"""SELECT coalesce("owner",'all owners') AS "owner", round(100*sum(rev)/sum(mwh),6) AS price FROM {_SALES} GROUP BY ROLLUP("owner") HAVING "owner" IS NULL OR "owner" IN ('A','R')""",
)
def price_by_owner(spark, sf):
    return rounded(recipes.price_by_owner(_sales(spark, sf), F.col("l_linestatus") == "O", "owner", ["A", "R"], "revenue", "sales"), 6, "price")


_CLASS_SALES = _SALES.replace("(SELECT", "(SELECT l_suppkey,", 1)


@query(
    "M16 D6",
    f"""SELECT x.n AS "owner", round(100*sum(rev)/sum(mwh),6) AS price FROM {_CLASS_SALES}, (VALUES ('A'),('R'),('authority'),('nobody'),('all owners')) x(n)
    WHERE n='all owners' OR "owner"=n OR (n='authority' AND l_suppkey%5=0) GROUP BY 1 UNION ALL SELECT 'nobody', NULL""",
)
def price_by_class(spark, sf):
    """Owners beside a class that another column gives, as a balancing authority does, and one without rows."""
    classes = {"A": F.col("owner") == "A", "R": F.col("owner") == "R", "authority": F.col("l_suppkey") % 5 == 0, "nobody": F.col("l_suppkey") < 0}
    return rounded(recipes.price_by_class(_sales(spark, sf), F.col("l_linestatus") == "O", classes, "revenue", "sales"), 6, "price")


@query(
    "M16 D17 J17",
    f"""WITH p AS (SELECT 100*sum(rev)/sum(mwh) u, 100*sum(CASE WHEN "owner"='A' THEN rev END)/sum(CASE WHEN "owner"='A' THEN mwh END) a, 100*sum(CASE WHEN "owner"='R' THEN rev END)/sum(CASE WHEN "owner"='R' THEN mwh END) b FROM {_SALES})
    SELECT 'benchmark_price' AS gate, CASE WHEN u/20000 BETWEEN 0.9 AND 1.1 THEN 'pass' ELSE 'fail' END AS status, round(u/20000,6) AS observed FROM p UNION ALL SELECT 'owner_ratio', CASE WHEN a/b>0 THEN 'pass' ELSE 'fail' END, round(a/b,6) FROM p""",
)
def owner_price_gates(spark, sf):
    prices = recipes.price_by_owner(_sales(spark, sf), F.col("l_linestatus") == "O", "owner", ["A", "R"], "revenue", "sales")
    return shown(recipes.price_gates(prices, "A", "R", 20000.0, 0.9, 1.1))


@query(
    "M17 J23",
    """SELECT 'gain' AS gate, CASE WHEN bad=0 THEN 'pass' ELSE 'fail' END AS status, CAST(bad AS DOUBLE) AS observed FROM (SELECT count(*) bad FROM (SELECT o_orderpriority FROM orders GROUP BY 1) WHERE o_orderpriority='5-LOW')""",
)
def published_table_consistency(spark, sf):
    """A published table of counts before, after and gained; one printed gain is off by one."""
    from ..operators.gates import arithmetic, run_gates

    before = F.count_if(F.year("o_orderdate") < 1998)
    published = table(spark, sf, "orders").groupBy("o_orderpriority").agg(before.alias("before"), F.count(F.lit(1)).alias("after"))
    printed = published.withColumn(
        "gain", F.col("after") - F.col("before") + F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0)
    )
    return shown(run_gates(printed, [arithmetic("gain", F.col("gain"), F.col("after") - F.col("before"))]))


# --- agreement across sources ------------------------------------------------------------------------------


def agreement(df):
    return rounded(df, 6, "value_a", "value_b", "difference").select("check", "value_a", "value_b", "difference", "status")


@query(
    "M18 B18 C8 J16",
    """SELECT 'population' AS "check", a AS value_a, b AS value_b, round(abs(a-b)/greatest(abs(b),1e-9),6) AS difference, CASE WHEN abs(a-b)/greatest(abs(b),1e-9)<=0.05 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT sum(1.0::DOUBLE+o_orderkey%7) a FROM orders), (SELECT sum(l_linenumber)::DOUBLE b FROM lineitem WHERE l_linenumber<3)
    UNION ALL SELECT 'without', NULL, NULL, NULL, 'skip'""",
)
def population_agreement(spark, sf):
    a = table(spark, sf, "orders").select((F.lit(1.0) + F.col("o_orderkey") % 7).cast("string").alias("PERWT"))
    b = table(spark, sf, "lineitem").filter("l_linenumber < 3").select(F.col("l_linenumber").alias("asecwt"))
    both = recipes.population_agreement(a, b, ["PWGTP", "PERWT"], ["WTFINL", "ASECWT"])
    return agreement(both.unionByName(recipes.population_agreement(a, b, ["NONE"], ["ASECWT"], check="without")))


@query(
    "M19 B18 D5 C8 J15",
    """SELECT 'share' AS "check", round(a,6) AS value_a, round(b,6) AS value_b, round(abs(a-b)*100,6) AS difference, CASE WHEN abs(a-b)*100<=5 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT sum(CASE WHEN o_orderpriority LIKE '3-%' THEN 1.0::DOUBLE+o_orderkey%7 ELSE 0 END)/sum(1.0::DOUBLE+o_orderkey%7) a FROM orders), (SELECT sum(CASE WHEN l_linenumber=3 THEN l_quantity ELSE 0 END)/sum(l_quantity) b FROM lineitem)""",
)
def share_agreement(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("INSCOV23"), (F.lit(1.0) + F.col("o_orderkey") % 7).alias("PERWT23F"))
    b = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("HIINT"), F.col("l_quantity").alias("ASECWT"))
    return agreement(recipes.share_agreement(a, b, ["INSCOV23"], ["HIINT"], ["PERWT23F"], ["ASECWT", "WTFINL"], "3"))


@query(
    "M20 C8 J16",
    f"""SELECT 'macro' AS "check", round(a,6) AS value_a, round(b,6) AS value_b, round(abs(a-b)/greatest(abs(b),1e-9),6) AS difference, CASE WHEN a IS NULL OR b IS NULL THEN 'fail' ELSE 'pass' END AS status FROM
    (SELECT arg_max(v,period)::DOUBLE a FROM {_QUARTERS} WHERE area=3 AND item='F'), (SELECT max(value)*100*1.0813::DOUBLE b FROM {_NATION_CELLS} WHERE area='NATION_3' AND item='BUILDING')""",
)
def macro_agreement(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    period = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    a = joined.groupBy(F.col("c_nationkey").alias("area"), period.alias("period"), F.col("o_orderstatus").alias("item")).agg(F.sum(cents("o_totalprice")).alias("v"))
    out = recipes.macro_agreement(
        a, _nation_cells(spark, sf), {"area": 3, "item": "F"}, {"area": "NATION_3", "item": "BUILDING"}, "period", "v", "value", 100.0, 1.0813
    )
    return agreement(out)


