"""Time-series queries over the event stream table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series
from .registry import cents, query, rounded, table

CUTOFF = "2024-01-15"


def cutoff():
    return F.lit(CUTOFF).cast("timestamp")


_BASE = f"""(SELECT event_type, arg_max(value, (ts, event_id)) b FROM events WHERE ts <= TIMESTAMP '{CUTOFF}' GROUP BY 1)"""


@query(
    "C7 F6 F7",
    f"""SELECT e.event_type, CAST(min(date_diff('day', DATE '{CUTOFF}', CAST(ts AS DATE))) AS BIGINT) AS first_day, CAST(max(date_diff('day', DATE '{CUTOFF}', CAST(ts AS DATE))) AS BIGINT) AS last_day,
    round(max(b),6) AS baseline, round(max(value/b*100),6) AS highest_index, count(*) AS n FROM events e LEFT JOIN {_BASE} x ON e.event_type=x.event_type GROUP BY 1""",
)
def baseline_index(spark, sf):
    based = series.asof_baseline(table(spark, sf, "events"), "event_type", "ts", "value", cutoff(), "event_id")
    day = series.days_since("ts", F.lit(CUTOFF).cast("date"))
    out = based.groupBy("event_type").agg(
        F.min(day).cast("bigint").alias("first_day"),
        F.max(day).cast("bigint").alias("last_day"),
        F.max("baseline").alias("baseline"),
        F.max(series.index_to_baseline("value", "baseline")).alias("highest_index"),
        F.count(F.lit(1)).alias("n"),
    )
    return rounded(out, 6, "baseline", "highest_index")


@query(
    "F5 E8",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events WHERE ts>=TIMESTAMP '2024-01-10') WHERE rn=1""",
)
def latest_per_user(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return series.latest_per_group(df, ["user_id"], "ts", "event_id", cutoff() - F.expr("INTERVAL 5 DAYS")).drop("ts")


@query(
    "F8",
    f"""SELECT b.event_type, strftime(bd,'%Y-%m-%d') AS baseline_day, bv AS baseline_value, strftime(ld,'%Y-%m-%d') AS latest_day, lv AS latest_value, round((lv/bv-1)*100,6) AS percent_change, round(lv-bv,6) AS absolute_change
    FROM (SELECT event_type, max(ts) bd, arg_max(value,(ts,event_id)) bv FROM events WHERE ts<=TIMESTAMP '{CUTOFF}' GROUP BY 1) b JOIN
    (SELECT event_type, max(ts) ld, arg_max(value,(ts,event_id)) lv FROM events GROUP BY 1) l ON b.event_type=l.event_type""",
)
def baseline_latest(spark, sf):
    out = series.baseline_latest_summary(table(spark, sf, "events"), "event_type", "ts", "value", cutoff(), "event_id")
    return rounded(out, 6, "percent_change", "absolute_change").select(
        "event_type",
        F.date_format("baseline_date", "yyyy-MM-dd").alias("baseline_day"),
        "baseline_value",
        F.date_format("latest_date", "yyyy-MM-dd").alias("latest_day"),
        "latest_value",
        "percent_change",
        "absolute_change",
    )


@query(
    "F9",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1,2 HAVING count(*)>1",
)
def duplicated_line_keys(spark, sf):
    return series.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "F10",
    """WITH c AS (SELECT year(l_shipdate) y, l_returnflag f, sum(round(l_extendedprice*100)) v, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 99 END o FROM lineitem GROUP BY ALL)
    SELECT y AS year, f AS l_returnflag, CAST(v AS BIGINT) AS value, CAST(sum(v) OVER (PARTITION BY y ORDER BY o) AS BIGINT) AS upper, CAST(sum(v) OVER (PARTITION BY y ORDER BY o)-v AS BIGINT) AS lower FROM c""",
)
def stacked_bounds(spark, sf):
    df = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), "l_returnflag", cents("l_extendedprice").alias("v"))
    out = series.stack_bounds(df, "year", "l_returnflag", ["R", "A"], "v")
    return out.select("year", "l_returnflag", *[F.col(c).cast("bigint").alias(c) for c in ("value", "upper", "lower")])


@query(
    "L5 F5",
    """SELECT l_returnflag, count(*) AS n FROM lineitem WHERE year(l_shipdate)=(SELECT max(year(l_shipdate))-1 FROM lineitem) GROUP BY 1""",
)
def lagged_latest_year(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    return series.nth_latest(df, "year", 1).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
