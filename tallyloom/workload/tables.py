"""Readers, statistical-JSON flatteners and sinks. Payloads are built from the tables, so there
are more documents and more observations when the tables grow."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frames import rename_and_cast
from ..operators import estimators as E
from ..operators.gates import run_gates
from ..plans.scratch import new_scratch_path
from ..sources import delimited, sinks, statjson
from ..sources.payloads import payload_gates, payload_rows, read_fields
from .registry import cents, query, rounded, table


# --- delimited text and Parquet -----------------------------------------------------------------------


@query(
    "A1",
    """SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys, CAST(sum(round(o_totalprice*100)) AS BIGINT) AS total_cents FROM orders GROUP BY 1""",
)
def contract_csv(spark, sf):
    path = new_scratch_path(spark, "a1")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    orders.write.option("sep", "|").option("header", True).csv(path)
    schema = [
        {"name": "cust", "dtype": "integer"},
        {"name": "status", "dtype": "string"},
        {"name": "price", "dtype": "float"},
    ]
    df = delimited.read_contract_csv(spark, path, schema)
    return df.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cust").alias("keys"),
        F.sum(cents("price")).cast("bigint").alias("total_cents"),
    )


@query(
    "A2",
    """SELECT c_mktsegment, CAST(sum(round(c_acctbal*100)) AS BIGINT) AS total_cents, CAST(count(CASE WHEN c_custkey%11=0 THEN 1 END) AS BIGINT) AS unnamed, 'int,string,double,string' AS types FROM customer GROUP BY 1""",
)
def inferred_csv(spark, sf):
    path = new_scratch_path(spark, "a2")
    table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("c_name"),
        "c_acctbal",
        "c_mktsegment",
    ).write.option("header", True).csv(path)
    df = delimited.read_inferred_csv(spark, path)
    types = ",".join(f.dataType.simpleString() for f in df.schema.fields)
    return df.groupBy("c_mktsegment").agg(
        F.sum(cents("c_acctbal")).cast("bigint").alias("total_cents"),
        F.count_if(F.col("c_name").isNull()).alias("unnamed"),
        F.lit(types).alias("types"),
    )


@query(
    "A3",
    """SELECT s_nationkey, CAST(sum(round(s_acctbal*100)) AS BIGINT) AS total_cents, 'acs' AS survey FROM supplier GROUP BY 1""",
)
def compressed_csv(spark, sf):
    path = new_scratch_path(spark, "a3")
    df = table(spark, sf, "supplier").select("s_nationkey", "s_acctbal")
    df.write.option("header", True).option("compression", "gzip").csv(path)
    read = delimited.read_compressed_csv(spark, path, df.schema, {"survey": "acs", "year": "2024"}, partitions=8)
    out = new_scratch_path(spark, "a3p")
    sinks.write_parquet_zstd(read, out)
    again = spark.read.parquet(out)
    survey = delimited.provenance_of(again)["survey"]
    return again.groupBy("s_nationkey").agg(
        F.sum(cents("s_acctbal")).cast("bigint").alias("total_cents"), F.lit(survey).alias("survey")
    )


@query(
    "A4 H2",
    """SELECT o_orderstatus, count(*) AS n, CAST(count(CASE WHEN o_orderstatus='F' THEN o_orderpriority END) AS BIGINT) AS with_priority, count(*) AS with_file FROM orders GROUP BY 1""",
)
def stacked_members(spark, sf):
    orders = table(spark, sf, "orders")
    first, second = new_scratch_path(spark, "a4"), new_scratch_path(spark, "a4")
    orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(first)
    orders.filter("o_orderstatus <> 'F'").select("o_orderstatus", F.concat(F.lit("k"), "o_orderkey").alias("o_orderkey")).write.option(
        "header", True
    ).csv(second)
    df = delimited.read_members(spark, [first, second])
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("o_orderpriority").alias("with_priority"),
        F.count_if(F.col(delimited.SOURCE_FILE).rlike(r"^part-.*\.csv$")).alias("with_file"),
    )


@query("A16 B1", "SELECT c_mktsegment AS segment, CAST(sum(round(c_acctbal*100)) AS BIGINT) AS total_cents, CAST(count(CASE WHEN c_custkey%6=0 THEN 1 END) AS BIGINT) AS unread FROM customer GROUP BY 1")
def provider_headers(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("Market Segment"),
        F.when(F.col("c_custkey") % 6 == 0, F.lit(".")).otherwise(F.lit("1")).alias("Count"),
        F.col("c_acctbal").cast("string").alias("Thousand Dollars"),
    )
    names = {"Market Segment": "segment", "Thousand Dollars": "dollars", "Count": "customers"}
    df = rename_and_cast(raw, names, ["dollars", "customers"])
    return df.groupBy("segment").agg(
        F.sum(cents("dollars")).cast("bigint").alias("total_cents"), F.count_if(F.col("customers").isNull()).alias("unread")
    )


@query("A17", "SELECT l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def pruned_parquet(spark, sf):
    df = delimited.read_parquet_pruned(spark, f"{sf}/lineitem.parquet", ["l_linestatus", "l_quantity"])
    return df.groupBy("l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("quantity"))


@query(
    "A18",
    """SELECT 'orders.parquet' AS file, count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM orders UNION ALL SELECT 'lineitem.parquet', count(*), 11 FROM lineitem""",
)
def table_inventory(spark, sf):
    return delimited.file_inventory(spark, f"{sf}/orders.parquet").unionByName(
        delimited.file_inventory(spark, f"{sf}/lineitem.parquet")
    )


@query("A19", "SELECT o_orderstatus AS survey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_orderstatus<>'P' GROUP BY 1,2")
def partitioned_zstd(spark, sf):
    path = new_scratch_path(spark, "a19")
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("survey"), F.year("o_orderdate").alias("year"))
    sinks.write_parquet_zstd(df, path, ["survey", "year"])
    back = spark.read.parquet(path).filter("survey <> 'P'")
    return back.groupBy("survey", "year").agg(F.count("o_orderkey").alias("n"))


@query(
    "A20",
    """SELECT o_orderpriority, printf('%.6f', round(sum(CASE WHEN o_orderstatus='F' THEN 1.0::DOUBLE ELSE 0 END)/count(*),6)) AS share, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1""",
)
def result_csv(spark, sf):
    path = new_scratch_path(spark, "a20")
    shares = E.estimate(
        table(spark, sf, "orders"),
        ["o_orderpriority"],
        share=E.weighted_share(F.col("o_orderstatus") == "F", F.lit(1.0)),
        n=F.count(F.lit(1)),
    )
    sinks.write_result_csv(shares, path, ["o_orderpriority"])
    return spark.read.option("header", True).csv(path)


@query(
    "A21",
    """SELECT 'orders' AS analysis, (SELECT count(*) FROM orders) AS rows, (SELECT CAST(sum(1+o_orderkey%7) AS BIGINT) FROM orders) AS population, (SELECT CAST(count(CASE WHEN o_orderkey%11=0 THEN 1 END) AS BIGINT) FROM orders) AS missing""",
)
def analysis_record(spark, sf):
    orders = table(spark, sf, "orders").withColumn("v", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")))
    record = sinks.diagnostics(
        "orders",
        {
            "row_counts": orders.agg(F.count(F.lit(1)).alias("rows")),
            "weighted_population": orders.agg(F.sum(1 + F.col("o_orderkey") % 7).alias("units")),
            "missingness": orders.agg(F.count_if(F.col("v").isNull()).alias("v")),
        },
    )
    path = new_scratch_path(spark, "a21")
    sinks.write_diagnostics(record, path)
    text = spark.read.text(path)
    number = lambda p: F.get_json_object("value", p).cast("bigint")
    return text.select(
        F.get_json_object("value", "$.analysis").alias("analysis"),
        number("$.row_counts.rows").alias("rows"),
        number("$.weighted_population.units").alias("population"),
        number("$.missingness.v").alias("missing"),
    )


# --- statistical JSON ---------------------------------------------------------------------------------

STATUSES = ("F", "O", "P")
YEARS = tuple(str(y) for y in range(1995, 2001))


def _customer_cells(spark, sf):
    """Order counts and amounts per customer, status and year: at most a few cells each."""
    orders = table(spark, sf, "orders")
    return orders.groupBy(
        "o_custkey",
        (F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("o_orderstatus")) - 1).alias("i"),
        (F.year("o_orderdate") - int(YEARS[0])).alias("t"),
    ).agg(F.sum(cents("o_totalprice")).cast("bigint").alias("v"))


def _code_list(name, codes):
    values = F.array(*[F.struct(F.lit(c).alias("id")) for c in codes])
    return F.struct(F.lit(name).alias("id"), values.alias("values"))


def _observation(v):
    return F.array(v.cast("string"), F.lit("0"), F.lit(None).cast("string"))


_CELL_SQL = """SELECT o_custkey, o_orderstatus AS "STATUS", CASE WHEN year(o_orderdate)<=2000 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'idx_'||(year(o_orderdate)-1995) END AS "TIME_PERIOD",
    CAST(sum(round(o_totalprice*100)) AS DOUBLE) AS value FROM orders GROUP BY ALL"""


@query("A5", _CELL_SQL)
def sdmx_series(spark, sf):
    cells = _customer_cells(spark, sf)
    series = cells.groupBy("o_custkey", "i").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("t").cast("string"), _observation(F.col("v"))))).alias("observations")
    )
    docs = series.groupBy("o_custkey").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat(F.lit("0:"), F.col("i").cast("string")), F.struct("observations")))
        ).alias("series")
    )
    dims = F.struct(
        F.array(_code_list("UNIT", ["CENT"]), _code_list("STATUS", STATUSES)).alias("series"),
        F.array(_code_list("TIME_PERIOD", YEARS)).alias("observation"),
    )
    payload = F.struct(
        F.struct(
            F.array(F.struct(dims.alias("dimensions"))).alias("structures"),
            F.array(F.struct("series")).alias("dataSets"),
        ).alias("data")
    )
    docs = docs.select("o_custkey", F.to_json(payload).alias("payload"))
    return statjson.flatten_sdmx_series(docs, "payload", ["UNIT", "STATUS"], ["o_custkey"]).filter("UNIT = 'CENT'").drop("UNIT")


@query("A6", _CELL_SQL)
def sdmx_all_dimensions(spark, sf):
    cells = _customer_cells(spark, sf)
    docs = cells.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "i", "t"), _observation(F.col("v"))))).alias("observations")
    )
    dims = F.struct(F.array(_code_list("STATUS", STATUSES), _code_list("TIME_PERIOD", YEARS)).alias("observation"))
    payload = F.struct(
        F.array(F.struct(dims.alias("dimensions"))).alias("structures"), F.array(F.struct("observations")).alias("dataSets")
    )
    docs = docs.select("o_custkey", F.to_json(payload).alias("payload"))
    return statjson.flatten_sdmx_all_dimensions(docs, "payload", ["STATUS", "TIME_PERIOD"], ["o_custkey"])


def _jsonstat(spark, sf):
    cells = _customer_cells(spark, sf)
    docs = cells.groupBy("o_custkey").agg(
        F.map_from_entries(
            F.collect_list(F.struct((F.col("i") * 7 + F.col("t")).cast("string"), F.col("v").cast("double")))
        ).alias("value")
    )
    index = lambda codes: F.create_map(*[F.lit(x) for i, c in enumerate(codes) for x in (c, i)])
    label = lambda codes: F.create_map(*[F.lit(x) for c in codes for x in (c, f"label {c}")])
    years = [*YEARS, "2001"]
    dimension = F.create_map(
        F.lit("geo"),
        F.struct(F.struct(index(STATUSES).alias("index"), label(STATUSES).alias("label")).alias("category")),
        F.lit("time"),
        F.struct(F.struct(index(years).alias("index"), label(years[:3]).alias("label")).alias("category")),
    )
    payload = F.struct(dimension.alias("dimension"), F.array(F.lit(3), F.lit(7)).alias("size"), "value")
    return docs.select("o_custkey", F.to_json(payload).alias("payload"))


@query(
    "A7",
    """SELECT o_custkey, o_orderstatus AS geo, 'label '||o_orderstatus AS geo_label, CAST(year(o_orderdate) AS VARCHAR) AS time, CASE WHEN year(o_orderdate)<1998 THEN 'label ' ELSE '' END||year(o_orderdate) AS time_label,
    CAST(sum(round(o_totalprice*100)) AS DOUBLE) AS value FROM orders GROUP BY ALL""",
)
def jsonstat_cells(spark, sf):
    return statjson.flatten_jsonstat(_jsonstat(spark, sf), "payload", ["geo", "time"], ["o_custkey"])


@query(
    "A8 E17",
    """SELECT o_custkey, CAST(sum(round(o_totalprice*100)) AS DOUBLE) AS value, true AS dimensions_match FROM orders WHERE o_orderstatus='O' AND year(o_orderdate)=1997 GROUP BY 1""",
)
def jsonstat_lookup(spark, sf):
    docs = _jsonstat(spark, sf)
    cells = statjson.flatten_jsonstat(docs, "payload", ["geo", "time"], ["o_custkey"])
    hit = statjson.jsonstat_lookup(cells, {"geo": "label O", "time": "1997"})
    contract = statjson.jsonstat_dimensions(docs, "payload", ["geo", "time"], ["o_custkey"])
    return hit.join(contract, "o_custkey").select("o_custkey", "value", "dimensions_match")


def _segment_cells(spark, sf):
    nation = table(spark, sf, "nation")
    joined = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_nationkey", "n_name", "c_mktsegment").agg(F.sum(cents("c_acctbal")).cast("bigint").alias("v"), F.count(F.lit(1)).alias("n"))


@query(
    "A9",
    """SELECT 'NY.BAL' AS indicator_id, c_mktsegment AS indicator_name, 'C'||n_nationkey AS country_id, n_name AS country_name, '2023' AS date, CAST(sum(round(c_acctbal*100)) AS DOUBLE) AS value, CAST(1 AS INTEGER) AS decimal
    FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY ALL""",
)
def indicator_records(spark, sf):
    record = F.struct(
        F.struct(F.lit("NY.BAL").alias("id"), F.col("c_mktsegment").alias("value")).alias("indicator"),
        F.struct(F.concat(F.lit("C"), "n_nationkey").alias("id"), F.col("n_name").alias("value")).alias("country"),
        F.lit("2023").alias("date"),
        F.col("v").alias("value"),
        F.lit(1).alias("decimal"),
    )
    docs = _segment_cells(spark, sf).groupBy("n_nationkey").agg(F.to_json(F.collect_list(record)).alias("records"))
    docs = docs.select(F.concat(F.lit('[{"page":1,"pages":1},'), "records", F.lit("]")).alias("payload"))
    out = statjson.flatten_indicator_records(docs, "payload")
    return out.select("indicator_id", "indicator_name", "country_id", "country_name", "date", "value", "decimal")


@query(
    "A10",
    """SELECT n_name AS country_code, CAST(2019 AS INTEGER) AS year, c_mktsegment AS sex, CAST(sum(round(c_acctbal*100)) AS DOUBLE) AS value, CAST(min(1.5) AS DOUBLE) AS low, CAST(count(*) AS DOUBLE) AS high FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY ALL""",
)
def value_records(spark, sf):
    record = F.struct(
        F.col("n_name").alias("SpatialDim"),
        F.lit(2019).alias("TimeDim"),
        F.col("c_mktsegment").alias("Dim1"),
        F.col("v").alias("NumericValue"),
        F.lit(1.5).alias("Low"),
        F.col("n").alias("High"),
    )
    docs = _segment_cells(spark, sf).groupBy("n_nationkey").agg(
        F.to_json(F.struct(F.collect_list(record).alias("value"))).alias("payload")
    )
    return statjson.flatten_value_records(docs, "payload").drop("std_err")


@query(
    "A11",
    """SELECT n_name AS ref_area, c_mktsegment AS sex, CAST(sum(round(c_acctbal*100)) AS DOUBLE) AS obs_value FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY ALL""",
)
def record_lists(spark, sf):
    record = F.struct(F.col("n_name").alias("ref_area"), F.col("c_mktsegment").alias("sex"), F.col("v").alias("obs_value"))
    bare = F.to_json("records")
    wrapped = F.concat(F.lit('{"value":'), bare, F.lit("}"))
    docs = _segment_cells(spark, sf).groupBy("n_nationkey").agg(F.collect_list(record).alias("records"))
    docs = docs.select(F.when(F.col("n_nationkey") % 2 == 0, bare).otherwise(wrapped).alias("payload"))
    return statjson.flatten_record_list(docs, "payload", {"ref_area": "string", "sex": "string", "obs_value": "double"})


def _daily(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(cents("value")).cast("bigint").alias("v"), F.count(F.lit(1)).alias("n")
    )


@query(
    "A12",
    """SELECT event_type AS series_id, CAST(2024 AS INTEGER) AS year, 'D'||strftime(ts,'%d') AS period, 'Day '||day(ts) AS period_name, CAST(sum(round(value*100)) AS DOUBLE) AS value, 'preliminary | n='||count(*) AS footnotes FROM events GROUP BY ALL""",
)
def series_points(spark, sf):
    notes = F.array(F.struct(F.lit("preliminary").alias("text")), F.struct(F.concat(F.lit("n="), "n").alias("text")))
    point = F.struct(
        F.date_format("day", "yyyy").alias("year"),
        F.concat(F.lit("D"), F.date_format("day", "dd")).alias("period"),
        F.concat(F.lit("Day "), F.day("day")).alias("periodName"),
        F.col("v").cast("string").alias("value"),
        notes.alias("footnotes"),
    )
    docs = _daily(spark, sf).groupBy("event_type", F.trunc("day", "month")).agg(F.collect_list(point).alias("data"))
    series = F.array(F.struct(F.col("event_type").alias("seriesID"), "data"))
    payload = F.struct(F.lit("REQUEST_SUCCEEDED").alias("status"), F.struct(series.alias("series")).alias("Results"))
    return statjson.flatten_series_points(docs.select(F.to_json(payload).alias("payload")), "payload")


@query(
    "A13",
    """SELECT event_type, strftime(ts,'%Y-%m-%d') AS date, CAST(CAST(sum(round(value*100)) AS BIGINT) AS VARCHAR) AS value FROM events WHERE day(ts)%3<>0 GROUP BY ALL""",
)
def vintage_observations(spark, sf):
    """Days divisible by three were only published in February."""
    observation = F.struct(
        F.when(F.day("day") % 3 == 0, "2024-02-15").otherwise("2024-01-01").alias("realtime_start"),
        F.lit("9999-12-31").alias("realtime_end"),
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.col("v").cast("string").alias("value"),
    )
    docs = _daily(spark, sf).groupBy("event_type", F.trunc("day", "month")).agg(
        F.to_json(F.struct(F.collect_list(observation).alias("observations"))).alias("payload")
    )
    rows = statjson.flatten_vintage_observations(docs, "payload", ["event_type"])
    return statjson.as_of_vintage(rows, "2024-01-31").select("event_type", "date", "value")


_PACKED = "(SELECT event_id//100 AS doc, event_id, event_id//100%23 AS d, event_type, round(value*100) AS v FROM events)"
_STATUS = "CASE WHEN d=7 THEN 'broken' WHEN d=9 THEN 'absent' WHEN d=11 THEN 'unexpected' ELSE 'parsed' END"


def _packed(spark, sf):
    """A hundred events a payload; some payloads are cut off, absent or hold an error in place of the list."""
    i = F.col("event_id")
    value = F.when(i % 13 == 0, F.lit("n/a")).otherwise(cents("value").cast("bigint").cast("string"))
    record = F.struct(i.alias("id"), F.when(i % 11 == 0, F.lit("zz")).otherwise(F.col("event_type")).alias("type"), value.alias("value"))
    docs = table(spark, sf, "events").groupBy(F.floor(i / 100).alias("doc")).agg(F.to_json(F.struct(F.collect_list(record).alias("value"))).alias("t"))
    d = F.col("doc") % 23
    text = F.when(d == 7, F.expr("left(t, length(t) - 2)")).when(d == 11, F.lit('{"value":"no data"}')).when(d != 9, F.col("t"))
    rows = payload_rows(docs.select("doc", text.alias("payload")), "payload", "$.value", ["doc"])
    known = ["click", "error", "purchase", "signup", "view"]
    return read_fields(rows, {"id": "bigint", "type": "string", "value": "double"}, {"type": known})


@query(
    "A10 A11 J30",
    f"""SELECT DISTINCT doc, 'document' AS "row", {_STATUS} AS status, CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS DOUBLE) AS value, '' AS faults FROM {_PACKED}
    UNION ALL SELECT doc, 'element', 'parsed', event_id, CASE WHEN event_id%11=0 THEN 'zz' ELSE event_type END, CASE WHEN event_id%13<>0 THEN v END,
    concat_ws(', ', CASE WHEN event_id%13=0 THEN 'value: unreadable' END, CASE WHEN event_id%11=0 THEN 'type: unknown code' END) FROM {_PACKED} WHERE {_STATUS}='parsed'""",
)
def payload_elements(spark, sf):
    """Elements of the sound payloads, and what became of each payload, from one pass."""
    rows = _packed(spark, sf)
    return rows.select("doc", "row", "status", "id", "type", "value", F.array_join("faults", ", ").alias("faults"))


@query(
    "J30 E17",
    f"""WITH p AS (SELECT *, {_STATUS} AS status FROM {_PACKED}), g AS (
    SELECT 'payload_'||s AS gate, (SELECT count(DISTINCT doc) FROM p WHERE status=s) AS n FROM (VALUES ('absent'),('broken'),('unexpected'),('empty')) t(s)
    UNION ALL SELECT 'values_read', (SELECT count(*) FROM p WHERE status='parsed' AND event_id%13=0)
    UNION ALL SELECT 'known_codes_type', (SELECT count(*) FROM p WHERE status='parsed' AND event_id%11=0))
    SELECT gate, CASE WHEN n=0 THEN 'pass' ELSE 'fail' END AS status, CAST(n AS DOUBLE) AS observed FROM g""",
)
def payload_contract(spark, sf):
    """The gates of the same pass; an unknown code fails one and is never read as another."""
    return run_gates(_packed(spark, sf), payload_gates(["type"])).select("gate", "status", "observed")


@query(
    "A14",
    """SELECT n_name AS "NAME", c_mktsegment AS "SEG", CAST(count(*) AS VARCHAR) AS "POP" FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY ALL""",
)
def header_row_tables(spark, sf):
    head = F.array(F.array(F.lit("SEG"), F.lit("POP"), F.lit("NAME")))
    row = F.array("c_mktsegment", F.col("n").cast("string"), "n_name")
    docs = _segment_cells(spark, sf).groupBy("n_nationkey").agg(F.collect_list(row).alias("rows"))
    docs = docs.select(F.to_json(F.concat(head, "rows")).alias("payload"))
    return statjson.header_row_table(docs, "payload", ["NAME", "SEG", "POP"])


def _united(spark, sf, names):
    daily = _daily(spark, sf)
    value = F.when(F.day("day") % 5 == 0, F.lit(".")).otherwise(F.col("v").cast("string"))
    series = {
        s: (
            daily.filter(F.col("event_type") == s).select(F.col("day").alias("date"), value.alias("value")),
            {"title": s.upper(), "unit": "cents", "frequency": "daily"},
        )
        for s in names
    }
    out = statjson.union_series(series)
    return out.select("series_id", "series_title", F.date_format("date", "yyyy-MM-dd").alias("day"), "value", "unit", "frequency")


@query(
    "A15",
    """SELECT event_type AS series_id, upper(event_type) AS series_title, strftime(ts,'%Y-%m-%d') AS day, CAST(sum(round(value*100)) AS DOUBLE) AS value, 'cents' AS unit, 'daily' AS frequency
    FROM events WHERE event_type IN ('click','view','purchase') AND day(ts)%5<>0 GROUP BY ALL""",
)
def united_series(spark, sf):
    return _united(spark, sf, ("click", "view", "purchase"))


@query(
    "A15",
    """SELECT event_type AS series_id, upper(event_type) AS series_title, strftime(ts,'%Y-%m-%d') AS day, CAST(sum(round(value*100)) AS DOUBLE) AS value, 'cents' AS unit, 'daily' AS frequency
    FROM events WHERE day(ts)%5<>0 GROUP BY ALL""",
)
def united_series_all(spark, sf):
    return _united(spark, sf, ("click", "view", "purchase", "signup", "error"))
