"""Statistical-JSON payloads, one document per row, to observation rows.

Work spreads over documents; one document is parsed by one task. Code lists are taken into
top-level columns before anything is exploded, and every exploded row is projected down to its
codes at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import to_number

_DIM = "array<struct<id:string,values:array<struct<id:string>>>>"
_STRUCTURES = f"array<struct<dimensions:struct<series:{_DIM},observation:{_DIM}>>>"
_SETS = (
    "array<struct<series:map<string,struct<observations:map<string,array<string>>>>,"
    "observations:map<string,array<string>>>>"
)
_SDMX = f"struct<data:struct<structures:{_STRUCTURES},dataSets:{_SETS}>,structures:{_STRUCTURES},dataSets:{_SETS}>"


def _sdmx_heads(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    doc = df.select(*keep, F.from_json(text, _SDMX).alias("__p"))
    structure = F.get(F.coalesce("__p.data.structures", "__p.structures"), F.lit(0))
    dataset = F.get(F.coalesce("__p.data.dataSets", "__p.dataSets"), F.lit(0))
    return doc.select(
        *keep,
        structure["dimensions"]["series"].alias("__sdims"),
        structure["dimensions"]["observation"].alias("__odims"),
        dataset["series"].alias("__series"),
        dataset["observations"].alias("__obs"),
    )


def _codes(dims: str, name: str) -> Column:
    hit = F.get(F.filter(F.col(dims), lambda d: d["id"] == F.lit(name)), F.lit(0))
    return F.transform(hit["values"], lambda v: v["id"])


def _position(dims: str, name: str) -> Column:
    return F.array_position(F.transform(F.col(dims), lambda d: d["id"]), F.lit(name)) - 1


def _index(parts: Column, position: Column) -> Column:
    return F.when(position >= 0, F.get(parts, position.cast("int")).try_cast("int"))


def flatten_sdmx_series(df: DataFrame, text: str, dims: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Series keyed ``i:j:k`` with observations keyed by time index.

    ``dims`` are the series dimensions to return. A code index outside its list gives null; a
    time index outside gives ``idx_<n>``.
    """
    heads = _sdmx_heads(df, text, keep)
    flat = heads.select(
        *keep,
        *[_codes("__sdims", d).alias(f"__c{i}") for i, d in enumerate(dims)],
        *[_position("__sdims", d).alias(f"__p{i}") for i, d in enumerate(dims)],
        F.transform(F.get("__odims", F.lit(0))["values"], lambda v: v["id"]).alias("__times"),
        F.explode("__series").alias("__key", "__one"),
    )
    parts = F.split("__key", ":")
    coded = flat.select(
        *keep,
        *[F.get(f"__c{i}", _index(parts, F.col(f"__p{i}"))).alias(d) for i, d in enumerate(dims)],
        "__times",
        F.explode("__one.observations").alias("__t", "__v"),
    )
    time = F.coalesce(F.get("__times", F.col("__t").cast("int")), F.concat(F.lit("idx_"), F.col("__t")))
    return coded.select(
        *keep, *dims, time.alias("TIME_PERIOD"), to_number(F.get("__v", F.lit(0))).alias("value")
    )


def flatten_sdmx_all_dimensions(df: DataFrame, text: str, dims: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Observations keyed by the indices of all dimensions. An index outside its code list gives
    ``idx_<n>``."""
    heads = _sdmx_heads(df, text, keep)
    flat = heads.select(
        *keep,
        *[_codes("__odims", d).alias(f"__c{i}") for i, d in enumerate(dims)],
        *[_position("__odims", d).alias(f"__p{i}") for i, d in enumerate(dims)],
        F.explode("__obs").alias("__key", "__v"),
    )
    parts = F.split("__key", ":")

    def code(i: int) -> Column:
        index = _index(parts, F.col(f"__p{i}"))
        return F.coalesce(F.get(f"__c{i}", index), F.concat(F.lit("idx_"), index))

    return flat.select(
        *keep, *[code(i).alias(d) for i, d in enumerate(dims)], to_number(F.get("__v", F.lit(0))).alias("value")
    )


_JSONSTAT = (
    "struct<dimension:map<string,struct<category:struct<index:map<string,int>,label:map<string,string>>>>,"
    "size:array<bigint>,value:map<string,double>>"
)


def flatten_jsonstat(df: DataFrame, text: str, dims: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Flat-index values to one row per cell with code and label of each dimension.

    ``dims`` gives the dimension order that the flat index was built in.
    """
    doc = df.select(*keep, F.from_json(text, _JSONSTAT).alias("__p"))
    heads = doc.select(
        *keep,
        F.col("__p.size").alias("__size"),
        *[
            F.map_from_entries(
                F.transform(
                    F.map_entries(F.try_element_at(F.col("__p.dimension"), F.lit(d))["category"]["index"]),
                    lambda e: F.struct(e["value"], e["key"]),
                )
            ).alias(f"__c{i}")
            for i, d in enumerate(dims)
        ],
        *[
            F.try_element_at(F.col("__p.dimension"), F.lit(d))["category"]["label"].alias(f"__l{i}")
            for i, d in enumerate(dims)
        ],
        F.col("__p.value").alias("__value"),
    )
    cells = heads.select(
        *[c for c in heads.columns if c != "__value"], F.explode("__value").alias("__flat", "value")
    )
    flat = F.col("__flat").cast("bigint")

    def stride(i: int) -> Column:
        out = F.lit(1).cast("bigint")
        for j in range(i + 1, len(dims)):
            out = out * F.get("__size", F.lit(j))
        return out

    indexed = cells.select(
        "*",
        *[
            F.pmod(F.floor(flat / stride(i)), F.get("__size", F.lit(i))).cast("int").alias(f"__i{i}")
            for i in range(len(dims))
        ],
    )
    out: list[Column] = []
    for i, d in enumerate(dims):
        found = F.try_element_at(F.col(f"__c{i}"), F.col(f"__i{i}"))
        out.append(F.coalesce(found, F.col(f"__i{i}").cast("string")).alias(d))
        label = F.try_element_at(F.col(f"__l{i}"), found)
        out.append(F.coalesce(label, found, F.lit("")).alias(f"{d}_label"))
    return indexed.select(*keep, *out, "value")


def jsonstat_dimensions(df: DataFrame, text: str, dims: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Per document: does the payload have exactly these dimensions, and one size for each."""
    doc = df.select(*keep, F.from_json(text, _JSONSTAT).alias("__p"))
    have = F.array_sort(F.map_keys("__p.dimension"))
    want = F.array_sort(F.array(*[F.lit(d) for d in dims]))
    return doc.select(
        *keep,
        F.coalesce(have == want, F.lit(False)).alias("dimensions_match"),
        F.coalesce(F.size("__p.size") == F.lit(len(dims)), F.lit(False)).alias("sizes_match"),
    )


def jsonstat_lookup(cells: DataFrame, coordinates: Mapping[str, str]) -> DataFrame:
    """Cells at the given coordinates, each given as code or label."""
    out = cells
    for dim, wanted in coordinates.items():
        out = out.filter((F.col(dim) == F.lit(wanted)) | (F.col(f"{dim}_label") == F.lit(wanted)))
    return out


_PAIR = "struct<id:string,value:string>"
_INDICATOR = (
    f"array<struct<indicator:{_PAIR},country:{_PAIR},countryiso3code:string,date:string,value:double,"
    "unit:string,obs_status:string,decimal:int>>"
)


def flatten_indicator_records(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``[meta, [records]]`` with nested id-value pairs."""
    records = F.from_json(F.get_json_object(text, "$[1]"), _INDICATOR)
    rows = df.select(*keep, F.explode(records).alias("r"))
    return rows.select(
        *keep,
        F.col("r.indicator.id").alias("indicator_id"),
        F.col("r.indicator.value").alias("indicator_name"),
        F.col("r.country.id").alias("country_id"),
        F.col("r.country.value").alias("country_name"),
        "r.countryiso3code",
        "r.date",
        "r.value",
        "r.unit",
        "r.obs_status",
        "r.decimal",
    )


def _records(text: str, element: str, field: str = "value") -> Column:
    """Records of a bare list, or of the list under ``field`` of an object."""
    bare = F.from_json(text, f"array<{element}>")
    wrapped = F.from_json(text, f"struct<{field}:array<{element}>>")[field]
    return F.when(F.ltrim(F.col(text)).startswith("["), bare).otherwise(wrapped)


def flatten_value_records(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``{"value": [...]}`` of dimensioned values with optional bounds."""
    element = (
        "struct<SpatialDim:string,TimeDim:int,Dim1:string,NumericValue:double,Low:double,High:double,StdErr:double>"
    )
    rows = df.select(*keep, F.explode(_records(text, element)).alias("r"))
    names = {
        "SpatialDim": "country_code",
        "TimeDim": "year",
        "Dim1": "sex",
        "NumericValue": "value",
        "Low": "low",
        "High": "high",
        "StdErr": "std_err",
    }
    return rows.select(*keep, *[F.col(f"r.{old}").alias(new) for old, new in names.items()])


def flatten_record_list(df: DataFrame, text: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """A list of flat records, bare or under ``value``. ``fields`` maps names to Spark types."""
    element = "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"
    rows = df.select(*keep, F.explode(_records(text, element)).alias("r"))
    return rows.select(*keep, *[F.col(f"r.{n}").alias(n) for n in fields])


def flatten_series_points(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Nested series to typed points, footnote texts joined with `` | ``."""
    schema = (
        "struct<Results:struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,"
        "periodName:string,value:string,footnotes:array<struct<text:string>>>>>>>>"
    )
    series = df.select(*keep, F.explode(F.from_json(text, schema)["Results"]["series"]).alias("s"))
    points = series.select(*keep, F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("p"))
    notes = F.transform(F.col("p.footnotes"), lambda f: F.coalesce(f["text"], F.lit("")))
    return points.select(
        *keep,
        "series_id",
        F.col("p.year").cast("int").alias("year"),
        "p.period",
        F.col("p.periodName").alias("period_name"),
        to_number("p.value").alias("value"),
        F.coalesce(F.array_join(notes, " | "), F.lit("")).alias("footnotes"),
    )


def flatten_vintage_observations(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Observations with the real-time window in which each value was the published one."""
    element = "struct<realtime_start:string,realtime_end:string,date:string,value:string>"
    rows = df.select(*keep, F.explode(_records(text, element, "observations")).alias("r"))
    return rows.select(
        *keep, "r.date", F.col("r.value").alias("value"), "r.realtime_start", "r.realtime_end"
    )


def as_of_vintage(observations: DataFrame, day: str) -> DataFrame:
    """Values that were published on a given day; ISO dates compare as text."""
    return observations.filter((F.col("realtime_start") <= F.lit(day)) & (F.col("realtime_end") >= F.lit(day)))


def header_row_table(df: DataFrame, text: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """An array of arrays whose first row names the columns; named columns are returned as text."""
    parsed = df.select(*keep, F.from_json(text, "array<array<string>>").alias("__rows"))
    headed = parsed.select(
        *keep, F.get("__rows", F.lit(0)).alias("__head"), F.posexplode("__rows").alias("__at", "__row")
    ).filter(F.col("__at") > 0)
    position = lambda c: F.array_position("__head", F.lit(c)) - 1
    return headed.select(*keep, *[F.get("__row", position(c).cast("int")).alias(c) for c in columns])


def union_series(
    series: Mapping[str, tuple[DataFrame, Mapping[str, str]]], date: str = "date", value: str = "value"
) -> DataFrame:
    """Single-series tables to one long table with id, title, unit and frequency.

    Values are coerced and null ones dropped.
    """
    out: DataFrame | None = None
    for series_id, (frame, meta) in series.items():
        part = frame.select(
            F.lit(series_id).alias("series_id"),
            F.lit(meta["title"]).alias("series_title"),
            F.col(date).cast("date").alias("date"),
            to_number(value).alias("value"),
            F.lit(meta["unit"]).alias("unit"),
            F.lit(meta["frequency"]).alias("frequency"),
        ).filter(F.col("value").isNotNull())
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("at least one series is needed")
    return out
