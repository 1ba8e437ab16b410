"""Payloads of unknown quality as VARIANT: elements and a status of every document in one pass.

A flattener with a fixed schema gives a broken payload no rows and an unread field a null. Here each
document has one ``document`` row that says what became of it, beside an ``element`` row for every
member of its list or object. A document is parsed once. Its members are exploded one by one, so
neither it nor its status waits for a second scan or a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gates import Gate

DOCUMENT, ELEMENT = "document", "element"
PARSED, EMPTY, ABSENT, BROKEN, UNEXPECTED = "parsed", "empty", "absent", "broken", "unexpected"


def payload_rows(df: DataFrame, text: str, path: str = "$", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``row``, ``status``, ``pos``, ``key``, ``element`` of what lies at ``path``.

    ``status`` of a document is ``absent`` (null text), ``broken`` (no JSON, or an object that names a
    key twice), ``unexpected`` (neither a list nor an object at ``path``), ``empty`` (a list or object
    without members) or ``parsed``. Its ``pos``, ``key`` and ``element`` are null. Element rows carry
    the place, in an object also the key, and the member as VARIANT; their ``status`` is ``parsed``.
    ``keep`` must not name a result column.
    """
    taken = {"row", "status", "pos", "key", "element"} & {c.lower() for c in keep}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are results of payload_rows")
    parsed = df.select(*keep, F.col(text).isNull().alias("__none"), F.try_parse_json(F.col(text)).alias("__doc"))
    heads = parsed.select(*keep, "__none", F.col("__doc").isNull().alias("__bad"), F.try_variant_get("__doc", path, "variant").alias("__list"))
    members = heads.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("__list").outer()))
    # Only a document without members is looked at again to tell an empty list from a scalar.
    hollow = F.to_json("__list").isin("[]", "{}")
    status = (
        F.when(F.col("__none"), ABSENT)
        .when(F.col("__bad"), BROKEN)
        .when(F.col("__list").isNull(), UNEXPECTED)
        .when(F.col("pos").isNotNull(), PARSED)
        .when(hollow, EMPTY)
        .otherwise(UNEXPECTED)
    )
    none = lambda kind: F.lit(None).cast(kind)
    document = F.struct(F.lit(DOCUMENT).alias("row"), none("int").alias("pos"), none("string").alias("key"), none("variant").alias("element"))
    element = F.struct(F.lit(ELEMENT).alias("row"), F.col("pos"), F.col("key"), F.col("value").alias("element"))
    # The first member brings the row of its document along.
    both = F.array_compact(F.array(F.when(F.coalesce("pos", F.lit(0)) == 0, document), F.when(F.col("pos").isNotNull(), element)))
    rows = members.select(*keep, status.alias("status"), F.explode(both).alias("__r"))
    return rows.select(*keep, "__r.row", "status", "__r.pos", "__r.key", "__r.element")


def read_fields(
    rows: DataFrame,
    fields: Mapping[str, str],
    codes: Mapping[str, Sequence[str]] | None = None,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """``payload_rows`` with typed columns in place of ``element`` and a list of ``faults``.

    ``fields`` maps names to Spark types; ``paths`` gives the path of a field inside its element if that is
    not its name. A value of another type is null and the fault ``<field>: unreadable``; a missing or null one
    is null and no fault. ``codes`` lists the known codes of a field: another one stays as it is, is never
    taken for the first of the list, and is the fault ``<field>: unknown code``.
    """
    place = {f: (paths or {}).get(f, f"$['{f}']") for f in fields}
    value: dict[str, Column] = {f: F.try_variant_get("element", place[f], kind) for f, kind in fields.items()}
    present = {f: F.try_variant_get("element", place[f], "variant") for f in fields}
    unread = [
        F.when(present[f].isNotNull() & ~F.is_variant_null(present[f]) & F.col(f).isNull(), F.lit(f"{f}: unreadable")) for f in fields
    ]
    unknown = [F.when(~F.col(f).cast("string").isin(list(known)), F.lit(f"{f}: unknown code")) for f, known in (codes or {}).items()]
    others = [c for c in rows.columns if c != "element"]
    clash = {c.lower() for c in others} & {"faults", *(f.lower() for f in fields)}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    typed = rows.select(*others, "element", *[v.alias(f) for f, v in value.items()])
    return typed.select(*others, *fields, F.array_compact(F.array(*unread, *unknown)).alias("faults"))


def payload_gates(codes: Sequence[str] = ()) -> list[Gate]:
    """Gates over ``read_fields``: every payload came, is JSON and holds a list; every value reads; and for each
    field in ``codes`` every code is a known one."""
    document = F.col("row") == DOCUMENT
    of = lambda status: F.count_if(document & (F.col("status") == status))
    unread = F.coalesce(F.sum(F.size(F.filter("faults", lambda f: f.endswith(": unreadable")))), F.lit(0))
    return [
        *[Gate(f"payload_{status}", of(status), "equal", 0) for status in (ABSENT, BROKEN, UNEXPECTED, EMPTY)],
        Gate("values_read", unread, "equal", 0),
        *[Gate(f"known_codes_{c}", F.count_if(F.array_contains("faults", f"{c}: unknown code")), "equal", 0) for c in codes],
    ]
