"""Compare a Spark result with the rows its SQL gives, ignoring row order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return v
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _kind(v):
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: [(x is None, str(type(x)), str(x)) for x in r]
    )


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    res = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in res.description], res.fetchall())
    have_cols, have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != have_cols:
        return f"columns {have_cols} != {want_cols}"
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}: {have[:2]} / {want[:2]}"
    if not want:
        return "both empty"
    for h, w in zip(have, want):
        if h != w:
            return f"{have_cols}: {h} != {w}"
        if [_kind(x) for x in h] != [_kind(x) for x in w]:
            return f"types {have_cols}: {h} / {w}"
    return None
