"""Runs a registered query and its SQL in DuckDB and compares the rows, order aside."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from tidewater.registry import ORACLES, PLANS
from tidewater.sources.tables import SCHEMAS, Tables


def connect(folder):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(type_name: str) -> str:
    """A type name both engines share."""
    lowered = type_name.lower()
    same = {
        "integer": "int", "bigint": "bigint", "varchar": "string", "double": "double", "timestamp": "timestamp_ntz",
        "boolean": "boolean", "date": "date", "float": "float",
    }
    return same.get(lowered, lowered)


def compare(spark, con, folder, name):
    """None when equal, else a text that says how they differ."""
    df = PLANS[name](Tables(spark, folder))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLES[name])
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    want = rows_of(rel.columns, rel.fetchall())
    mine = dict(df.dtypes)
    theirs = {c: kind(str(d)) for c, d in zip(rel.columns, rel.types)}
    types = {c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]}
    note = f" types {types}" if types else ""
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}{note}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {str(g)[:300]} / {str(w)[:300]}{note}"
    return note.strip() or None
