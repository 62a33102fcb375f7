"""Runs one registered query and its check text on the same tables and compares the rows."""

from __future__ import annotations

import math

import duckdb

from sparkdeck.plans.views import BASE


def database(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return value + 0.0  # -0.0 and 0.0 are one value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=sort_key)


def compare(df, db, sql):
    """Empty text when equal, else a short description."""
    rel = db.sql(sql)
    want_names, want = list(rel.columns), rel.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} vs {sorted(want_names)}"
    a, b = rows_of(df.columns, got), rows_of(want_names, want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}: {a[:2]} {b[:2]}"
    kinds = [
        (x, y)
        for x, y in zip(a, b)
        for p, q in zip(x, y)
        if p is not None and q is not None and type(p) is not type(q)
    ]
    if kinds:
        return f"types differ: {kinds[0]}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sum(p != q for p, q in zip(a, b))} of {len(a)} differ, first {x} vs {y}"
    return ""
