"""Run a registered query and its SQL side by side and compare the values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(glob.glob(os.path.join(sf, "*.parquet"))):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 1e15:
            return float(int(v))
        return v
    if isinstance(v, int):
        return float(v) if abs(v) < 1e15 else v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def table_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def check(spark, con, sf, name, fn, sql) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got_cols, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = table_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; spark {got[:2]} sql {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; first {bad[0]}"
    return None
