"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

from gatelake.plans.corpora import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    secs = time.time() - start
    out = {"name": name, "rows": len(got), "sec": round(secs, 2)}
    if sql is None:
        return out | {"ok": None}
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return out | {"ok": False, "why": f"columns {sorted(df.columns)} vs {sorted(cols)}"}
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        return out | {"ok": False, "why": f"only spark {list((a - b).items())[:2]} only oracle {list((b - a).items())[:2]} n={len(got)}/{len(want)}"}
    kinds = {c: (type(g), type(w)) for c, g, w in zip(sorted(cols), _first(df.columns, got), _first(cols, want))}
    return out | {"ok": True, "kinds": {c: k for c, k in kinds.items() if k[0] is not k[1] and type(None) not in k}}


def _first(cols, rows):
    if not rows:
        return []
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [rows[0][i] for i in order]
