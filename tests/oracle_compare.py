"""Spark result vs DuckDB oracle: row count, column names and values, floats exactly.

Queries round the few columns whose last bits depend on the engine (window averages and
deviations) themselves, in both forms.
"""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

from adcredit.sources.driver import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0     # exact; -0.0 is 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _key(row):
    return tuple((x is None, "" if x is None else repr(x)) for x in row)


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    df = query(spark, sf_dir)
    cols = df.columns
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    want_rows = res.fetchall()
    problems = []
    if sorted(cols) != sorted(ocols):
        return [f"{name}: columns {sorted(cols)} != {sorted(ocols)}"]
    idx = [ocols.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in idx) for r in want_rows]
    if len(got) != len(want):
        problems.append(f"{name}: rows {len(got)} != {len(want)}")
    g, w = sorted(got, key=_key), sorted(want, key=_key)
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    if bad:
        problems.append(f"{name}: {len(bad)} differing rows, e.g. {bad[0][0]} vs {bad[0][1]}")
    return problems
