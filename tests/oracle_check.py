"""Side-by-side check of a Spark result against DuckDB SQL on the same parquet."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_CONS: dict[str, duckdb.DuckDBPyConnection] = {}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    if sf_dir not in _CONS:
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        _CONS[sf_dir] = con
    return _CONS[sf_dir]


import os

STRICT = bool(os.environ.get("ORACLE_STRICT"))   # exact values, no tolerance


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v) or STRICT:
            return v + 0.0
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            a, b = float(a), float(b)
        except (TypeError, ValueError):
            return False
        if math.isinf(a) or math.isinf(b) or STRICT:
            return a == b
        return abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark_df, sql: str, sf_dir: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = duck(sf_dir).execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_n = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
    d_n = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=_key)
    for a, b in zip(s_n, d_n):
        if len(a) != len(b) or not all(_close(x, y) for x, y in zip(a, b)):
            cols = [s_cols[i] for i in order]
            return False, f"value differs:\n cols={cols}\n spark={a}\n duck ={b}"
    return True, f"{len(s_rows)} rows"
