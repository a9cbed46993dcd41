"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), repr(x)) for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_raw = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))}, " \
                      f"oracle-only {sorted(set(d_cols) - set(s_cols))}"
    order = [d_cols.index(c) for c in sorted(d_cols)]
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        diffs = [(c, x[i], y[i]) for i, c in enumerate(sorted(s_cols)) if x[i] != y[i]]
        return False, f"{len(bad)} rows differ; first: {diffs[:6]}"
    return True, f"{len(s_rows)} rows"
