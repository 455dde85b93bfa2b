"""Spark-vs-DuckDB comparison, modelled on the driver's check: row count,
column names (sorted) and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("TRADECAST_STRICT_HASH") == "1"  # exact float repr, no rounding


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if STRICT else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if STRICT else repr(round(float(v), 9))
    if isinstance(v, _dt.datetime):
        return v.date().isoformat() if v.time() == _dt.time(0) else v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2 ** 53 else str(v)
    return str(v)


def rows_hash(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, fn, sql: str, con=None, show_diff: int = 5) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols)}
    out["hash_match"] = out["cols_match"] and rows_hash(s_cols, s_rows) == rows_hash(o_cols, o_rows)
    if not out["hash_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        if out["cols_match"]:
            order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
            order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
            a = {"|".join(str(_norm(r[i])) for i in order_s) for r in s_rows}
            b = {"|".join(str(_norm(r[i])) for i in order_o) for r in o_rows}
            out["only_spark"] = sorted(a - b)[:show_diff]
            out["only_oracle"] = sorted(b - a)[:show_diff]
    return out
