"""Spark vs DuckDB comparison, mirroring the driver's gate: columns sorted by name,
row count, column names, and an order-insensitive multiset of normalised values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return float(f"{f:.9g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    return names, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows = duck(sql, sf_dir)
    sn, sc = canon(s_cols, s_rows)
    dn, dc = canon(d_cols, d_rows)
    diff_s = sc - dc
    diff_d = dc - sc
    return {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sn == dn, "spark_cols": sn, "oracle_cols": dn,
        "values_match": sn == dn and not diff_s and not diff_d,
        "only_spark": list(diff_s.items())[:3], "only_oracle": list(diff_d.items())[:3],
    }
