"""Run a registered query in Spark and its oracle SQL in DuckDB; compare as bags of rows."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, int):
        return v
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, _dt.timedelta):
        return v.total_seconds()
    return str(v)


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems, len(s_rows), len(d_rows)
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sb = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    db = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if sb != db:
        only_s = list((sb - db).elements())[:3]
        only_d = list((db - sb).elements())[:3]
        problems.append(f"values differ; spark-only={only_s} duck-only={only_d}")
    return problems, len(s_rows), len(d_rows)
