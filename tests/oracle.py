"""Compare a registered Spark query with its DuckDB oracle SQL.

Rows are compared as multisets after normalising values (doubles rounded
to 6 places, timestamps as naive datetimes), columns sorted by name, the
way the round driver compares them.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def compare(spark, con, query, sf_dir: str):
    sdf = query.build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    res = con.execute(query.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    cs = Counter(tuple(_norm(r[i]) for i in order_s) for r in s_rows)
    cd = Counter(tuple(_norm(r[i]) for i in order_d) for r in d_rows)
    out["match"] = sorted(s_cols) == sorted(d_cols) and cs == cd
    if not out["match"]:
        out["only_spark"] = list((cs - cd).items())[:3]
        out["only_oracle"] = list((cd - cs).items())[:3]
    return out
