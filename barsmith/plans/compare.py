"""Side-by-side check of a registered Spark query against its DuckDB twin."""

from __future__ import annotations

import datetime as _dt
import math
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if out["columns_match"]:
        order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        s_idx = [s_cols.index(d_cols[i]) for i in order]
        s_set = Counter(tuple(r[i] for i in s_idx) for r in s_rows)
        d_set = Counter(tuple(r[i] for i in order) for r in d_rows)
        out["values_match"] = s_set == d_set
        if not out["values_match"]:
            out["only_spark"] = list((s_set - d_set).elements())[:3]
            out["only_oracle"] = list((d_set - s_set).elements())[:3]
    else:
        out["values_match"] = False
        out["spark_columns"] = s_cols
        out["oracle_columns"] = d_cols
    out["ok"] = out["columns_match"] and out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
