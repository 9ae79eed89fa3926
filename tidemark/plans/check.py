"""Compare a Spark result with DuckDB oracle SQL on the same parquet tables.

Order-insensitive: both sides are normalised (columns sorted by name, floats
rounded to 9 significant digits, timestamps as ISO text) and compared as
multisets of rows.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections import Counter

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    import os

    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return float(f"{float(v):.9g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_norm, s_cols = rows_of(spark_df.columns, s_rows)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_norm, d_cols_sorted = rows_of(d_cols, cur.fetchall())
    a, b = Counter(s_norm), Counter(d_norm)
    return {
        "spark_rows": len(s_norm), "oracle_rows": len(d_norm),
        "columns_match": s_cols == d_cols_sorted,
        "spark_cols": s_cols, "oracle_cols": d_cols_sorted,
        "values_match": a == b,
        "only_spark": list((a - b).elements())[:3],
        "only_oracle": list((b - a).elements())[:3],
    }
