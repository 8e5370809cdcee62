"""Compare a Spark DataFrame with DuckDB running the matching SQL on the same parquet tables."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(v)
    if isinstance(v, (int,)) or type(v).__name__.startswith(("int", "uint")):
        return str(int(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(rows), cols, h


def first_differences(a: pd.DataFrame, b: pd.DataFrame, n: int = 5) -> list:
    cols = sorted(a.columns)
    ra = sorted("|".join(_norm(r[c]) for c in cols) for r in a[cols].to_dict("records"))
    rb = sorted("|".join(_norm(r[c]) for c in cols) for r in b[cols].to_dict("records"))
    sa, sb = set(ra), set(rb)
    return [("spark_only", x) for x in ra if x not in sb][:n] + [("sql_only", x) for x in rb if x not in sa][:n]


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    sp = spark_df.toPandas()
    con = duck(sf_dir)
    dd = con.execute(sql).df()
    ns, cs, hs = table_digest(sp)
    nd, cd, hd = table_digest(dd)
    out = {"rows_spark": ns, "rows_sql": nd, "cols_match": cs == cd, "hash_match": hs == hd}
    if cs != cd:
        out["cols_spark"], out["cols_sql"] = cs, cd
    elif hs != hd:
        out["diff"] = first_differences(sp, dd)
    out["ok"] = ns == nd and cs == cd and hs == hd
    return out
