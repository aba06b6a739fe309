"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)  # exact: rounding is up to the two sides
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duckdb_connection(sf_dir)
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d = digest(d_cols, res.fetchall())
    return {"name": name, "cols_match": s[0] == d[0], "rows": (s[1], d[1]), "hash_match": s[2] == d[2],
            "spark_cols": s[0], "oracle_cols": d[0]}
