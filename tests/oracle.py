"""Runs queries and their SQL side by side on the shared tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

DATA = "/root/testdata"


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            path = f"{sf_dir}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else "")
            con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} and {sorted(columns)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(columns, cur.fetchall())
    if a != b:
        only = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"{name}: {len(a)} and {len(b)} rows; {only}"
    return ""
