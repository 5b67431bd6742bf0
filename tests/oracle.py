"""Runs a query and its SQL over one data folder and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

DATA = os.environ.get("ROWLOOM_TESTDATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v: object) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v.replace(tzinfo=None)) if hasattr(v, "tzinfo") else repr(v)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


def compare(spark, con, query, sql: str, folder: str) -> str | None:
    df = query(spark, folder)
    con.execute(sql)
    columns = [d[0] for d in con.description]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} {sorted(columns)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(columns, con.fetchall())
    if mine != theirs:
        a, b = set(mine) - set(theirs), set(theirs) - set(mine)
        return f"{len(mine)} rows against {len(theirs)}; only Spark: {sorted(a)[:3]}; only SQL: {sorted(b)[:3]}"
    return None
