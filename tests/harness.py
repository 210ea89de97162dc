"""Run registered queries beside their SQL and compare every value."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    df = df.sort_values(by=list(df.columns), key=lambda s: s.astype(str)).reset_index(drop=True)
    return df


def compare(name: str, spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    a, b = canonical(spark_df), canonical(sql_df)
    if list(a.columns) != list(b.columns):
        return f"{name}: columns {list(a.columns)} vs {list(b.columns)}"
    if len(a) != len(b):
        return f"{name}: {len(a)} rows vs {len(b)}"
    for c in a.columns:
        x, y = a[c], b[c]
        if x.dtype != y.dtype and not (x.isna().all() and y.isna().all()):
            return f"{name}.{c}: type {x.dtype} vs {y.dtype}"
        if x.dtype.kind == "f":
            bad = ~((x == y) | (x.isna() & y.isna()))
        else:
            bad = x.astype(str).where(x.notna(), "~") != y.astype(str).where(y.notna(), "~")
        if bad.any():
            i = bad.idxmax()
            return f"{name}.{c}: {int(bad.sum())} of {len(a)} differ, first {a.loc[i].to_dict()} vs {b.loc[i].to_dict()}"
    return None


def check(spark, con, name, fn, sql, folder) -> tuple[str | None, int, float]:
    start = time.time()
    mine = fn(spark, folder).toPandas()
    took = time.time() - start
    if sql is None:
        return None, len(mine), took
    return compare(name, mine, con.execute(sql).df()), len(mine), took
