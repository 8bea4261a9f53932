"""Run a query in Spark and its twin in DuckDB and compare rows, names and types."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(dtype) -> str:
    return "float" if dtype.kind == "f" else dtype.kind


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "M":
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object and len(df) and not isinstance(df[c].iloc[0], str):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else the first difference found."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns: only spark {set(got) - set(want)}, only duckdb {set(want) - set(got)}"
    if len(got) != len(want):
        return f"rows: {len(got)} != {len(want)}"
    got, want = _canonical(got), _canonical(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if a.dtype.kind in "iuf" and b.dtype.kind in "iuf":
            x, y = a.to_numpy("float64"), b.to_numpy("float64")
            same = (x == y) | (np.isnan(x) & np.isnan(y))
        else:
            same = ((a == b) | (a.isna() & b.isna())).to_numpy()
        if not same.all():
            at = int(np.argmin(same))
            return f"{c}: {(~same).sum()} rows differ, first {a[at]!r} != {b[at]!r}"
    return None


def type_difference(spark_df, con, sql: str) -> str | None:
    names = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    got = {n: names.get(t, t) for n, t in spark_df.dtypes}
    bad = {n: (got[n], want.get(n)) for n in got if got[n] != want.get(n)}
    return f"types: {bad}" if bad else None
