"""Run registered queries beside their SQL and compare rows as multisets."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    """One spelling for missing values and for whole numbers that pandas made floats."""
    if pd.isna(value):
        return None
    value = getattr(value, "item", lambda: value)()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def _rows(frame):
    columns = sorted(frame.columns)
    values = frame[columns].itertuples(index=False, name=None)
    rows = [tuple(_plain(v) for v in row) for row in values]
    return columns, sorted(rows, key=repr)


def differences(spark_df, sql: str, con) -> str | None:
    """None when equal, or else the first difference."""
    got_columns, got = _rows(spark_df.toPandas())
    want_columns, want = _rows(con.execute(sql).df())
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(got_columns, a))} instead of {dict(zip(want_columns, b))}"
    return None
