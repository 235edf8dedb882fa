"""Spark results against DuckDB results, as sorted rows of texts."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def _cell(v) -> str:
    if pd.isna(v):
        return "None"
    return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)


def rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted(tuple(map(_cell, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


def duck(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con.sql(sql).df()


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
