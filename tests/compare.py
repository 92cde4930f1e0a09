"""Spark result against DuckDB result: same columns, same rows, same values."""

from __future__ import annotations

import glob
import math
from pathlib import Path

import duckdb


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
