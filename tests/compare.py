"""Holds Spark results against DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def cell(x) -> str:
        if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return "NULL"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        return f"{float(x):.9g}" if isinstance(x, int | float) or hasattr(x, "dtype") and getattr(x, "ndim", 1) == 0 else str(x)

    columns = sorted(frame.columns)
    return sorted(tuple(cell(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False))


def same(spark_frame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    a, b = spark_frame.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    for frame in (a, b):  # integer columns with nulls come as floats from one side
        for c in frame.columns:
            if frame[c].dtype.kind == "b":
                frame[c] = frame[c].map(bool)
    left, right = rows(a), rows(b)
    assert len(left) == len(right)
    assert left == right
