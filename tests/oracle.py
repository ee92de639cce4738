"""Comparing a query with the SQL it is checked against."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(canon, v))
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, folder: str, query, sql: str) -> None:
    df = query(spark, folder)
    columns = sorted(df.columns)
    found = Counter(map(canon, map(tuple, df.select(*(df[c] for c in columns)).collect())))
    result = connect(folder).sql(sql)
    assert sorted(result.columns) == columns
    expected = Counter(map(canon, result.project(", ".join(f'"{c}"' for c in columns)).fetchall()))
    assert found == expected, (list((found - expected).items())[:3], list((expected - found).items())[:3])
