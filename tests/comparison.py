"""Run registered queries beside their SQL and compare rows without regard to order."""

from __future__ import annotations

import time
from pathlib import Path

import duckdb

INPUTS = ["customer", "part", "orders", "lineitem"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in INPUTS:
        con.execute(f"create view {name} as select * from '{Path(folder) / name}.parquet'")
    return con


def _text(value) -> str:
    if isinstance(value, float) and value == int(value):
        return repr(float(value))
    return "" if value is None else str(value)


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, folder: str) -> tuple[int, int, float]:
    """(rows, differing rows, seconds of the Spark query)."""
    started = time.time()
    df = query(spark, folder)
    actual = _rows(df.columns, df.collect())
    seconds = time.time() - started
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = _rows(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns), (df.columns, columns)
    different = sum(a != b for a, b in zip(actual, expected, strict=False))
    return len(actual), different + abs(len(actual) - len(expected)), seconds
