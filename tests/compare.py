"""Run a registered query and its DuckDB statement and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _rows(expected_columns, result.fetchall())
    if sorted(spark_df.columns) != sorted(expected_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, e.g.\n  {bad[0][0]}\n  {bad[0][1]}"
    return None
