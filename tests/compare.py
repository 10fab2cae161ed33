"""Runs a catalog query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            path = path / "*.parquet" if path.is_dir() else path
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def rows_by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def differences(df, sql: str, connection) -> list[str]:
    """Empty when both sides have the same columns and, exactly, the same rows."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    actual, expected = rows_by_name(df.columns, df.collect()), rows_by_name(names, expected_rows)
    if len(actual) != len(expected):
        return [f"{len(actual)} rows <> {len(expected)} rows"]
    return [f"{a} <> {b}" for a, b in zip(actual, expected) if a != b][:3]
