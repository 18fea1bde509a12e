"""Compare a Spark result with the result of its SQL."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return Decimal(value).normalize() if isinstance(value, Decimal) else value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(result: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """None if equal, else the first difference."""
    expected = connection.execute(sql)
    expected_columns = [d[0] for d in expected.description]
    if sorted(result.columns) != sorted(expected_columns):
        return f"columns {sorted(result.columns)} != {sorted(expected_columns)}"
    wanted = _sorted_rows(expected_columns, expected.fetchall())
    got = _sorted_rows(result.columns, result.collect())
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for mine, theirs in zip(got, wanted, strict=True):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return None
