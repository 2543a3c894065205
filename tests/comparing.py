"""Strict comparison of a query with its SQL statement in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "array<string>": "VARCHAR[]",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and all rows agree; else what differs."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    found_types = {n: SQL_TYPES.get(t, t) for n, t in result.dtypes}
    if expected_types != found_types:
        return [f"columns: {found_types} != {expected_types}"]
    names = sorted(found_types)
    listed = ", ".join(f'"{n}"' for n in names)
    expected = Counter(
        tuple(map(_cell, row))
        for row in connection.execute(f"SELECT {listed} FROM ({sql}) AS t").fetchall()
    )
    found = Counter(tuple(map(_cell, row)) for row in result.select(*names).collect())
    missing, surplus = expected - found, found - expected
    if not missing and not surplus:
        return []
    return [
        f"{sum(missing.values())} missing, {sum(surplus.values())} surplus of "
        f"{sum(expected.values())}",
        *[f"missing {dict(zip(names, r, strict=True))}" for r in list(missing)[:2]],
        *[f"surplus {dict(zip(names, r, strict=True))}" for r in list(surplus)[:2]],
    ]
