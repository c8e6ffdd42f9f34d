"""Compare a Spark result with a DuckDB result: names, types and values, in any row order."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    types = {
        row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()
    }
    expected = connection.execute(sql).fetchall()
    assert sorted(df.columns) == sorted(names)
    for name, kind in df.dtypes:
        want = KINDS.get(kind, kind.upper())
        assert types[name].replace(" ", "") == want.replace(" ", ""), (name, kind, types[name])
    got = _rows(df.columns, df.collect())
    want_rows = _rows(names, expected)
    assert len(got) == len(want_rows), (len(got), len(want_rows))
    for mine, theirs in zip(got, want_rows):
        assert mine == theirs, (mine, theirs)
    return len(got)
