"""Compare a query's result with its SQL counterpart, regardless of row order."""

from __future__ import annotations

from pathlib import Path

import duckdb

# Spark type -> DuckDB type.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str) -> int:
    expected = connect(sf_dir).sql(sql)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    got = _sorted(df.columns, df.collect())
    want = _sorted(expected.columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want
    return len(got)
