"""Comparing a Spark result with DuckDB's, regardless of row and column order."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return ("number", repr(value + 0.0))
    if isinstance(value, bool):
        return ("bool", value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def same(spark_df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences, empty if there are none."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    types = {column[0]: str(column[1]) for column in expected.description}
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    found = []
    alike = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    for name, kind in spark_df.dtypes:
        if alike.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    want = _rows(names, expected.fetchall())
    have = _rows(spark_df.columns, spark_df.collect())
    if len(want) != len(have):
        found.append(f"{len(have)} rows against {len(want)}")
    elif want != have:
        different = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found
