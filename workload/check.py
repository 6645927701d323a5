"""Compare a Spark result with a DuckDB result: names, types and the multiset of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}
ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in ALL_TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    found = []
    described = connection.execute(f"describe {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in result.schema.fields}
    if types != expected_types:
        found.append(
            f"columns: {sorted(set(types.items()) - set(expected_types.items()))} "
            f"instead of {sorted(set(expected_types.items()) - set(types.items()))}"
        )
        if set(types) != set(expected_types):
            return found
    names = sorted(types)
    rows = Counter(tuple(_value(row[n]) for n in names) for row in result.collect())
    positions = [[row[0] for row in described].index(n) for n in names]
    expected = Counter(
        tuple(_value(row[p]) for p in positions) for row in connection.execute(sql).fetchall()
    )
    if rows != expected:
        extra, missing = rows - expected, expected - rows
        found.append(
            f"rows: {sum(rows.values())} against {sum(expected.values())}; "
            f"{sum(extra.values())} extra, {sum(missing.values())} missing; {names}; "
            f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
        )
    return found
