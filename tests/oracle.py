"""Compare a Spark result with the rows of the oracle SQL, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def spark_rows(df) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted((_plain(row) for row in df.select(*columns).collect()), key=repr)


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [_plain(tuple(row[i] for i in order)) for row in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"describe {sql}").fetchall()}


def _plain(row) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)
