"""Spark result against DuckDB result, rows in any order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def of_spark(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def of_duckdb(connection, sql: str):
    result = connection.execute(sql)
    return normal([column[0] for column in result.description], result.fetchall())
