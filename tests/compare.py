"""Compare a registered query with its SQL in DuckDB: rows, column names and values, in any order."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _value(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def rows_of(frame_rows, columns) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_value(row[i]) for i in order) for row in frame_rows]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return rows_of(df.collect(), df.columns)


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return rows_of(cursor.fetchall(), names)
