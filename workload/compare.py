"""Runs a query and its SQL and tells how they differ."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value) if not isinstance(value, datetime.date) else value.isoformat()


def _rows(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """None if columns and rows are equal, else a short account."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(result.columns):
        return f"columns: {sorted(set(names) ^ set(result.columns))}"
    wanted = _rows(answer.fetchall(), names)
    found = _rows([tuple(r) for r in result.collect()], result.columns)
    if len(wanted) != len(found):
        return f"rows: {len(found)} instead of {len(wanted)}"
    unequal = [(f, w) for f, w in zip(found, wanted) if f != w]
    if not unequal:
        return None
    columns = sorted(names)
    cells = [
        (c, f, w) for row in unequal for c, f, w in zip(columns, *row) if f != w
    ]
    return f"{len(unequal)} of {len(wanted)} rows differ, first cells {cells[:6]}"
