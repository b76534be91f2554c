"""Compares a Spark result with its SQL result, order aside."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _value(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, Decimal):
        return str(v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df: DataFrame):
    return _rows(df.columns, df.collect())
