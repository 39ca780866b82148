"""Compare a registered query with its SQL on DuckDB: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

from loomstat.plans.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET threads = 8")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def run_query(spark, function, sf_dir):
    started = time.time()
    frame = function(spark, sf_dir)
    rows = [tuple(row) for row in frame.collect()]
    return frame, normalise(frame.columns, rows), time.time() - started


def run_sql(connection, sql):
    started = time.time()
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return types, normalise(columns, cursor.fetchall()), time.time() - started
