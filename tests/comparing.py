"""Comparing a query with its SQL counterpart, value by value."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in GIVEN:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def differences(spark_frame, connection, sql: str) -> list[str]:
    """What differs: columns, number of rows, rows. Empty when both agree."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_frame.columns):
        return [f"columns: {sorted(set(names) ^ set(spark_frame.columns))}"]
    order = sorted(names)
    expected = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in cursor.fetchall())
    held = Counter(tuple(_plain(row[c]) for c in order) for row in spark_frame.select(*order).collect())
    problems = []
    if sum(held.values()) != sum(expected.values()):
        problems.append(f"rows: {sum(held.values())} instead of {sum(expected.values())}")
    extra, missing = held - expected, expected - held
    if extra or missing:
        problems.append(f"{sum(extra.values())} rows differ")
        by = lambda r: tuple(str(v) for v in r)
        for left, right in list(zip(sorted(extra, key=by), sorted(missing, key=by)))[:3]:
            problems.append(str([(c, a, b) for c, a, b in zip(order, left, right) if a != b][:6]))
        if not missing or not extra:
            problems.append(str(dict(zip(order, list(extra or missing)[0]))))
    return problems
