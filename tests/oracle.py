"""Comparison of a Spark result with DuckDB's result of the same query."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def compare(df, connection, sql: str) -> list[str]:
    """Differences, none when names, row count and values agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    order = sorted(names)
    expected = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    actual = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    found = []
    if sum(expected.values()) != sum(actual.values()):
        found.append(f"{sum(actual.values())} rows instead of {sum(expected.values())}")
    extra, missing = actual - expected, expected - actual
    if extra or missing:
        found.append(f"{order}: extra {list(extra)[:2]} missing {list(missing)[:2]}")
    return found
