"""Compare a registered query with its oracle SQL on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shaped, key=repr)


def difference(frame, connection, oracle: str) -> str | None:
    """None if names and values agree, else a short description."""
    mine = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(oracle)
    names = [d[0] for d in cursor.description]
    theirs = _sorted(names, cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
