"""Queries of the text operators, and their oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    QUERIES[name] = query
    if oracle is not None:
        ORACLE[name] = oracle
