"""Named queries: a Spark callable and, where possible, its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name!r} is registered twice")
    QUERIES[name] = query
    if oracle is not None:
        ORACLE[name] = oracle


def half_up(value: str, digits: int) -> str:
    """Oracle text for Spark's ``round`` of a DOUBLE: by its decimal text."""
    exact = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


def error_list(rules: dict[str, str]) -> str:
    """Oracle text: comma-separated names of the rules that do not hold."""
    cases = (f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, p in rules.items())
    return "concat_ws(',', " + ", ".join(cases) + ")"
