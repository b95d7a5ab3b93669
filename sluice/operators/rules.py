"""Row and key rules. A rule holds, or its name is reported for the row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Either a row predicate (``holds``) or a key that must be unique."""

    name: str
    holds: Column | None = None
    unique_on: tuple[str, ...] = ()
    message: str = ""

    @property
    def failed(self) -> Column:
        """TRUE where the predicate is false or unknown."""
        if self.holds is None:
            raise ValueError(f"{self.name} is a key rule and has no row predicate")
        return ~F.coalesce(self.holds, F.lit(False))


def _value(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def not_null(name: str, column: str) -> Rule:
    return Rule(name, _value(column).isNotNull(), message=f"{column} is missing")


def sql_rule(name: str, expression: str, message: str = "") -> Rule:
    """Any boolean SQL expression over one row."""
    return Rule(name, F.expr(expression), message=message or expression)


def unique_key(name: str, *columns: str) -> Rule:
    """All copies of a repeated key fail; NULL keys count as one key."""
    label = ", ".join(columns)
    return Rule(f"{name}_unique", unique_on=columns, message=f"{label} is repeated")


def column_rule(name: str, holds: Column, message: str = "") -> Rule:
    return Rule(name, holds, message=message)


def in_range(
    name: str, column: str, low, high=None, *, optional: bool = False
) -> Rule:
    """``low <= column`` and, if given, ``column <= high``."""
    value = _value(column)
    holds = value >= low if high is None else value.between(low, high)
    return Rule(name, _or_missing(value, holds, optional), message=f"{column} out of range")


def one_of(name: str, column: str, allowed: Sequence, *, optional: bool = False) -> Rule:
    value = _value(column)
    holds = _or_missing(value, value.isin(*allowed), optional)
    return Rule(name, holds, message=f"{column} not allowed")


def matches(name: str, column: str, pattern: str) -> Rule:
    return Rule(name, _value(column).rlike(pattern), message=f"{column} has a wrong format")


def not_after(name: str, column: str, limit: Column) -> Rule:
    return Rule(name, _value(column) <= limit, message=f"{column} lies in the future")


def _or_missing(value: Column, holds: Column, optional: bool) -> Column:
    return value.isNull() | holds if optional else holds


def row_rules(rules: Iterable[Rule]) -> list[Rule]:
    return [rule for rule in rules if not rule.unique_on]


def key_rules(rules: Iterable[Rule]) -> list[Rule]:
    return [rule for rule in rules if rule.unique_on]


def any_failed(conditions: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions, F.lit(False))


def row_failed(rules: Iterable[Rule]) -> Column:
    """TRUE where at least one row rule fails; stays inside generated code."""
    return any_failed(rule.failed for rule in row_rules(rules))


def failed_names(failures: Sequence[tuple[str, Column]]) -> Column:
    """Names of the failed rules in rule order, an empty array where all hold."""
    if not failures:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(failed, F.lit(name)) for name, failed in failures)))
