"""Time helpers. Every clock-dependent operator takes ``as_of`` for repeatability."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: datetime | Column | None = None) -> Column:
    """``as_of`` as a TIMESTAMP, by default the statement's current timestamp."""
    if as_of is None:
        return F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def today(as_of: datetime | Column | None = None) -> Column:
    return F.current_date() if as_of is None else instant(as_of).cast("date")


def days_before(as_of: datetime | Column | None, days: int) -> Column:
    return instant(as_of) - F.make_dt_interval(days=F.lit(days))


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Complete units between two instants (59 s is 0 MINUTE)."""
    return F.timestamp_diff(unit, start, end)


def iso_date(value: str | date) -> date:
    """A strict ``YYYY-MM-DD`` business date; there is no fallback to the clock."""
    if isinstance(value, date):
        return value
    if len(value) != 10:
        raise ValueError(f"expected YYYY-MM-DD, got {value!r}")
    return date.fromisoformat(value)
