"""Casts from untrusted text: a value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_as(column: str, data_type: str) -> Column:
    """Text to DATE, TIMESTAMP, DECIMAL(p,s) and so on."""
    return F.col(column).try_cast(data_type)


def whole_number(column: str, data_type: str = "bigint") -> Column:
    """Integral text, also when written with a decimal suffix such as ``17.0``.

    The fraction is cut off (``17.9`` gives 17); values outside the range of
    ``data_type`` give NULL.
    """
    return F.col(column).try_cast("double").try_cast(data_type)


def upper_code(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def trimmed(column: str) -> Column:
    return F.trim(F.col(column))
