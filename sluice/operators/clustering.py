"""Rows laid out so that files hold narrow ranges of several columns at once.

Each column is parted into ranges of about equally many rows. The bits of a row's range numbers are
interleaved to one key (a Z-order curve), and files are consecutive stretches of that key. A value that
is more frequent than a range is spread over all the ranges that it fills, so it cannot make one file
large; equal rows are spread by their hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampType

#: Bits of a column's range number, so at most 2 ** BITS ranges.
BITS = 6
_PLACE, _SPREAD = "__place", "__spread"


def _number(name: str, kind: DataType) -> Column:
    """A number that orders rows like the column (texts by their first six bytes)."""
    value = F.col(f"`{name}`")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, StringType):
        start = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(start, 16, 10).cast("double")
    if isinstance(kind, NumericType):
        return value.cast("double")
    raise ValueError(f"{name}: rows cannot be laid out by {kind.simpleString()}")


def range_limits(frame: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """For each column the values that part its rows into 2 ** bits ranges."""
    shares = [n / 2**bits for n in range(1, 2**bits)]
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    limits = frame.agg(
        *(F.percentile_approx(_number(c, kinds[c]), shares).alias(f"c{n}") for n, c in enumerate(columns))
    ).first()
    return [found or [] for found in limits]


def place(
    frame: DataFrame, columns: Sequence[str], limits: Sequence[Sequence[float]], bits: int = BITS
) -> Column:
    """The key of a row: its range numbers with interleaved bits. NULLs are in the first range."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    key = F.lit(0).cast("bigint")
    for n, (name, found) in enumerate(zip(columns, limits)):
        value, known = _number(name, kinds[name]), F.array(*map(F.lit, found)).cast("array<double>")
        below = F.size(F.filter(known, lambda limit: limit < value))
        filled = F.size(F.filter(known, lambda limit: limit <= value)) - below
        number = below + F.pmod(F.col(_SPREAD), filled + 1).cast("int")
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + n))
    return key


def laid_out(frame: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The same rows in ``files`` partitions along the curve.

    The frame is read to find the ranges, to part the curve, and to write: it should be stored.
    """
    limits = range_limits(frame, columns, bits)
    spread = frame.withColumn(_SPREAD, F.xxhash64(*(F.col(f"`{c}`") for c in frame.columns)))
    keyed = spread.withColumn(_PLACE, place(frame, columns, limits, bits))
    return (
        keyed.repartitionByRange(files, _PLACE, _SPREAD)
        .sortWithinPartitions(_PLACE, *columns)
        .drop(_PLACE, _SPREAD)
    )
