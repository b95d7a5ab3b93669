"""One-way presentation masks for direct identifiers.

``concat`` is NULL as soon as one part is NULL, so a missing identifier stays
missing without any CASE. Masking a masked value changes nothing, except for
names and e-mails that consist of blanks only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How each kind of masked identifier looks.
HIDDEN = "***"
HIDDEN_CPF = "***.***.***-"
HIDDEN_PHONE = "***-"


def _last_digits(value: Column, count: int) -> Column:
    return F.right(F.regexp_replace(value, r"\D", ""), F.lit(count))


def mask_name(value: Column) -> Column:
    return F.concat(F.left(F.trim(value), F.lit(1)), F.lit(HIDDEN))


def mask_cpf(value: Column) -> Column:
    return F.concat(F.lit(HIDDEN_CPF), _last_digits(value, 2))


def mask_email(value: Column) -> Column:
    address = F.lower(F.trim(value))
    domain = F.regexp_extract(address, "@(.+)$", 1)
    return F.concat(F.left(address, F.lit(1)), F.lit(HIDDEN + "@"), domain)


def mask_phone(value: Column) -> Column:
    return F.concat(F.lit(HIDDEN_PHONE), _last_digits(value, 4))


MASKS: dict[str, Callable[[Column], Column]] = {
    "full_name": mask_name,
    "cpf": mask_cpf,
    "email": mask_email,
    "phone": mask_phone,
}


def masked(column: str) -> Column:
    return MASKS[column](F.col(column)).alias(column)


def mask_columns(frame: DataFrame) -> DataFrame:
    """Mask every identifier column the frame has; other columns pass through."""
    present = {name: MASKS[name](F.col(name)) for name in MASKS if name in frame.columns}
    return frame.withColumns(present) if present else frame
