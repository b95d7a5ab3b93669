"""Typed sanitising of snapshots and repair of their references."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.clock import instant
from sluice.model import ENTITIES
from sluice.operators.dedup import keep_latest
from sluice.operators.once import with_columns_once
from sluice.plans.rulebook import (
    CAPACITY,
    FLAGS,
    GENDERS,
    SEVERITY,
    STATE_CODE,
    WAIT_MINUTES,
)


def with_contract(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns`` in this order: missing ones NULL, extra ones dropped."""
    have = set(frame.columns)
    return frame.select(
        *(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns)
    )


def number(column: str) -> Column:
    return F.col(column).try_cast("double")


def null_unless(value: Column, valid: Column) -> Column:
    """The value where ``valid`` holds, else NULL."""
    return F.when(valid, value)


def null_out_of_range(column: str, low: float, high: float | None = None) -> Column:
    value = number(column)
    return null_unless(value, value >= low if high is None else value.between(low, high))


def _keys(parents: DataFrame, parent_key: str) -> DataFrame:
    """Each parent key once: copies are reduced before the join's own shuffle."""
    return parents.select(F.col(parent_key).alias("__parent")).distinct()


def existing(frame: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference exists among the parents (NULL references do not)."""
    keys = _keys(parents, parent_key)
    return frame.join(keys, on=F.col(column) == F.col("__parent"), how="left_semi")


def orphans(frame: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference is NULL or missing among the parents."""
    keys = _keys(parents, parent_key)
    return frame.join(keys, on=F.col(column) == F.col("__parent"), how="left_anti")


def orphan_counts(
    frame: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Orphan rows and distinct orphan values per reference column.

    Child rows are first counted per referenced value, so the join with the
    parents sees each value once, however many rows share it.
    """
    reports = []
    for column, (parents, parent_key) in references.items():
        used = frame.groupBy(F.col(column).alias("__value")).agg(
            F.count(F.lit(1)).alias("__rows")
        )
        missing = orphans(used, "__value", parents, parent_key)
        reports.append(
            missing.agg(
                F.coalesce(F.sum("__rows"), F.lit(0)).alias("orphan_rows"),
                F.count("__value").alias("orphan_values"),
            ).select(F.lit(column).alias("reference"), "orphan_rows", "orphan_values")
        )
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def align_to_parent(
    frame: DataFrame, link: str, column: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Replace ``column`` by the value its linked parent carries.

    Rows without a parent get NULL. Parents are expected once per key; should a
    key be repeated, its greatest value is taken, so rows never multiply.
    """
    mapping = parents.groupBy(F.col(parent_key).alias("__link")).agg(
        F.max(column).alias("__aligned")
    )
    joined = frame.join(mapping, on=F.col(link) == F.col("__link"), how="left")
    return joined.withColumn(column, F.col("__aligned")).drop("__link", "__aligned")


def truncated(column: str) -> Column:
    """Numeric text as BIGINT without its fraction."""
    return number(column).try_cast("bigint")


def reference(column: str) -> Column:
    """A reference as BIGINT; a fractional number refers to nothing."""
    value = number(column)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def valid_number(column: str, low: float, high: float | None = None) -> Column:
    """The truncated number if it lies in range before truncation, else NULL."""
    value = number(column)
    inside = value >= low if high is None else value.between(low, high)
    return null_unless(truncated(column), inside)


def positive(column: str) -> Column:
    return null_unless(truncated(column), number(column) > 0)


def keep_last(frame: DataFrame, key: str, position: Sequence[str]) -> DataFrame:
    """The last row per key in ``position`` order; other columns settle ties."""
    others = [c for c in frame.columns if c != key and c not in position]
    order = [F.col(c).desc_nulls_last() for c in position]
    return keep_latest(frame, [key], order, tie_break=others)


def _code(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def _valid_values(entity: str, now: Column) -> dict[str, Column]:
    """Typed columns of an entity; a value that must not occur becomes NULL."""

    def past(column: str) -> Column:
        moment = F.col(column).try_cast("timestamp")
        return null_unless(moment, moment <= now)

    def state() -> Column:
        return null_unless(_code("state"), _code("state").rlike(STATE_CODE))

    match entity:
        case "patients":
            return {
                "gender": null_unless(_code("gender"), _code("gender").isin(*GENDERS)),
                "state": state(),
                "birth_date": past("birth_date").cast("date"),
            }
        case "hospitals":
            return {"state": state(), "capacity": valid_number("capacity", *CAPACITY)}
        case "doctors":
            return {"hospital_id": reference("hospital_id"), "crm": positive("crm")}
        case "diseases":
            return {"severity_level": valid_number("severity_level", *SEVERITY)}
        case "attendance":
            flag = number("discharge_flag")
            owners = ("patient_id", "doctor_id", "hospital_id", "disease_id")
            return {
                **{column: reference(column) for column in owners},
                "attendance_date": past("attendance_date"),
                "severity_score": valid_number("severity_score", *SEVERITY),
                "wait_time_minutes": null_out_of_range("wait_time_minutes", *WAIT_MINUTES),
                "cost": null_out_of_range("cost", 0),
                "discharge_flag": null_unless(flag, flag.isin(*FLAGS)),
            }
    raise ValueError(f"unknown entity {entity!r}")


# Columns without which a row is dropped, besides the key.
_NEEDED = {
    "patients": ("gender", "state", "birth_date"),
    "hospitals": ("state", "capacity"),
    "doctors": ("hospital_id", "crm"),
    "diseases": ("severity_level",),
    "attendance": ("patient_id", "doctor_id", "disease_id", "attendance_date", "severity_score"),
}


def sanitize_rows(
    frame: DataFrame, entity: str, as_of: datetime | Column | None = None
) -> DataFrame:
    """Rows of one entity with a valid key and valid values, before dedup."""
    key = ENTITIES[entity].key
    typed = {key: positive(key), **_valid_values(entity, instant(as_of))}
    return with_columns_once(frame, typed).na.drop(subset=[key, *_NEEDED[entity]])


def sanitize_entity(
    frame: DataFrame,
    entity: str,
    position: Sequence[str],
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Valid rows of one entity, the last one per key in ``position`` order."""
    spec = ENTITIES[entity]
    kept = [c for c in spec.raw if c not in position]
    ordered = with_contract(frame, [*kept, *position])
    sane = sanitize_rows(ordered, entity, as_of)
    return keep_last(sane, spec.key, position).select(*spec.raw)


def sanitize_snapshots(
    snapshots: Mapping[str, DataFrame],
    position: Sequence[str] = ("created_at",),
    as_of: datetime | Column | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows,
) -> dict[str, DataFrame]:
    """All five entities with valid values and closed references.

    ``keep`` gets each entity once, parents first, and returns the rows to go on with:
    one that stores them saves computing a parent again for every table that refers to it.

    References are checked before deduplication, so an invalid late copy never
    hides a valid earlier one. Attendance takes the hospital of its doctor: one
    join with the valid doctors both checks the doctor and supplies a hospital
    that is known to be valid.
    """
    plain = {
        name: keep(sanitize_entity(snapshots[name], name, position, as_of), name)
        for name in ("patients", "hospitals", "diseases")
    }

    def rows(name: str) -> DataFrame:
        kept = [c for c in ENTITIES[name].raw if c not in position]
        return sanitize_rows(with_contract(snapshots[name], [*kept, *position]), name, as_of)

    doctors = keep_last(
        existing(rows("doctors"), "hospital_id", plain["hospitals"], "hospital_id"),
        "doctor_id",
        position,
    ).select(*ENTITIES["doctors"].raw)
    doctors = keep(doctors, "doctors")

    seen = existing(rows("attendance"), "disease_id", plain["diseases"], "disease_id")
    seen = existing(seen, "patient_id", plain["patients"], "patient_id")
    homes = doctors.select(
        F.col("doctor_id").alias("__doctor"), F.col("hospital_id").alias("__home")
    )
    placed = (
        seen.join(homes, on=F.col("doctor_id") == F.col("__doctor"), how="inner")
        .withColumn("hospital_id", F.col("__home"))
        .drop("__doctor", "__home")
    )
    attendance = keep_last(placed, "attendance_id", position).select(*ENTITIES["attendance"].raw)
    return {**plain, "doctors": doctors, "attendance": keep(attendance, "attendance")}
