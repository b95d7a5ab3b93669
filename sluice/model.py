"""The five snapshot entities: raw schema, typing, required and published columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.casts import text_as, trimmed, upper_code, whole_number
from sluice.functions.masking import MASKS, masked

BUSINESS_DATE = "odate"
LINEAGE = ("_source_file", "_ingested_at")
CORRUPT = "_corrupt_record"

# Typing kinds of a raw text column -> expression over it.
_TYPING = {
    "id": lambda c: whole_number(c, "bigint"),
    "int": lambda c: whole_number(c, "int"),
    "text": trimmed,
    "code": upper_code,
    "date": lambda c: text_as(c, "date"),
    "time": lambda c: text_as(c, "timestamp"),
    "money": lambda c: text_as(c, "decimal(12,2)"),
    "yes": lambda c: whole_number(c, "int") == 1,
}


@dataclass(frozen=True)
class Entity:
    """``typed`` lists the Silver columns in order as (name, kind, raw column)."""

    name: str
    raw: tuple[str, ...]
    typed: tuple[tuple[str, str, str], ...]
    required: tuple[str, ...]
    published: tuple[str, ...]
    # Raw columns that only the quality gate looks at: (name, kind, raw column).
    gate_only: tuple[tuple[str, str, str], ...] = ()

    @property
    def key(self) -> str:
        return self.raw[0]

    @property
    def raw_ddl(self) -> str:
        return ", ".join(f"{column} STRING" for column in (*self.raw, CORRUPT))

    def typed_columns(self, for_gate: bool = False) -> list[Column]:
        chosen = [*self.typed, *(self.gate_only if for_gate else ())]
        typed = [
            masked(raw) if kind == "mask" else _TYPING[kind](raw).alias(name)
            for name, kind, raw in chosen
        ]
        return [*typed, *(F.col(name) for name in (BUSINESS_DATE, *LINEAGE))]


def _same(kinds: str) -> tuple[tuple[str, str, str], ...]:
    """``"patient_id:id city:text"`` for columns that keep their raw name."""
    pairs = (item.split(":") for item in kinds.split())
    return tuple((name, kind, name) for name, kind in pairs)


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# The data contract of the five entities.
ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        Entity(
            name="patients",
            raw=_names(
                "patient_id full_name cpf email phone gender blood_type birth_date "
                "city state created_at"
            ),
            typed=_same(
                "patient_id:id full_name:mask cpf:mask email:mask phone:mask gender:code "
                "blood_type:code birth_date:date city:text state:code created_at:time"
            ),
            required=_names("birth_date gender state"),
            published=_names("patient_id gender blood_type birth_date city state odate"),
        ),
        Entity(
            name="hospitals",
            raw=_names(
                "hospital_id hospital_name hospital_type state city capacity created_at"
            ),
            typed=_same(
                "hospital_id:id hospital_name:text hospital_type:text state:code "
                "city:text capacity:int created_at:time"
            ),
            required=_names("capacity state"),
            published=_names(
                "hospital_id hospital_name hospital_type state city capacity odate"
            ),
        ),
        Entity(
            name="doctors",
            raw=_names("doctor_id doctor_name crm specialty hospital_id created_at"),
            typed=_same(
                "doctor_id:id doctor_name:text crm:id specialty:text hospital_id:id "
                "created_at:time"
            ),
            required=_names("crm hospital_id"),
            published=_names("doctor_id doctor_name specialty hospital_id odate"),
        ),
        Entity(
            name="diseases",
            raw=_names("disease_id disease_name category severity_level created_at"),
            typed=_same(
                "disease_id:id disease_name:text category:text severity_level:int "
                "created_at:time"
            ),
            required=_names("severity_level"),
            published=_names("disease_id disease_name category severity_level odate"),
        ),
        Entity(
            name="attendance",
            raw=_names(
                "attendance_id patient_id doctor_id hospital_id disease_id "
                "attendance_date wait_time_minutes cost severity_score discharge_flag "
                "created_at"
            ),
            typed=(
                *_same("attendance_id:id patient_id:id doctor_id:id hospital_id:id"),
                *_same("disease_id:id"),
                ("attendance_timestamp", "time", "attendance_date"),
                ("attendance_date", "date", "attendance_date"),
                *_same("wait_time_minutes:int cost:money severity_score:int"),
                ("is_discharged", "yes", "discharge_flag"),
                *_same("created_at:time"),
            ),
            required=_names(
                "patient_id doctor_id hospital_id disease_id attendance_timestamp "
                "severity_score"
            ),
            published=_names(
                "attendance_id patient_id doctor_id hospital_id disease_id "
                "attendance_timestamp attendance_date wait_time_minutes cost "
                "severity_score is_discharged odate"
            ),
            gate_only=_same("discharge_flag:int"),
        ),
    )
}

IDENTIFIERS = tuple(MASKS)
