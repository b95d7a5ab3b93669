"""The rules of the two snapshot gates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.clock import instant, today
from sluice.model import ENTITIES
from sluice.operators.rules import (
    Rule,
    in_range,
    matches,
    not_after,
    not_null,
    one_of,
    unique_key,
)

BEFORE_SILVER = "bronze_to_silver"
BEFORE_GOLD = "silver_to_gold"
STAGES = (BEFORE_SILVER, BEFORE_GOLD)
SOURCE_LAYER = {BEFORE_SILVER: "bronze", BEFORE_GOLD: "silver"}

# Limits and formats of the contract.
STATE_CODE = "^[A-Z]{2}$"
CAPACITY = (1, 2000)
SEVERITY = (1, 5)
WAIT_MINUTES = (0, 300)
GENDERS = ("M", "F")
FLAGS = (0, 1)


def _key(entity: str) -> list[Rule]:
    key = ENTITIES[entity].key
    return [not_null(f"{key}_present", key), unique_key(key, key)]


def _capacity() -> Rule:
    return in_range("capacity_in_range", "capacity", *CAPACITY)


def _severity(column: str) -> Rule:
    return in_range("severity_in_range", column, *SEVERITY)


def _cost() -> Rule:
    return in_range("cost_non_negative", "cost", 0, optional=True)


def _state() -> Rule:
    return matches("state_is_uf", "state", STATE_CODE)


def _before_silver(entity: str, as_of: datetime | Column | None) -> list[Rule]:
    match entity:
        case "patients":
            return [
                not_after("birth_date_not_future", "birth_date", today(as_of)),
                one_of("gender_allowed", "gender", GENDERS),
                _state(),
            ]
        case "hospitals":
            return [_capacity(), _state()]
        case "doctors":
            positive = Rule("crm_positive", F.col("crm") > 0)
            return [positive, not_null("doctor_hospital_present", "hospital_id")]
        case "diseases":
            return [_severity("severity_level")]
        case "attendance":
            owners = ("patient", "doctor", "hospital", "disease")
            return [
                *(not_null(f"attendance_{o}_present", f"{o}_id") for o in owners),
                not_after("attendance_date_valid", "attendance_timestamp", instant(as_of)),
                in_range(
                    "wait_time_in_range", "wait_time_minutes", *WAIT_MINUTES, optional=True
                ),
                _cost(),
                _severity("severity_score"),
                one_of("discharge_flag_allowed", "discharge_flag", FLAGS, optional=True),
            ]
    raise ValueError(f"unknown entity {entity!r}")


def _before_gold(entity: str) -> list[Rule]:
    match entity:
        case "patients":
            return [not_null("odate_present", "odate")]
        case "hospitals":
            return [_capacity()]
        case "doctors":
            return [not_null("hospital_id_present", "hospital_id")]
        case "diseases":
            return [_severity("severity_level")]
        case "attendance":
            needed = ("attendance_date", "patient_id", "doctor_id", "hospital_id", "disease_id")
            return [
                *(not_null(f"{column}_present", column) for column in needed),
                _cost(),
                _severity("severity_score"),
            ]
    raise ValueError(f"unknown entity {entity!r}")


def rules_for(stage: str, entity: str, as_of: datetime | Column | None = None) -> list[Rule]:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}")
    own = _before_silver(entity, as_of) if stage == BEFORE_SILVER else _before_gold(entity)
    return [*_key(entity), *own]
