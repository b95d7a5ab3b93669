"""Version 1 of the vital-sign event: fields, formats and rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.operators.rules import Rule, column_rule, in_range, matches, not_null

# Payload fields in contract order with their JSON types.
PAYLOAD_DDL = (
    "schema_version INT, event_id STRING, event_type STRING, patient_id LONG, "
    "heart_rate_bpm INT, oxygen_saturation_pct DOUBLE, temperature_c DOUBLE, "
    "blood_pressure_systolic_mmhg INT, blood_pressure_diastolic_mmhg INT, "
    "event_time STRING, produced_at STRING, producer_run_id STRING, source STRING"
)
PAYLOAD_FIELDS = tuple(part.split()[0] for part in PAYLOAD_DDL.split(", "))
LINEAGE_FIELDS = (
    "eventhub_partition",
    "eventhub_offset",
    "eventhub_enqueued_at",
    "ingested_at",
    "payload_sha256",
)
SILVER_FIELDS = (*PAYLOAD_FIELDS, *LINEAGE_FIELDS)
QUARANTINE_FIELDS = (
    "raw_payload",
    "eventhub_name",
    *LINEAGE_FIELDS,
    "event_id",
    "patient_id",
    "producer_run_id",
)

# Accepted version, type, formats and limits.
SCHEMA_VERSION = 1
EVENT_TYPE = "patient_vital_signs"
UTC_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?Z$"
UUID_TEXT = "^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
CLOCK_SKEW = "INTERVAL 5 MINUTES"
ACCEPTED_LATENESS = "INTERVAL 24 HOURS"
WATERMARK = "25 hours"

# Consumer limits (heart rate, oxygen, temperature, pressures).
CONSUMER_RANGES = {
    "heart_rate_in_range": ("heart_rate_bpm", 30, 220),
    "oxygen_saturation_in_range": ("oxygen_saturation_pct", 50.0, 100.0),
    "temperature_in_range": ("temperature_c", 30.0, 45.0),
    "systolic_pressure_in_range": ("blood_pressure_systolic_mmhg", 60, 250),
    "diastolic_pressure_in_range": ("blood_pressure_diastolic_mmhg", 30, 150),
}
# The narrower limits a producer promises.
PRODUCER_RANGES = {
    "heart_rate_produced": ("heart_rate_bpm", 40, 180),
    "oxygen_saturation_produced": ("oxygen_saturation_pct", 70, 100),
    "temperature_produced": ("temperature_c", 35, 41),
    "systolic_pressure_produced": ("blood_pressure_systolic_mmhg", 90, 180),
    "diastolic_pressure_produced": ("blood_pressure_diastolic_mmhg", 60, 120),
}
# Readings outside these limits are abnormal (low, high).
NORMAL_RANGES = {
    "heart_rate_bpm": (50, 120),
    "oxygen_saturation_pct": (92.0, None),
    "temperature_c": (35.5, 38.0),
    "blood_pressure_systolic_mmhg": (None, 180),
    "blood_pressure_diastolic_mmhg": (None, 120),
}


def _only_known_keys() -> Column:
    """All contract keys and no other; a repeated key changes the count."""
    known = F.array(*(F.lit(name) for name in PAYLOAD_FIELDS))
    keys = F.col("_payload_keys")
    return (F.size(keys) == len(PAYLOAD_FIELDS)) & (F.size(F.array_except(keys, known)) == 0)


def _time_rules(column: str) -> list[Rule]:
    return [
        matches(f"{column}_utc_format", f"_{column}_raw", UTC_TEXT),
        not_null(f"{column}_present", column),
    ]


def _arrival_rules(column: str) -> list[Rule]:
    queued = F.col("eventhub_enqueued_at")
    latest, earliest = queued + F.expr(CLOCK_SKEW), queued - F.expr(ACCEPTED_LATENESS)
    return [
        column_rule(f"{column}_not_future", F.col(column) <= latest),
        column_rule(f"{column}_not_stale", F.col(column) >= earliest),
    ]


def event_rules() -> list[Rule]:
    """The 23 consumer rules in report order."""
    parsed = F.col("_parsed_payload").isNotNull() & F.col("_payload_keys").isNotNull()
    in_order = F.col("event_time") <= F.col("produced_at") + F.expr(CLOCK_SKEW)
    return [
        column_rule("payload_parseable", parsed),
        column_rule("payload_fields_exact", _only_known_keys()),
        column_rule("schema_version_supported", F.col("schema_version") == SCHEMA_VERSION),
        column_rule("event_type_supported", F.col("event_type") == EVENT_TYPE),
        matches("event_id_valid_uuid", "event_id", UUID_TEXT),
        matches("producer_run_id_valid_uuid", "producer_run_id", UUID_TEXT),
        column_rule("patient_id_positive", F.col("patient_id") > 0),
        *_time_rules("event_time"),
        *_time_rules("produced_at"),
        *_arrival_rules("event_time"),
        *_arrival_rules("produced_at"),
        column_rule("event_precedes_production", in_order),
        *(in_range(name, *limits) for name, limits in CONSUMER_RANGES.items()),
        column_rule(
            "systolic_above_diastolic",
            F.col("blood_pressure_systolic_mmhg") > F.col("blood_pressure_diastolic_mmhg"),
        ),
        column_rule("source_present", F.length("source") > 0),
    ]


def producer_rules() -> list[Rule]:
    """What a producer promises beyond the consumer rules."""
    oxygen = F.col("oxygen_saturation_pct")
    return [
        *(in_range(name, *limits) for name, limits in PRODUCER_RANGES.items()),
        column_rule("oxygen_saturation_whole", oxygen == F.floor(oxygen)),
    ]


def is_abnormal() -> Column:
    """TRUE when any reading leaves its normal range."""
    outside = []
    for column, (low, high) in NORMAL_RANGES.items():
        if low is not None:
            outside.append(F.col(column) < low)
        if high is not None:
            outside.append(F.col(column) > high)
    result = outside[0]
    for test in outside[1:]:
        result = result | test
    return result
