"""The stream's two aggregates, from partial aggregates that can be merged.

A partial row holds the counts, sums and extrema of one patient's events in one window. Partial rows
of several micro-batches add up to those of all their events, and rows of short windows to those of
longer ones; patients stay apart, so distinct patients are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.streaming.contract import is_abnormal

# Published columns in order, each with what it shows of which reading.
PATIENT_COLUMNS = (
    ("measurement_count", "total", "events"),
    ("avg_heart_rate_bpm", "mean", "heart_rate_bpm"),
    ("min_oxygen_saturation_pct", "least", "oxygen_saturation_pct"),
    ("avg_temperature_c", "mean", "temperature_c"),
    ("avg_systolic_mmhg", "mean", "blood_pressure_systolic_mmhg"),
    ("avg_diastolic_mmhg", "mean", "blood_pressure_diastolic_mmhg"),
    ("abnormal_count", "total", "abnormal"),
    ("abnormal_rate", "share", "abnormal"),
    ("last_event_time", "latest", "event_time"),
)
POPULATION_COLUMNS = (
    ("event_count", "total", "events"),
    ("patient_count", "groups", "patient_id"),
    ("avg_heart_rate_bpm", "mean", "heart_rate_bpm"),
    ("avg_oxygen_saturation_pct", "mean", "oxygen_saturation_pct"),
    ("avg_temperature_c", "mean", "temperature_c"),
    ("abnormal_count", "total", "abnormal"),
    ("abnormal_rate", "share", "abnormal"),
)
PATIENT_WINDOW, POPULATION_WINDOW = "5 minutes", "1 hour"


def _parts(columns) -> dict[str, tuple[Column, str]]:
    """Partial columns that ``columns`` need: how an event counts, and how parts are merged."""
    parts: dict[str, tuple[Column, str]] = {
        "events": (F.col("event_id").isNotNull().cast("bigint"), "sum"),
        "abnormal": (is_abnormal().cast("bigint"), "sum"),
    }
    for _, shown, of in columns:
        if shown == "mean":
            parts[f"{of}_sum"] = (F.col(of).cast("double"), "sum")
            parts[f"{of}_n"] = (F.col(of).isNotNull().cast("bigint"), "sum")
        elif shown == "least":
            parts[f"{of}_least"] = (F.col(of), "min")
        elif shown == "latest":
            parts[f"{of}_latest"] = (F.col(of), "max")
    return parts


def partials(events: DataFrame, columns, width: str) -> DataFrame:
    """Partial rows per patient and window of ``width``."""
    grouped = events.groupBy("patient_id", F.window("event_time", width).alias("window"))
    made = (getattr(F, how)(value).alias(name) for name, (value, how) in _parts(columns).items())
    return grouped.agg(*made).select(
        "patient_id",
        F.col("window.start").alias("window_start"),
        *_parts(columns),
    )


def stored_partials(events: DataFrame) -> DataFrame:
    """What both aggregates need, at the width of the shorter windows."""
    return partials(events, (*PATIENT_COLUMNS, *POPULATION_COLUMNS), PATIENT_WINDOW)


def _published(parts: DataFrame, columns, keys: list[str], width: str) -> DataFrame:
    """Partial rows merged per ``keys`` and window of ``width``, as the published columns."""
    merged = [getattr(F, how)(name).alias(name) for name, (_, how) in _parts(columns).items()]
    window = F.window("window_start", width).alias("window")
    found = parts.groupBy(*keys, window).agg(*merged, F.count_distinct("patient_id").alias("_people"))
    show = {
        "total": lambda of: F.col(of),
        "mean": lambda of: F.round(F.col(f"{of}_sum") / F.col(f"{of}_n"), 2),
        "least": lambda of: F.col(f"{of}_least"),
        "latest": lambda of: F.col(f"{of}_latest"),
        "share": lambda of: F.round(F.col(of) / F.col("events"), 4),
        "groups": lambda of: F.col("_people"),
    }
    return found.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(show[shown](of).alias(name) for name, shown, of in columns),
    )


def patient_5m_of(parts: DataFrame) -> DataFrame:
    return _published(parts, PATIENT_COLUMNS, ["patient_id"], PATIENT_WINDOW)


def population_hourly_of(parts: DataFrame) -> DataFrame:
    return _published(parts, POPULATION_COLUMNS, [], POPULATION_WINDOW)


def patient_5m(events: DataFrame) -> DataFrame:
    """Readings per patient and five-minute window."""
    return patient_5m_of(partials(events, PATIENT_COLUMNS, PATIENT_WINDOW))


def population_hourly(events: DataFrame) -> DataFrame:
    """Readings of all patients per hour, without any patient identifier."""
    return population_hourly_of(partials(events, POPULATION_COLUMNS, POPULATION_WINDOW))
