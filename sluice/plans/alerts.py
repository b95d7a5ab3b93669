"""Operational alerts as queries over run tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Duration limits in seconds and states that never alert.
BATCH_LIMIT_SECONDS = 7_200
STREAM_LIMIT_SECONDS = 900
FAILURE_STATES = ("FAILED", "TIMED_OUT", "ERROR")
SILENT_STATES = ("SKIPPED", "CANCELED", "CANCELLED")
ON_FAILURE = "on_failure"
ON_DURATION = "on_duration_warning_threshold_exceeded"
ON_MISSING = "ingestion_missing"


def _limit(limits: Mapping[str, int], job_id: str = "job_id") -> Column:
    limit: Column = F.lit(None).cast("bigint")
    for job, seconds in limits.items():
        limit = F.when(F.col(job_id) == job, F.lit(seconds)).otherwise(limit)
    return limit


def run_alerts(runs: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """One row per (run, condition) over rolled-up runs with ``job_id`` and ``run_id``.

    A run alerts when it failed and when it ran longer than its job's limit, so it
    may alert twice. Skipped and cancelled runs never alert.
    """
    state = F.upper(F.col("result_state"))
    conditions = F.array_compact(
        F.array(
            F.when(state.isin(*FAILURE_STATES), F.lit(ON_FAILURE)),
            F.when(F.col("duration_seconds") > _limit(limits), F.lit(ON_DURATION)),
        )
    )
    audible = runs.where(~state.isin(*SILENT_STATES))
    return audible.select(
        F.explode(conditions).alias("event_type"),
        "job_id",
        "run_id",
        "result_state",
        "duration_seconds",
    )


def missing_ingestions(expected_dates: DataFrame, ingestions: DataFrame) -> DataFrame:
    """Expected dates without a succeeded ingestion run for that date."""
    done = ingestions.where(F.upper(F.col("status")) == "SUCCEEDED").select("odate").distinct()
    missing = expected_dates.select("odate").distinct().join(done, on="odate", how="left_anti")
    return missing.select(F.lit(ON_MISSING).alias("event_type"), "odate")
