"""Completeness and duplicate profile of a snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Expected shares of missing values and repeated keys per entity.
EXPECTED_NULLS: dict[str, dict[str, float]] = {
    "hospitals": {"hospital_type": 0.005, "city": 0.010, "state": 0.005, "capacity": 0.003},
    "patients": {
        "email": 0.080,
        "phone": 0.060,
        "gender": 0.002,
        "blood_type": 0.030,
        "birth_date": 0.004,
        "city": 0.020,
        "state": 0.010,
    },
    "doctors": {"crm": 0.003, "specialty": 0.010, "hospital_id": 0.002},
    "diseases": {"category": 0.005, "severity_level": 0.002},
    "attendance": {
        "doctor_id": 0.001,
        "hospital_id": 0.001,
        "wait_time_minutes": 0.025,
        "cost": 0.015,
        "severity_score": 0.003,
        "discharge_flag": 0.010,
    },
}
EXPECTED_DUPLICATES: dict[str, float] = {
    "hospitals": 0.001,
    "patients": 0.002,
    "doctors": 0.001,
    "diseases": 0.000,
    "attendance": 0.0015,
}


def profile(frame: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per column (NULL rows) and one for the key (repeated rows).

    Columns: ``item, kind, rows, hits, rate``. NULL flags are added up per key
    together with the copies, so one pre-aggregated shuffle answers both.
    """
    per_key = frame.groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__copies"),
        *(F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in columns),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("__repeated"),
        *(F.coalesce(F.sum(f"__null_{c}"), F.lit(0)).alias(f"__null_{c}") for c in columns),
    )
    items = [("nulls", c, f"__null_{c}") for c in columns] + [("duplicates", key, "__repeated")]
    stacked = ", ".join(f"'{kind}', '{name}', `{hits}`" for kind, name, hits in items)
    long = totals.select(
        "rows", F.expr(f"stack({len(items)}, {stacked}) AS (kind, item, hits)")
    )
    rate = F.when(F.col("rows") > 0, F.col("hits") / F.col("rows")).otherwise(F.lit(0.0))
    return long.select("item", "kind", "rows", "hits", rate.alias("rate"))


def against_expected(
    profiled: DataFrame,
    nulls: Mapping[str, float],
    duplicates: float,
    tolerance: float,
) -> DataFrame:
    """Add the expected rate and whether the measured one stays within tolerance."""
    expected = F.when(F.col("kind") == "duplicates", F.lit(float(duplicates)))
    for column, share in nulls.items():
        named = (F.col("kind") == "nulls") & (F.col("item") == column)
        expected = expected.when(named, F.lit(float(share)))
    with_expected = profiled.withColumn("expected_rate", expected.otherwise(F.lit(0.0)))
    within = F.abs(F.col("rate") - F.col("expected_rate")) <= F.lit(float(tolerance))
    return with_expected.withColumn("within_tolerance", within)
