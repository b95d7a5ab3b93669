"""Daily hospital figures and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOSPITAL_ATTRIBUTES = ("hospital_name", "hospital_type", "state", "city")


def daily_kpi(attendance: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Attendance figures per (odate, hospital, day) with the hospital's attributes.

    The facts are aggregated before the join, so a busy hospital reaches the join
    as one row per day. Unknown hospitals keep NULL attributes; the discharge rate
    averages known flags only.
    """
    daily = attendance.groupBy("odate", "hospital_id", "attendance_date").agg(
        F.count("attendance_id").alias("attendance_count"),
        F.round(F.avg("wait_time_minutes"), 2).alias("avg_wait_time_minutes"),
        F.round(F.sum("cost"), 2).alias("total_cost"),
        F.round(F.avg(F.col("is_discharged").cast("double")), 4).alias("discharge_rate"),
    )
    described = hospitals.select("odate", "hospital_id", *HOSPITAL_ATTRIBUTES)
    return daily.join(described, on=["odate", "hospital_id"], how="left").select(
        "odate",
        "attendance_date",
        "hospital_id",
        *HOSPITAL_ATTRIBUTES,
        "attendance_count",
        "avg_wait_time_minutes",
        "total_cost",
        "discharge_rate",
    )


def busiest_days(kpi: DataFrame, count: int = 20) -> DataFrame:
    """The latest, then busiest hospital days; the keys make the order total."""
    return kpi.orderBy(
        F.col("attendance_date").desc(),
        F.col("attendance_count").desc(),
        F.col("odate").desc(),
        F.col("hospital_id"),
    ).limit(count)
