"""Compare and roll forward dated snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def previous_snapshot(history: DataFrame, odate: date, column: str = "odate") -> DataFrame:
    """Rows of the latest snapshot before ``odate``; empty if there is none.

    The date is a scalar subquery over the partition column, so the outer scan
    prunes to one partition at run time.
    """
    earlier = history.where(F.col(column) < F.lit(odate))
    latest = earlier.agg(F.max(column).alias("latest"))
    return earlier.where(F.col(column) == latest.scalar())


def key_changes(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Per key: copies before and after, and ``retained``/``removed``/``added``.

    Both sides are counted together in one pre-aggregated shuffle; repeated keys
    never multiply as they would in a join.
    """
    both = previous.select(F.col(key), F.lit(0).alias("__side")).unionByName(
        current.select(F.col(key), F.lit(1).alias("__side"))
    )
    counted = both.groupBy(key).agg(
        F.count_if(F.col("__side") == 0).alias("previous_copies"),
        F.count_if(F.col("__side") == 1).alias("current_copies"),
    )
    change = (
        F.when(F.col("previous_copies") == 0, "added")
        .when(F.col("current_copies") == 0, "removed")
        .otherwise("retained")
    )
    return counted.withColumn("change", change)


def snapshot_delta(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """One row of row counts: previous, retained, removed, added, output."""
    changes = key_changes(previous, current, key)

    def total(column: str, change: str | None = None):
        value = F.col(column)
        chosen = value if change is None else F.when(F.col("change") == change, value)
        return F.coalesce(F.sum(chosen), F.lit(0))

    return changes.agg(
        total("previous_copies").alias("previous_rows"),
        total("previous_copies", "retained").alias("retained_rows"),
        total("previous_copies", "removed").alias("removed_rows"),
        total("current_copies", "added").alias("added_rows"),
        total("current_copies").alias("output_rows"),
    )


def roll_forward(previous: DataFrame, churned: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The next snapshot: previous rows whose key did not churn, then new rows."""
    gone = churned.select(F.col(key).alias("__gone")).distinct()
    kept = previous.join(gone, on=F.col(key).eqNullSafe(F.col("__gone")), how="left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
