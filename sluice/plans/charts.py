"""The regroupings behind the dashboard pages, over the monitoring datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.plans.monitoring import is_failed


# Batch page


def failed_runs(batch_health: DataFrame) -> DataFrame:
    return batch_health.select("failed_runs")


def running_runs(batch_health: DataFrame) -> DataFrame:
    return batch_health.select("running_runs")


def last_run_duration(batch_health: DataFrame) -> DataFrame:
    return batch_health.select("last_duration_seconds")


def duration_by_day_and_job(batch_runs: DataFrame) -> DataFrame:
    return batch_runs.groupBy("run_date", "job_name").agg(
        F.avg("duration_seconds").alias("avg_duration_seconds")
    )


def failures_by_job(batch_runs: DataFrame) -> DataFrame:
    return batch_runs.groupBy("job_name").agg(F.count_if(is_failed()).alias("failed_runs"))


def run_durations(runs: DataFrame) -> DataFrame:
    """Start, duration and state: of batch runs, stream runs or pipeline updates."""
    return runs.select("started_at", "duration_seconds", "result_state")


def quarantined_by_date_and_stage(quality_runs: DataFrame) -> DataFrame:
    return quality_runs.groupBy("odate", "dq_stage").agg(
        F.sum("quarantined_rows").alias("quarantined_rows")
    )


def table_age(gold_freshness: DataFrame) -> DataFrame:
    return gold_freshness.select("table_name", "age_days")


# Streaming page


def failed_updates(streaming_health: DataFrame) -> DataFrame:
    return streaming_health.select("failed_updates")


def last_update_duration(streaming_health: DataFrame) -> DataFrame:
    return streaming_health.select(F.col("last_update_duration_seconds").alias("duration_seconds"))


def failed_stream_runs(streaming_health: DataFrame) -> DataFrame:
    return streaming_health.select("failed_runs")


def output_by_flow(flow_metrics: DataFrame) -> DataFrame:
    return flow_metrics.groupBy("flow_name").agg(F.sum("output_rows").alias("output_rows"))


def backlog_by_flow(flow_metrics: DataFrame) -> DataFrame:
    backlog = F.coalesce("backlog_bytes_at_last_refresh", F.lit(0))
    return flow_metrics.select("flow_name", backlog.alias("backlog_bytes"))


# Quality page


def event_age(stream_freshness: DataFrame) -> DataFrame:
    return stream_freshness.agg(F.max("event_age_minutes").alias("event_age_minutes"))


def failed_stream_records(quality_health: DataFrame) -> DataFrame:
    return quality_health.select(F.col("failed_streaming_records").alias("failed_records"))


def failed_batch_tables(quality_health: DataFrame) -> DataFrame:
    return quality_health.select(F.col("failed_batch_tables").alias("failed_tables"))


def passed_by_dataset(expectation_metrics: DataFrame) -> DataFrame:
    return expectation_metrics.groupBy("dataset").agg(
        F.sum("passed_records").alias("passed_records")
    )


def violations_by_rule(quarantine_by_rule: DataFrame) -> DataFrame:
    return quarantine_by_rule.select("dq_rule", "violated_events")


def end_to_end_latency(latency_by_hour: DataFrame) -> DataFrame:
    return latency_by_hour.select("observed_hour", "end_to_end_p95_seconds")


def removed_by_table_and_stage(quality_runs: DataFrame) -> DataFrame:
    return quality_runs.groupBy("source_table", "dq_stage").agg(
        F.sum("removed_by_cleaning").alias("removed_by_cleaning")
    )
