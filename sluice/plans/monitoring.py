"""Monitoring datasets. Each function takes frames and an optional ``as_of``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.clock import days_before, elapsed, instant, today

AsOf = datetime | Column | None

# Horizons in days, terminal states counted as failures, JSON shape.
RUN_DAYS = 90
METRIC_DAYS = 365
QUARANTINE_DAYS = 30
LATENCY_EVENT_DAYS = 8
LATENCY_QUEUE_DAYS = 7
FAILED_STATES = ("FAILED", "CANCELED", "CANCELLED", "TIMED_OUT", "ERROR")
EXPECTATIONS_DDL = (
    "ARRAY<STRUCT<name:STRING,dataset:STRING,passed_records:BIGINT,failed_records:BIGINT>>"
)


def is_failed(state: str = "result_state") -> Column:
    return F.upper(F.col(state)).isin(*FAILED_STATES)


# -- run timelines ---------------------------------------------------------


def roll_up_slices(slices: DataFrame, keys: Sequence[str], as_of: AsOf = None) -> DataFrame:
    """One row per run from its time slices of the last 90 days.

    A run without a final state is RUNNING; open slices add no duration.
    """
    recent = slices.where(F.col("period_start_time") >= days_before(as_of, RUN_DAYS))
    seconds = elapsed("SECOND", F.col("period_start_time"), F.col("period_end_time"))
    measures = [
        F.min("period_start_time").alias("started_at"),
        F.max("period_end_time").alias("finished_at"),
        F.coalesce(F.max("result_state"), F.lit("RUNNING")).alias("result_state"),
        F.sum(seconds).alias("duration_seconds"),
    ]
    if "termination_code" in slices.columns:
        measures.insert(3, F.max("termination_code").alias("termination_code"))
    return recent.groupBy(*keys).agg(*measures)


def _inside(timeline: DataFrame, workspace_id: str | None) -> DataFrame:
    """The rows of one workspace; run timelines hold those of all that share an account."""
    if workspace_id is None:
        return timeline
    return timeline.where(F.col("workspace_id") == workspace_id)


def _newest(run_key: str) -> list[Column]:
    """Newest first; the id keeps runs of one instant apart when sorting by range."""
    return [F.col("started_at").desc(), F.col(run_key)]


def pipeline_updates(
    timeline: DataFrame, pipeline_id: str, as_of: AsOf = None, workspace_id: str | None = None
) -> DataFrame:
    mine = _inside(timeline, workspace_id).where(F.col("pipeline_id") == pipeline_id).drop("termination_code")
    return roll_up_slices(mine, ["update_id"], as_of).orderBy(*_newest("update_id"))


def job_runs(
    timeline: DataFrame, job_id: str, as_of: AsOf = None, workspace_id: str | None = None
) -> DataFrame:
    mine = _inside(timeline, workspace_id).where(F.col("job_id") == job_id)
    return roll_up_slices(mine, ["run_id"], as_of).orderBy(*_newest("run_id"))


def job_label(labels: Mapping[str, str], job_id: str = "job_id") -> Column:
    """The label of a known job, ``Job <id>`` for any other."""
    label: Column | None = None
    for known, text in labels.items():
        test = F.col(job_id) == known
        label = F.when(test, text) if label is None else label.when(test, text)
    other = F.concat(F.lit("Job "), F.col(job_id))
    return other if label is None else label.otherwise(other)


def batch_runs(
    timeline: DataFrame,
    job_ids: Sequence[str],
    labels: Mapping[str, str],
    as_of: AsOf = None,
    workspace_id: str | None = None,
) -> DataFrame:
    mine = _inside(timeline, workspace_id).where(F.col("job_id").isin(*job_ids))
    return (
        roll_up_slices(mine, ["job_id", "run_id"], as_of)
        .select(
            job_label(labels).alias("job_name"),
            "run_id",
            F.col("started_at").cast("date").alias("run_date"),
            "started_at",
            "finished_at",
            "result_state",
            "termination_code",
            "duration_seconds",
        )
        .orderBy(*_newest("run_id"))
    )


def _latest_duration(run_key: str) -> Column:
    """Duration of the run that started last (highest id among equal starts)."""
    return F.max_by("duration_seconds", F.struct("started_at", run_key))


def batch_health(
    timeline: DataFrame,
    job_ids: Sequence[str],
    as_of: AsOf = None,
    workspace_id: str | None = None,
) -> DataFrame:
    """Always one row, also when there are no runs."""
    mine = _inside(timeline, workspace_id).where(F.col("job_id").isin(*job_ids))
    runs = roll_up_slices(mine, ["run_id"], as_of)
    return runs.agg(
        F.count_if(is_failed()).alias("failed_runs"),
        F.count_if(F.upper(F.col("result_state")) == "RUNNING").alias("running_runs"),
        _latest_duration("run_id").alias("last_duration_seconds"),
    )


def streaming_health(
    updates: DataFrame,
    pipeline_id: str,
    jobs: DataFrame,
    job_id: str,
    as_of: AsOf = None,
    workspace_id: str | None = None,
) -> DataFrame:
    """Always one row: failed updates, last update duration, failed runs."""
    own = _inside(updates, workspace_id).where(F.col("pipeline_id") == pipeline_id)
    runs = _inside(jobs, workspace_id).where(F.col("job_id") == job_id)
    by_update = roll_up_slices(own, ["update_id"], as_of)
    by_run = roll_up_slices(runs, ["run_id"], as_of)
    failed_runs = by_run.agg(F.count_if(is_failed()).alias("n"))
    return by_update.agg(
        F.count_if(is_failed()).alias("failed_updates"),
        _latest_duration("update_id").alias("last_update_duration_seconds"),
    ).select("*", failed_runs.scalar().alias("failed_runs"))


# -- pipeline event log ----------------------------------------------------


def latest_update_id(log: DataFrame, pipeline_id: str) -> DataFrame:
    """One row: the update named by the newest log entry.

    A global ``max`` of (timestamp, id) is pre-aggregated per task; a ranking
    window without a key would move the whole log into one task.
    """
    named = log.where(
        (F.col("origin.pipeline_id") == pipeline_id) & F.col("origin.update_id").isNotNull()
    )
    newest = F.max(F.struct(F.col("timestamp"), F.col("origin.update_id").alias("update_id")))
    return named.agg(newest.alias("newest")).select("newest.update_id")


def _progress(log: DataFrame, pipeline_id: str) -> DataFrame:
    """Progress entries of the latest update, whose id is a scalar subquery."""
    latest = latest_update_id(log, pipeline_id).scalar()
    return log.where(
        (F.col("event_type") == "flow_progress") & (F.col("origin.update_id") == latest)
    )


def _detail(path: str) -> Column:
    return F.get_json_object("details", f"$.flow_progress.{path}")


def flow_metrics(log: DataFrame, pipeline_id: str, as_of: AsOf = None) -> DataFrame:
    name = F.coalesce("origin.flow_name", "origin.dataset_name")
    flows = _progress(log, pipeline_id).select(
        F.col("origin.update_id").alias("update_id"),
        name.alias("flow_name"),
        F.col("timestamp").alias("observed_at"),
        _detail("status").alias("flow_status"),
        _detail("metrics.num_output_rows").try_cast("bigint").alias("output_rows"),
        _detail("metrics.backlog_bytes").try_cast("bigint").alias("backlog_bytes"),
        _detail("data_quality.dropped_records").try_cast("bigint").alias("dropped_records"),
    )
    # The value itself settles equal timestamps.
    last_backlog = F.max_by(
        "backlog_bytes",
        F.when(F.col("backlog_bytes").isNotNull(), F.struct("observed_at", "backlog_bytes")),
    )
    return (
        flows.where(F.col("flow_name").isNotNull())
        .groupBy("update_id", "flow_name")
        .agg(
            F.max_by("flow_status", F.struct("observed_at", "flow_status")).alias("final_status"),
            F.min("observed_at").alias("started_at"),
            F.max("observed_at").alias("last_observed_at"),
            F.sum(F.coalesce("output_rows", F.lit(0))).alias("output_rows"),
            F.sum(F.coalesce("dropped_records", F.lit(0))).alias("dropped_records"),
            last_backlog.alias("backlog_bytes_at_last_refresh"),
        )
        .withColumnRenamed("last_observed_at", "observed_at")
        .withColumn(
            "observation_age_minutes", elapsed("MINUTE", F.col("observed_at"), instant(as_of))
        )
        .orderBy("flow_name")
    )


def _expectations(log: DataFrame, pipeline_id: str) -> DataFrame:
    parsed = F.from_json(_detail("data_quality.expectations"), EXPECTATIONS_DDL)
    return _progress(log, pipeline_id).select(
        F.col("origin.update_id").alias("update_id"), F.inline(parsed)
    )


def expectation_metrics(log: DataFrame, pipeline_id: str) -> DataFrame:
    return (
        _expectations(log, pipeline_id)
        .groupBy("update_id", "dataset", F.col("name").alias("dq_rule"))
        .agg(
            F.sum("passed_records").alias("passed_records"),
            F.sum("failed_records").alias("failed_records"),
        )
        .orderBy(F.col("failed_records").desc(), "dq_rule")
    )


# -- stream freshness, latency, quarantine ---------------------------------


def stream_freshness(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    now = instant(as_of)
    recent = events.where(F.col("event_time") >= days_before(as_of, RUN_DAYS))
    return recent.agg(
        F.max("event_time").alias("latest_event_time"),
        F.max("eventhub_enqueued_at").alias("latest_eventhub_enqueued_at"),
        F.max("ingested_at").alias("latest_bronze_ingested_at"),
    ).select(
        now.alias("observed_at"),
        "*",
        elapsed("MINUTE", F.col("latest_event_time"), now).alias("event_age_minutes"),
        elapsed("MINUTE", F.col("latest_bronze_ingested_at"), now).alias("ingestion_age_minutes"),
    )


def _p95_seconds(start: str, end: str) -> Column:
    millis = elapsed("MILLISECOND", F.col(start), F.col(end))
    # Decimal division as in ``millis / 1000.0`` of SQL text.
    seconds = millis / F.lit(1000.0).cast("decimal(5,1)")
    return F.round(F.percentile_approx(seconds, F.lit(0.95)), 2)


def latency_by_hour(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """95th percentiles per queue hour; sketches are merged, rows are not gathered."""
    queued = "eventhub_enqueued_at"
    recent = events.where(
        (F.col("event_time") >= days_before(as_of, LATENCY_EVENT_DAYS))
        & (F.col(queued) >= days_before(as_of, LATENCY_QUEUE_DAYS))
    )
    return (
        recent.groupBy(F.date_trunc("HOUR", queued).alias("observed_hour"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            _p95_seconds("produced_at", queued).alias("producer_to_hub_p95_seconds"),
            _p95_seconds(queued, "ingested_at").alias("hub_to_bronze_p95_seconds"),
            _p95_seconds("produced_at", "ingested_at").alias("end_to_end_p95_seconds"),
        )
        .orderBy("observed_hour")
    )


def quarantine_by_rule(quarantine: DataFrame, as_of: AsOf = None) -> DataFrame:
    queued = F.col("eventhub_enqueued_at")
    recent = quarantine.where(queued >= days_before(as_of, QUARANTINE_DAYS))
    return (
        recent.select(F.explode("_dq_errors").alias("dq_rule"), "eventhub_enqueued_at")
        .groupBy("dq_rule")
        .agg(
            F.count(F.lit(1)).alias("violated_events"),
            F.max("eventhub_enqueued_at").alias("last_violation_at"),
        )
        .orderBy(F.col("violated_events").desc(), "dq_rule")
    )


# -- quality runs ----------------------------------------------------------

RUN_KEY = ("dq_stage", "odate", "dq_run_id")


def latest_quality_rows(metrics: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Metric rows of the newest run per (stage, date) within 365 days."""
    recent = metrics.where(F.col("checked_at") >= days_before(as_of, METRIC_DAYS))
    newest = recent.groupBy("dq_stage", "odate").agg(
        F.max_by("dq_run_id", F.struct("checked_at", "dq_run_id")).alias("dq_run_id")
    )
    return metrics.join(newest, on=list(RUN_KEY), how="left_semi")


def latest_quality_runs(metrics: DataFrame, approved: DataFrame, as_of: AsOf = None) -> DataFrame:
    # The control table holds one row per stage and date; distinct keeps a broken
    # one from multiplying metric rows.
    marks = approved.select(*RUN_KEY).distinct().withColumn("__approved", F.lit(True))
    balanced = (F.col("input_rows") >= F.col("checked_rows")) & (
        F.col("checked_rows") == F.col("valid_rows") + F.col("quarantined_rows")
    )
    return (
        latest_quality_rows(metrics, as_of)
        .join(marks, on=list(RUN_KEY), how="left")
        .select(
            "checked_at",
            "odate",
            "dq_stage",
            "dq_run_id",
            "source_table",
            "input_rows",
            "checked_rows",
            (F.col("input_rows") - F.col("checked_rows")).alias("removed_by_cleaning"),
            "valid_rows",
            "quarantined_rows",
            "status",
            balanced.alias("reconciliation_ok"),
            F.col("__approved").isNotNull().alias("promotion_approved"),
        )
        .orderBy(F.col("odate").desc(), "dq_stage", "source_table")
    )


def quality_health(
    metrics: DataFrame, log: DataFrame, pipeline_id: str, as_of: AsOf = None
) -> DataFrame:
    """Always one row: failed tables of the latest runs, failed stream records."""
    failed = _expectations(log, pipeline_id).agg(
        F.coalesce(F.sum("failed_records"), F.lit(0)).alias("n")
    )
    return (
        latest_quality_rows(metrics, as_of)
        .agg(F.count_if(F.col("status") == "FAILED").alias("failed_batch_tables"))
        .select("*", failed.scalar().alias("failed_streaming_records"))
    )


# -- published tables ------------------------------------------------------


def _summary(name: str, table: DataFrame, as_of: AsOf) -> DataFrame:
    """Rows are counted per date first; the dates of a table are few."""
    by_date = table.groupBy("odate").agg(F.count(F.lit(1)).alias("rows"))
    return by_date.agg(
        F.max("odate").alias("latest_odate"),
        F.count("odate").alias("partition_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("historical_rows"),
    ).select(
        F.lit(name).alias("table_name"),
        "*",
        F.date_diff(today(as_of), F.col("latest_odate")).alias("age_days"),
    )


def gold_freshness(tables: Mapping[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    parts = [_summary(name, table, as_of) for name, table in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


# -- operator lookups ------------------------------------------------------


def metrics_of_date(metrics: DataFrame, odate) -> DataFrame:
    chosen = metrics.where(F.col("odate") == F.lit(odate))
    return chosen.orderBy(F.col("checked_at").desc(), "dq_stage", "source_table", "dq_run_id")


def approvals_sorted(approved: DataFrame) -> DataFrame:
    return approved.orderBy("dq_stage", F.col("odate").desc(), "dq_run_id")
