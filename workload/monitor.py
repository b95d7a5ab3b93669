"""Monitoring, chart, alert and landing queries over tables derived from events and orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.dedup import keep_latest
from sluice.plans import alerts, charts
from sluice.plans import monitoring as m
from sluice.sources.raw import expected_landings, landed_from_paths, missing_landings
from sluice.streaming.events import quarantined_rows, valid_rows
from workload.derive import AS_OF, NOW_SQL, frame, load, sql
from workload.events import CLASSIFIED_SQL, SILVER_SQL, bronze
from workload.registry import half_up, register
from workload.snapshots import _FRESHNESS_SQL, _gold_freshness

PIPELINE = "vitals"
JOBS = ("1", "2", "3")
LABELS = {"1": "Medallion", "2": "Gate"}
STREAM_JOB = "3"
WORKSPACE = "w1"
UPDATES_OF = "p2"
_BAD = "upper(result_state) IN ('FAILED', 'CANCELED', 'CANCELLED', 'TIMED_OUT', 'ERROR')"


def _before(column: str, days: int) -> str:
    return f"{column} >= {NOW_SQL} - INTERVAL {days} DAY"


def _slices(spark, sf_dir) -> DataFrame:
    return frame(spark, sf_dir, "slices")


def _rolled_sql(keys: str, where: str, termination: bool = True) -> str:
    code = "max(termination_code) AS termination_code, " if termination else ""
    return (
        f"SELECT {keys}, min(period_start_time) AS started_at, max(period_end_time) AS finished_at, "
        f"coalesce(max(result_state), 'RUNNING') AS result_state, {code}"
        "CAST(sum(datesub('second', period_start_time, period_end_time)) AS BIGINT) "
        f"AS duration_seconds FROM ({sql('slices')}) s WHERE {where} "
        f"AND {_before('period_start_time', 90)} GROUP BY {keys}"
    )


_HERE = f"workspace_id = '{WORKSPACE}' AND "
_UPDATES_SQL = _rolled_sql(
    "update_id", f"{_HERE}pipeline_id = '{UPDATES_OF}'", termination=False
)
_ALL_UPDATES_SQL = _UPDATES_SQL.replace(_HERE, "")
_JOB_SQL = _rolled_sql("run_id", f"{_HERE}job_id = '{STREAM_JOB}'")
_ALL_JOB_SQL = _JOB_SQL.replace(_HERE, "")
_BATCH_SLICES_SQL = _rolled_sql("job_id, run_id", f"{_HERE}job_id IN ('1', '2', '3')")
_BATCH_SQL = (
    "SELECT CASE job_id WHEN '1' THEN 'Medallion' WHEN '2' THEN 'Gate' ELSE 'Job ' || job_id END "
    "AS job_name, run_id, CAST(started_at AS DATE) AS run_date, started_at, finished_at, "
    f"result_state, termination_code, duration_seconds FROM ({_BATCH_SLICES_SQL}) r"
)
_ALL_BATCH_SQL = _BATCH_SQL.replace(_HERE, "")
_BATCH_HEALTH_SQL = (
    f"SELECT count(*) FILTER (WHERE {_BAD}) AS failed_runs, "
    "count(*) FILTER (WHERE upper(result_state) = 'RUNNING') AS running_runs, "
    "arg_max(duration_seconds, (started_at, run_id)) AS last_duration_seconds "
    f"FROM ({_rolled_sql('run_id', _HERE + 'job_id IN (' + repr(JOBS)[1:-1] + ')')}) r"
)
_ALL_BATCH_HEALTH_SQL = _BATCH_HEALTH_SQL.replace(_HERE, "")
_STREAM_HEALTH_SQL = (
    f"SELECT count(*) FILTER (WHERE {_BAD}) AS failed_updates, "
    "arg_max(duration_seconds, (started_at, update_id)) AS last_update_duration_seconds, "
    f"(SELECT count(*) FILTER (WHERE {_BAD}) FROM ({_JOB_SQL}) j) AS failed_runs "
    f"FROM ({_UPDATES_SQL}) u"
)


def _updates(s, d):
    return m.pipeline_updates(_slices(s, d), UPDATES_OF, AS_OF, WORKSPACE)


def _all_updates(s, d):
    return m.pipeline_updates(_slices(s, d), UPDATES_OF, AS_OF)


def _job_runs(s, d):
    return m.job_runs(_slices(s, d), STREAM_JOB, AS_OF, WORKSPACE)


def _all_job_runs(s, d):
    return m.job_runs(_slices(s, d), STREAM_JOB, AS_OF)


def _batch_runs(s, d):
    return m.batch_runs(_slices(s, d), JOBS, LABELS, AS_OF, WORKSPACE)


def _all_batch_runs(s, d):
    return m.batch_runs(_slices(s, d), JOBS, LABELS, AS_OF)


def _batch_health(s, d):
    return m.batch_health(_slices(s, d), JOBS, AS_OF, WORKSPACE)


def _all_batch_health(s, d):
    return m.batch_health(_slices(s, d), JOBS, AS_OF)


def _stream_health(s, d):
    return m.streaming_health(_slices(s, d), UPDATES_OF, _slices(s, d), STREAM_JOB, AS_OF, WORKSPACE)


register("pipeline_updates", _all_updates, _ALL_UPDATES_SQL)
register("streaming_job_runs", _all_job_runs, _ALL_JOB_SQL)
register("batch_job_runs", _all_batch_runs, _ALL_BATCH_SQL)
register("batch_health", _all_batch_health, _ALL_BATCH_HEALTH_SQL)
register("streaming_health", _stream_health, _STREAM_HEALTH_SQL)

# -- event log -------------------------------------------------------------

_LATEST_SQL = (
    f"(SELECT origin.update_id FROM ({sql('event_log')}) l WHERE origin.pipeline_id = '{PIPELINE}' "
    "AND origin.update_id IS NOT NULL ORDER BY \"timestamp\" DESC, origin.update_id DESC LIMIT 1)"
)
_PROGRESS_SQL = (
    f"SELECT * FROM ({sql('event_log')}) l WHERE event_type = 'flow_progress' "
    f"AND origin.update_id = {_LATEST_SQL}"
)


def _json(path: str) -> str:
    return f"(details->>'$.flow_progress.{path}')"


_FLOW_SQL = (
    "SELECT update_id, flow_name, arg_max(flow_status, (seen_at, flow_status)) AS final_status, "
    "min(seen_at) AS started_at, max(seen_at) AS observed_at, "
    "CAST(sum(coalesce(output_rows, 0)) AS BIGINT) AS output_rows, "
    "CAST(sum(coalesce(dropped_records, 0)) AS BIGINT) AS dropped_records, "
    "arg_max(backlog_bytes, (seen_at, backlog_bytes)) FILTER (WHERE backlog_bytes IS NOT NULL) "
    "AS backlog_bytes_at_last_refresh, "
    f"datesub('minute', max(seen_at), {NOW_SQL}) AS observation_age_minutes FROM ("
    "SELECT origin.update_id AS update_id, coalesce(origin.flow_name, origin.dataset_name) "
    f"AS flow_name, \"timestamp\" AS seen_at, {_json('status')} AS flow_status, "
    f"TRY_CAST({_json('metrics.num_output_rows')} AS BIGINT) AS output_rows, "
    f"TRY_CAST({_json('metrics.backlog_bytes')} AS BIGINT) AS backlog_bytes, "
    f"TRY_CAST({_json('data_quality.dropped_records')} AS BIGINT) AS dropped_records "
    f"FROM ({_PROGRESS_SQL}) p) f GROUP BY update_id, flow_name"
)
_EXPLODED_SQL = (
    "SELECT origin.update_id AS update_id, unnest(CAST(details->'$.flow_progress.data_quality"
    ".expectations' AS JSON[])) AS e "
    f"FROM ({_PROGRESS_SQL}) p"
)
_EXPECT_SQL = (
    "SELECT update_id, e->>'$.dataset' AS dataset, e->>'$.name' AS dq_rule, "
    "CAST(sum(CAST(e->>'$.passed_records' AS BIGINT)) AS BIGINT) AS passed_records, "
    "CAST(sum(CAST(e->>'$.failed_records' AS BIGINT)) AS BIGINT) AS failed_records "
    f"FROM ({_EXPLODED_SQL}) x GROUP BY ALL"
)


def _flows(s, d):
    return m.flow_metrics(frame(s, d, "event_log"), PIPELINE, AS_OF)


def _expectations(s, d):
    return m.expectation_metrics(frame(s, d, "event_log"), PIPELINE)


register("flow_metrics", _flows, _FLOW_SQL)
register("expectation_metrics", _expectations, _EXPECT_SQL)

# -- freshness, latency, quarantine ----------------------------------------

_STREAM_FRESH_SQL = (
    f"SELECT {NOW_SQL} AS observed_at, max(event_time) AS latest_event_time, "
    "max(eventhub_enqueued_at) AS latest_eventhub_enqueued_at, "
    "max(ingested_at) AS latest_bronze_ingested_at, "
    f"datesub('minute', max(event_time), {NOW_SQL}) AS event_age_minutes, "
    f"datesub('minute', max(ingested_at), {NOW_SQL}) AS ingestion_age_minutes "
    f"FROM ({SILVER_SQL}) s WHERE {_before('event_time', 90)}"
)


def _p95(start: str, end: str) -> str:
    millis = f"datesub('millisecond', {start}, {end})"
    exact = f"quantile_disc(CAST({millis} AS DECIMAL(38,6)) / 1000, 0.95)"
    return f"round(CAST({exact} AS DECIMAL(28,6)), 2)"


_LATENCY_SQL = (
    "SELECT date_trunc('hour', eventhub_enqueued_at) AS observed_hour, count(*) AS event_count, "
    f"{_p95('produced_at', 'eventhub_enqueued_at')} AS producer_to_hub_p95_seconds, "
    f"{_p95('eventhub_enqueued_at', 'ingested_at')} AS hub_to_bronze_p95_seconds, "
    f"{_p95('produced_at', 'ingested_at')} AS end_to_end_p95_seconds "
    f"FROM ({SILVER_SQL}) s WHERE {_before('event_time', 8)} "
    f"AND {_before('eventhub_enqueued_at', 7)} GROUP BY 1"
)
_QUARANTINE_SQL = (
    "SELECT dq_rule, count(*) AS violated_events, max(eventhub_enqueued_at) AS last_violation_at "
    "FROM (SELECT unnest(string_split(_dq_errors, ',')) AS dq_rule, eventhub_enqueued_at "
    f"FROM ({CLASSIFIED_SQL}) c WHERE _dq_errors <> '') u "
    f"WHERE {_before('eventhub_enqueued_at', 30)} GROUP BY dq_rule"
)


def _fresh(s, d):
    return m.stream_freshness(valid_rows(bronze(s, d)), AS_OF)


def _latency(s, d):
    return m.latency_by_hour(valid_rows(bronze(s, d)), AS_OF)


def _by_rule(s, d):
    return m.quarantine_by_rule(quarantined_rows(bronze(s, d)), AS_OF)


register("stream_freshness", _fresh, _STREAM_FRESH_SQL)
register("latency_by_hour", _latency, _LATENCY_SQL)
register("quarantine_by_rule", _by_rule, _QUARANTINE_SQL)

# -- quality runs ----------------------------------------------------------

# The metric dates reach into 2007; the clock is set where a year of them remains.
_QUALITY_NOW = "TIMESTAMP '2007-01-22 00:00:00'"
_LATEST_METRICS_SQL = (
    f"SELECT x.* FROM ({sql('run_metrics')}) x JOIN (SELECT dq_stage, odate, "
    "arg_max(dq_run_id, (checked_at, dq_run_id)) AS dq_run_id "
    f"FROM ({sql('run_metrics')}) y WHERE checked_at >= {_QUALITY_NOW} - INTERVAL 365 DAY "
    "GROUP BY ALL) r USING (dq_stage, odate, dq_run_id)"
)
# The control table holds the last approval of each stage and date.
_CONTROL_SQL = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dq_stage, odate ORDER BY "
    f"approved_at DESC NULLS LAST, dq_run_id DESC NULLS LAST) AS rn FROM ({sql('run_approvals')}) a"
    ") k WHERE rn = 1"
)
_QUALITY_RUNS_SQL = (
    "SELECT q.checked_at, q.odate, q.dq_stage, q.dq_run_id, q.source_table, q.input_rows, "
    "q.checked_rows, q.input_rows - q.checked_rows AS removed_by_cleaning, q.valid_rows, "
    "q.quarantined_rows, q.status, (q.input_rows >= q.checked_rows AND "
    "q.checked_rows = q.valid_rows + q.quarantined_rows) AS reconciliation_ok, "
    f"p.dq_run_id IS NOT NULL AS promotion_approved FROM ({_LATEST_METRICS_SQL}) q "
    f"LEFT JOIN ({_CONTROL_SQL}) p USING (dq_stage, odate, dq_run_id)"
)
_QUALITY_HEALTH_SQL = (
    "SELECT count(*) FILTER (WHERE status = 'FAILED') AS failed_batch_tables, "
    "(SELECT coalesce(CAST(sum(CAST(e->>'$.failed_records' AS BIGINT)) AS BIGINT), 0) "
    f"FROM ({_EXPLODED_SQL}) x) AS failed_streaming_records FROM ({_LATEST_METRICS_SQL}) q"
)


def _quality_clock():
    return F.lit("2007-01-22 00:00:00")


def _control(s, d):
    newest = [F.col(c).desc_nulls_last() for c in ("approved_at", "dq_run_id")]
    return keep_latest(frame(s, d, "run_approvals"), ["dq_stage", "odate"], newest)


def _quality_runs(s, d):
    return m.latest_quality_runs(frame(s, d, "run_metrics"), _control(s, d), _quality_clock())


def _quality_health(s, d):
    metrics = frame(s, d, "run_metrics")
    return m.quality_health(metrics, frame(s, d, "event_log"), PIPELINE, _quality_clock())


register("quality_runs", _quality_runs, _QUALITY_RUNS_SQL)
register("quality_health", _quality_health, _QUALITY_HEALTH_SQL)
register(
    "metrics_of_date",
    lambda s, d: m.metrics_of_date(frame(s, d, "run_metrics"), date(1998, 3, 2)),
    f"SELECT * FROM ({sql('run_metrics')}) x WHERE odate = DATE '1998-03-02'",
)
register(
    "approvals_sorted",
    lambda s, d: m.approvals_sorted(_control(s, d)),
    _CONTROL_SQL,
)

# -- order of the sorted results -------------------------------------------


def _in_order(rows: DataFrame, *key: str) -> DataFrame:
    """The key columns with the place at which the result has the row; results are of panel size."""
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_at")).cast("bigint")
    return numbered.select(*key, place.alias("place"))


def _order_sql(text: str, key: str, order: str) -> str:
    return f"SELECT {key}, row_number() OVER (ORDER BY {order}) AS place FROM ({text}) o"


register(
    "pipeline_updates_in_order",
    lambda s, d: _in_order(_updates(s, d), "update_id"),
    _order_sql(_UPDATES_SQL, "update_id", "started_at DESC, update_id"),
)
register(
    "batch_job_runs_in_order",
    lambda s, d: _in_order(_batch_runs(s, d), "job_name", "run_id"),
    _order_sql(_BATCH_SQL, "job_name, run_id", "started_at DESC, run_id"),
)
register(
    "approvals_in_order",
    lambda s, d: _in_order(m.approvals_sorted(_control(s, d)), "dq_stage", "odate", "dq_run_id"),
    _order_sql(_CONTROL_SQL, "dq_stage, odate, dq_run_id", "dq_stage, odate DESC, dq_run_id"),
)
register(
    "gold_freshness_in_order",
    lambda s, d: _in_order(_gold_freshness(s, d), "table_name"),
    _order_sql(_FRESHNESS_SQL, "table_name", "table_name"),
)

# -- charts ----------------------------------------------------------------

_CHARTS = {
    "failed_runs": (charts.failed_runs, _batch_health, "failed_runs", _BATCH_HEALTH_SQL),
    "running_runs": (
        charts.running_runs,
        _all_batch_health,
        "running_runs",
        _ALL_BATCH_HEALTH_SQL,
    ),
    "last_run_duration": (
        charts.last_run_duration,
        _batch_health,
        "last_duration_seconds",
        _BATCH_HEALTH_SQL,
    ),
    "duration_by_day_and_job": (
        charts.duration_by_day_and_job,
        _all_batch_runs,
        "run_date, job_name, avg(duration_seconds) AS avg_duration_seconds",
        f"{_ALL_BATCH_SQL}) q GROUP BY run_date, job_name --",
    ),
    "failures_by_job": (
        charts.failures_by_job,
        _batch_runs,
        f"job_name, count(*) FILTER (WHERE {_BAD}) AS failed_runs",
        f"{_BATCH_SQL}) q GROUP BY job_name --",
    ),
    "batch_run_durations": (
        charts.run_durations,
        _all_batch_runs,
        "started_at, duration_seconds, result_state",
        _ALL_BATCH_SQL,
    ),
    "quarantined_by_date_and_stage": (
        charts.quarantined_by_date_and_stage,
        _quality_runs,
        "odate, dq_stage, CAST(sum(quarantined_rows) AS BIGINT) AS quarantined_rows",
        f"{_QUALITY_RUNS_SQL}) q GROUP BY odate, dq_stage --",
    ),
    "table_age": (charts.table_age, _gold_freshness, "table_name, age_days", _FRESHNESS_SQL),
    "failed_updates": (charts.failed_updates, _stream_health, "failed_updates", _STREAM_HEALTH_SQL),
    "last_update_duration": (
        charts.last_update_duration,
        _stream_health,
        "last_update_duration_seconds AS duration_seconds",
        _STREAM_HEALTH_SQL,
    ),
    "failed_stream_runs": (
        charts.failed_stream_runs,
        _stream_health,
        "failed_runs",
        _STREAM_HEALTH_SQL,
    ),
    "update_durations": (
        charts.run_durations,
        _all_updates,
        "started_at, duration_seconds, result_state",
        _ALL_UPDATES_SQL,
    ),
    "output_by_flow": (
        charts.output_by_flow,
        _flows,
        "flow_name, CAST(sum(output_rows) AS BIGINT) AS output_rows",
        f"{_FLOW_SQL}) q GROUP BY flow_name --",
    ),
    "backlog_by_flow": (
        charts.backlog_by_flow,
        _flows,
        "flow_name, coalesce(backlog_bytes_at_last_refresh, 0) AS backlog_bytes",
        _FLOW_SQL,
    ),
    "stream_run_durations": (
        charts.run_durations,
        _all_job_runs,
        "started_at, duration_seconds, result_state",
        _ALL_JOB_SQL,
    ),
    "event_age": (
        charts.event_age,
        _fresh,
        "max(event_age_minutes) AS event_age_minutes",
        _STREAM_FRESH_SQL,
    ),
    "failed_stream_records": (
        charts.failed_stream_records,
        _quality_health,
        "failed_streaming_records AS failed_records",
        _QUALITY_HEALTH_SQL,
    ),
    "failed_batch_tables": (
        charts.failed_batch_tables,
        _quality_health,
        "failed_batch_tables AS failed_tables",
        _QUALITY_HEALTH_SQL,
    ),
    "passed_by_dataset": (
        charts.passed_by_dataset,
        _expectations,
        "dataset, CAST(sum(passed_records) AS BIGINT) AS passed_records",
        f"{_EXPECT_SQL}) q GROUP BY dataset --",
    ),
    "violations_by_rule": (
        charts.violations_by_rule,
        _by_rule,
        "dq_rule, violated_events",
        _QUARANTINE_SQL,
    ),
    "end_to_end_latency": (
        charts.end_to_end_latency,
        _latency,
        "observed_hour, end_to_end_p95_seconds",
        _LATENCY_SQL,
    ),
    "removed_by_table_and_stage": (
        charts.removed_by_table_and_stage,
        _quality_runs,
        "source_table, dq_stage, CAST(sum(removed_by_cleaning) AS BIGINT) AS removed_by_cleaning",
        f"{_QUALITY_RUNS_SQL}) q GROUP BY source_table, dq_stage --",
    ),
}
for _name, (_chart, _data, _columns, _source) in _CHARTS.items():
    _text, _, _group = _source.partition(") q GROUP BY ")
    _tail = f" GROUP BY {_group.removesuffix(' --')}" if _group else ""
    register(
        f"chart_{_name}",
        lambda s, d, c=_chart, f=_data: c(f(s, d)),
        f"SELECT {_columns} FROM ({_text}) q{_tail}",
    )

# -- alerts and landing ----------------------------------------------------

_LIMITS = {"1": alerts.STREAM_LIMIT_SECONDS, "2": alerts.BATCH_LIMIT_SECONDS, "3": 2_000}


def _run_alerts(s, d):
    runs = m.roll_up_slices(_slices(s, d), ["job_id", "run_id"], AS_OF)
    return alerts.run_alerts(runs, _LIMITS)


_ALERT_RUNS_SQL = _rolled_sql("job_id, run_id", "true")
_ALERT_COLUMNS = "job_id, run_id, result_state, duration_seconds"
register(
    "run_alerts",
    _run_alerts,
    f"SELECT 'on_failure' AS event_type, {_ALERT_COLUMNS} FROM ({_ALERT_RUNS_SQL}) a "
    "WHERE upper(result_state) IN ('FAILED', 'TIMED_OUT', 'ERROR') UNION ALL "
    f"SELECT 'on_duration_warning_threshold_exceeded', {_ALERT_COLUMNS} "
    f"FROM ({_ALERT_RUNS_SQL}) b WHERE upper(result_state) NOT IN "
    "('SKIPPED', 'CANCELED', 'CANCELLED') AND duration_seconds > "
    "CASE job_id WHEN '1' THEN 900 WHEN '2' THEN 7200 WHEN '3' THEN 2000 END",
)


def _missing_ingestions(s, d):
    runs = frame(s, d, "ingestions")
    return alerts.missing_ingestions(runs, runs)


register(
    "missing_ingestions",
    _missing_ingestions,
    f"SELECT DISTINCT 'ingestion_missing' AS event_type, odate FROM ({sql('ingestions')}) i "
    f"WHERE odate NOT IN (SELECT odate FROM ({sql('ingestions')}) j "
    "WHERE upper(status) = 'SUCCEEDED')",
)

_DATASETS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _missing_landings(s, d):
    """Order priorities as datasets: one file per priority and order date."""
    orders = load(s, d, "orders")
    day = F.col("o_orderdate").cast("date")
    paths = orders.select(
        F.concat(
            F.lit("s3/raw/"),
            "o_orderpriority",
            F.lit("/odate="),
            day.cast("string"),
            F.lit("/"),
            "o_orderpriority",
            F.lit(".csv"),
        ).alias("path")
    )
    expected = expected_landings(orders.select(day.alias("odate")), _DATASETS)
    return missing_landings(expected, landed_from_paths(paths), "s3/raw/")


register(
    "landing_missing",
    _missing_landings,
    "SELECT dataset, odate, 's3/raw/' || dataset || '/odate=' || CAST(odate AS VARCHAR) || '/' "
    "|| dataset || '.csv' AS expected_path FROM ("
    f"SELECT unnest([{', '.join(repr(x) for x in _DATASETS)}]) AS dataset, odate FROM "
    "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS odate FROM orders) o EXCEPT "
    "SELECT o_orderpriority, CAST(o_orderdate AS DATE) FROM orders) x",
)
