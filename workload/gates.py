"""The gate as users run it: metrics, quarantine, empty verdicts, approvals, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.casts import whole_number
from sluice.model import ENTITIES
from sluice.operators.checks import ERRORS, accepted_keys
from sluice.plans.gate import (
    CONTROL_LAYER,
    METRICS_TABLE,
    QUARANTINE_LAYER,
    GateRejected,
    approvals,
    run_gate,
)
from sluice.plans.medallion import KPI_TABLE, promote_silver, publish_gold, sanitize_into
from sluice.plans.rulebook import BEFORE_GOLD, BEFORE_SILVER, rules_for
from sluice.sources.tables import Lake
from workload.derive import AS_OF, DAY_SQL, NOW_SQL, ODATE, frame, sql
from workload.lake import NEXT, fresh_lake
from workload.registry import ORACLE, register
from workload.snapshots import _checked_sql, cleaned, cleaned_sql, kpi_sql, published_sql

RUN_ID = "run-1"


def _landed(spark, sf_dir, label: str) -> Lake:
    """The derived snapshots as Bronze of one date."""
    lake = fresh_lake(spark, label)
    for entity in ENTITIES:
        lake.replace_partition(frame(spark, sf_dir, entity), "bronze", entity, ODATE)
    return lake


def _rejected_run(spark, sf_dir, label: str) -> Lake:
    lake = _landed(spark, sf_dir, label)
    try:
        run_gate(lake, BEFORE_SILVER, ODATE, RUN_ID, AS_OF)
    except GateRejected:
        return lake
    raise AssertionError("the derived snapshots hold bad rows, but the gate let them pass")


def _plain(column: str):
    """A table's name without the prefix of this run's layers."""
    return F.regexp_replace(column, "^q[0-9a-f]{12}_", "").alias(column)


def _metrics(lake: Lake) -> DataFrame:
    return lake.read(CONTROL_LAYER, METRICS_TABLE).select(
        "dq_run_id",
        "dq_stage",
        "odate",
        "checked_at",
        _plain("source_table"),
        _plain("quarantine_table"),
        "input_rows",
        "checked_rows",
        "valid_rows",
        "quarantined_rows",
        "status",
        "violation_summary",
    )


def _metrics_sql(entity: str) -> str:
    return (
        f"SELECT '{RUN_ID}' AS dq_run_id, 'bronze_to_silver' AS dq_stage, {DAY_SQL} AS odate, "
        f"{NOW_SQL} AS checked_at, 'bronze.{entity}' AS source_table, "
        f"'quarantine.bronze_to_silver_{entity}' AS quarantine_table, input_rows, checked_rows, "
        "checked_rows - bad AS valid_rows, bad AS quarantined_rows, "
        "CASE WHEN bad = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, "
        "'{\"quarantined_rows\":' || bad || ',\"removed_by_cleaning\":' || "
        "(input_rows - checked_rows) || '}' AS violation_summary "
        f"FROM (SELECT (SELECT count(*) FROM ({sql(entity)}) r) AS input_rows, "
        "count(*) AS checked_rows, count(*) FILTER (WHERE _dq_errors <> '') AS bad "
        f"FROM ({_checked_sql(BEFORE_SILVER, entity)}) q) n"
    )


register(
    "gate_metrics",
    lambda s, d: _metrics(_rejected_run(s, d, "gate-metrics")),
    " UNION ALL ".join(_metrics_sql(entity) for entity in ENTITIES),
)


def _quarantined(spark, sf_dir, entity: str) -> DataFrame:
    lake = _rejected_run(spark, sf_dir, "gate-quarantine")
    rows = lake.read(QUARANTINE_LAYER, f"{BEFORE_SILVER}_{entity}")
    return rows.withColumns(
        {ERRORS: F.array_join(ERRORS, ","), "_dq_source_table": _plain("_dq_source_table")}
    )


register(
    "gate_quarantine_attendance",
    lambda s, d: _quarantined(s, d, "attendance"),
    f"SELECT *, 'bronze_to_silver' AS _dq_stage, '{RUN_ID}' AS _dq_run_id, {DAY_SQL} AS _dq_odate, "
    f"{NOW_SQL} AS _dq_checked_at, 'bronze.attendance' AS _dq_source_table "
    f"FROM ({_checked_sql(BEFORE_SILVER, 'attendance')}) q WHERE _dq_errors <> ''",
)


def gate_empty_verdicts(spark, sf_dir) -> DataFrame:
    """A date without rows, and one whose doctors are all removed by cleaning."""
    lake = _landed(spark, sf_dir, "gate-empty")
    nobody = frame(spark, sf_dir, "doctors").withColumn("crm", F.lit("none"))
    lake.replace_partition(nobody, "bronze", "doctors", ODATE)
    for odate, run_id in ((ODATE, "run-1"), (NEXT, "run-2")):
        try:
            run_gate(lake, BEFORE_SILVER, odate, run_id, AS_OF)
        except GateRejected:
            continue
        raise AssertionError("a gate without rows passed")
    wanted = (F.col("source_table") == "bronze.doctors") | (F.col("dq_run_id") == "run-2")
    return _metrics(lake).where(wanted).drop("checked_at", "quarantine_table")


register(
    "gate_empty_verdicts",
    gate_empty_verdicts,
    "SELECT 'run-1' AS dq_run_id, 'bronze_to_silver' AS dq_stage, "
    f"{DAY_SQL} AS odate, 'bronze.doctors' AS source_table, count(*) AS input_rows, "
    "0 AS checked_rows, 0 AS valid_rows, 0 AS quarantined_rows, 'FAILED' AS status, "
    "'{\"reason\":\"cleaning produced an empty snapshot\",\"removed_by_cleaning\":' || count(*) "
    "|| '}' AS violation_summary FROM part UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'run-2', 'bronze_to_silver', DATE '{NEXT}', 'bronze.{entity}', 0, 0, 0, 0, "
        f"'FAILED', '{{\"reason\":\"no rows found for odate={NEXT}\"}}'"
        for entity in ENTITIES
    ),
)


def _published(spark, sf_dir, label: str) -> Lake:
    """Both gates and both promotions of the rows that pass."""
    lake = fresh_lake(spark, label)
    for entity, contract in ENTITIES.items():
        key = contract.key
        rules = rules_for(BEFORE_SILVER, entity, AS_OF)
        good = accepted_keys(cleaned(spark, sf_dir, entity, True), rules)
        known = good.select(F.col(key).alias("_good"))
        raw = frame(spark, sf_dir, entity)
        passing = raw.join(known, whole_number(key) == F.col("_good"), "left_semi")
        lake.replace_partition(passing, "bronze", entity, ODATE)
    run_gate(lake, BEFORE_SILVER, ODATE, RUN_ID, AS_OF)
    promote_silver(lake, ODATE)
    run_gate(lake, BEFORE_GOLD, ODATE, "run-2", AS_OF)
    publish_gold(lake, ODATE)
    return lake


def _good_sql(entity: str) -> str:
    return (
        f"SELECT * EXCLUDE (_dq_errors) FROM ({_checked_sql(BEFORE_SILVER, entity)}) q "
        "WHERE _dq_errors = ''"
    )


def _gold_sql(entity: str) -> str:
    """The published columns of the rows that pass the gate before Silver."""
    return published_sql(entity).replace(cleaned_sql(entity), _good_sql(entity))


register(
    "gate_approvals",
    lambda s, d: approvals(_published(s, d, "gate-approvals")),
    f"SELECT 'bronze_to_silver' AS dq_stage, {DAY_SQL} AS odate, '{RUN_ID}' AS dq_run_id, "
    f"{NOW_SQL} AS approved_at UNION ALL "
    f"SELECT 'silver_to_gold', {DAY_SQL}, 'run-2', {NOW_SQL}",
)
register(
    "refresh_gold_attendance",
    lambda s, d: _published(s, d, "refresh-gold").read("gold", "attendance"),
    _gold_sql("attendance"),
)
register(
    "refresh_kpi_daily",
    lambda s, d: _published(s, d, "refresh-kpi").read("gold", KPI_TABLE),
    kpi_sql(_gold_sql("attendance"), _gold_sql("hospitals")),
)


def sanitize_stored(spark, sf_dir) -> DataFrame:
    """Sanitised visits whose parents are written once and read back."""
    lake = fresh_lake(spark, "sanitize")
    raw = {name: frame(spark, sf_dir, name) for name in ENTITIES}
    sanitize_into(lake, raw, ODATE, position=("_ingested_at", "_source_file"), as_of=AS_OF)
    return lake.read("sanitized", "attendance").drop("odate")


register("sanitize_stored_attendance", sanitize_stored, ORACLE["sanitize_attendance"])
