"""Fail-closed gate: five tables of one date pass together, or none is promoted."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from sluice.functions.masking import mask_columns
from sluice.model import BUSINESS_DATE, ENTITIES, LINEAGE
from sluice.operators.checks import rejected, tally
from sluice.operators.cleaning import clean, snapshot_of
from sluice.plans.rulebook import BEFORE_SILVER, SOURCE_LAYER, rules_for
from sluice.sources.tables import EmptyPartition, Lake

CONTROL_LAYER = "observability"
METRICS_TABLE = "dq_run_metrics"
APPROVAL_TABLE = "dq_promotion_control"
QUARANTINE_LAYER = "quarantine"
# Cleaned rows of a date as the gate before Silver has checked them.
STAGING_LAYER = "staging"
RUN = "_dq_run_id"
APPROVAL_KEYS = ("dq_stage", "odate")

METRICS_SCHEMA = StructType(
    [
        StructField("checked_at", TimestampType()),
        StructField("dq_run_id", StringType()),
        StructField("dq_stage", StringType()),
        StructField("source_table", StringType()),
        StructField("quarantine_table", StringType()),
        StructField("input_rows", LongType()),
        StructField("valid_rows", LongType()),
        StructField("quarantined_rows", LongType()),
        StructField("status", StringType()),
        StructField("violation_summary", StringType()),
        StructField("odate", DateType()),
        StructField("checked_rows", LongType()),
    ]
)
APPROVAL_SCHEMA = StructType(
    [
        StructField("dq_run_id", StringType()),
        StructField("approved_at", TimestampType()),
        StructField("dq_stage", StringType()),
        StructField("odate", DateType()),
    ]
)


class GateRejected(RuntimeError):
    """At least one table of the date did not pass."""


class NotApproved(RuntimeError):
    """The date has not passed the preceding gate."""


@dataclass(frozen=True)
class TableVerdict:
    entity: str
    source_table: str
    quarantine_table: str
    input_rows: int
    checked_rows: int
    quarantined_rows: int
    reason: str | None = None

    @property
    def valid_rows(self) -> int:
        return self.checked_rows - self.quarantined_rows

    @property
    def removed_by_cleaning(self) -> int:
        return self.input_rows - self.checked_rows

    @property
    def passed(self) -> bool:
        return self.reason is None and self.quarantined_rows == 0

    @property
    def problem(self) -> str:
        return f"{self.source_table}: {self.reason or f'{self.quarantined_rows} row(s)'}"


def gate_input(lake: Lake, stage: str, entity: str, odate: date) -> DataFrame:
    layer = SOURCE_LAYER[stage]
    if stage == BEFORE_SILVER:
        return snapshot_of(lake.read(layer, entity), odate)
    return lake.partition(layer, entity, odate)


def stage_rows(
    lake: Lake, source: DataFrame, entity: str, odate: date, run_id: str
) -> DataFrame | None:
    """The cleaned rows of a date, written once; None if cleaning leaves nothing.

    The counters, the quarantine and the promotion all read them, so a snapshot is
    deduplicated and typed once, and what is promoted is what was checked.
    """
    cleaned = clean(source, entity, for_gate=True).withColumn(RUN, F.lit(run_id))
    lake.drop_if_other(cleaned.schema, STAGING_LAYER, entity)
    try:
        lake.replace_partition(cleaned, STAGING_LAYER, entity, odate)
    except EmptyPartition:
        return None
    return lake.partition(STAGING_LAYER, entity, odate).drop(RUN)


def staged_rows(lake: Lake, entity: str, odate: date, run_id: str) -> DataFrame | None:
    """The Silver columns of the rows that ``run_id`` has checked, None if they are gone."""
    if not lake.exists(STAGING_LAYER, entity):
        return None
    rows = lake.partition(STAGING_LAYER, entity, odate).where(F.col(RUN) == run_id)
    typed = [name for name, _, _ in ENTITIES[entity].typed]
    return None if rows.isEmpty() else rows.select(*typed, BUSINESS_DATE, *LINEAGE)


def check_table(
    lake: Lake,
    stage: str,
    entity: str,
    odate: date,
    run_id: str,
    checked_at: datetime,
    as_of: datetime | None = None,
) -> TableVerdict:
    """Count, check and, only if rows are bad, quarantine one table.

    The input count reads no column; one aggregate over the staged rows gives all
    other counters; bad rows are written by name of the run, masked.
    """
    source_name = lake.name(SOURCE_LAYER[stage], entity)
    quarantine = f"{stage}_{entity}"

    def verdict(input_rows: int, checked: int, bad: int, reason: str | None) -> TableVerdict:
        return TableVerdict(
            entity,
            source_name,
            lake.name(QUARANTINE_LAYER, quarantine),
            input_rows,
            checked,
            bad,
            reason,
        )

    source = gate_input(lake, stage, entity, odate)
    input_rows = source.count()
    if input_rows == 0:
        return verdict(0, 0, 0, f"no rows found for odate={odate.isoformat()}")

    rules = rules_for(stage, entity, as_of)
    checked = source
    if stage == BEFORE_SILVER:
        checked = stage_rows(lake, source, entity, odate, run_id)
    if checked is None:
        return verdict(input_rows, 0, 0, "cleaning produced an empty snapshot")
    counts = tally(checked, rules).first()
    if counts["quarantined_rows"]:
        bad = rejected(checked, rules, repeated=counts["repeated_keys"])
        labels = {
            "_dq_stage": F.lit(stage),
            "_dq_run_id": F.lit(run_id),
            "_dq_odate": F.lit(odate).cast("date"),
            "_dq_checked_at": F.lit(checked_at).cast("timestamp"),
            "_dq_source_table": F.lit(source_name),
        }
        lake.append(mask_columns(bad).withColumns(labels), QUARANTINE_LAYER, quarantine)
    return verdict(input_rows, counts["checked_rows"], counts["quarantined_rows"], None)


def metric_rows(
    lake: Lake,
    verdicts: list[TableVerdict],
    stage: str,
    odate: date,
    run_id: str,
    checked_at: datetime,
) -> DataFrame:
    """One metrics row per table; the summary is JSON text without NULL fields."""
    fields = [f for f in METRICS_SCHEMA.fields if f.name != "violation_summary"]
    facts = StructType(
        [
            *fields,
            StructField("reason", StringType()),
            StructField("bad", LongType()),
            StructField("removed", LongType()),
        ]
    )
    rows = [
        {
            "checked_at": checked_at,
            "dq_run_id": run_id,
            "dq_stage": stage,
            "source_table": v.source_table,
            "quarantine_table": v.quarantine_table,
            "input_rows": v.input_rows,
            "valid_rows": v.valid_rows,
            "quarantined_rows": v.quarantined_rows,
            "status": "PASSED" if v.passed else "FAILED",
            "odate": odate,
            "checked_rows": v.checked_rows,
            "reason": v.reason,
            "bad": v.quarantined_rows if v.reason is None else None,
            "removed": v.removed_by_cleaning if v.input_rows else None,
        }
        for v in verdicts
    ]
    summary = F.to_json(
        F.struct(
            "reason",
            F.col("bad").alias("quarantined_rows"),
            F.col("removed").alias("removed_by_cleaning"),
        )
    )
    return (
        lake.spark.createDataFrame(rows, facts)
        .withColumn("violation_summary", summary)
        .select(*METRICS_SCHEMA.names)
    )


def run_gate(
    lake: Lake,
    stage: str,
    odate: date,
    run_id: str,
    as_of: datetime | None = None,
    revoke_on_failure: bool = False,
) -> list[TableVerdict]:
    """Check the five tables, append metrics, then approve the date or raise.

    Metrics are written before any failure is raised. An approval given earlier
    stays valid after a failing rerun unless ``revoke_on_failure`` is set.
    """
    checked_at = as_of or datetime.now(timezone.utc)
    lake.ensure_table(CONTROL_LAYER, METRICS_TABLE, METRICS_SCHEMA)
    lake.ensure_keyed(CONTROL_LAYER, APPROVAL_TABLE, APPROVAL_SCHEMA)
    verdicts = [
        check_table(lake, stage, entity, odate, run_id, checked_at, as_of) for entity in ENTITIES
    ]
    metrics = metric_rows(lake, verdicts, stage, odate, run_id, checked_at)
    lake.append(metrics, CONTROL_LAYER, METRICS_TABLE)

    problems = [v.problem for v in verdicts if not v.passed]
    if problems:
        if revoke_on_failure:
            record_approval(lake, stage, odate, run_id, None)
        raise GateRejected(
            f"gate {stage} for odate={odate.isoformat()} failed, nothing was promoted: "
            + "; ".join(problems)
        )
    record_approval(lake, stage, odate, run_id, checked_at)
    return verdicts


def record_approval(
    lake: Lake, stage: str, odate: date, run_id: str, at: datetime | None
) -> None:
    """Upsert the approval of (stage, date); ``at=None`` revokes it."""
    row = [{"dq_run_id": run_id, "approved_at": at, "dq_stage": stage, "odate": odate}]
    frame = lake.spark.createDataFrame(row, APPROVAL_SCHEMA)
    lake.upsert(frame, CONTROL_LAYER, APPROVAL_TABLE, APPROVAL_KEYS, APPROVAL_SCHEMA)


def approvals(lake: Lake) -> DataFrame:
    """Valid approvals, one row per (stage, date)."""
    latest = lake.current(CONTROL_LAYER, APPROVAL_TABLE, APPROVAL_KEYS)
    stored = latest.where(F.col("approved_at").isNotNull())
    return stored.select("dq_stage", "odate", "dq_run_id", "approved_at")


def require_approval(lake: Lake, stage: str, odate: date) -> str:
    """The run that has approved the date, or an error."""
    if not lake.exists(CONTROL_LAYER, APPROVAL_TABLE):
        raise NotApproved(
            f"control table {lake.name(CONTROL_LAYER, APPROVAL_TABLE)} does not exist"
        )
    wanted = (F.col("dq_stage") == stage) & (F.col("odate") == F.lit(odate))
    # One row at most: the table is keyed by stage and date.
    found = approvals(lake).where(wanted).first()
    if found is None:
        raise NotApproved(f"odate={odate.isoformat()} is not approved for stage {stage}")
    return found["dq_run_id"]
