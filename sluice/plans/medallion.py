"""The batch refresh of one business date: Bronze, gate, Silver, gate, Gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.model import BUSINESS_DATE, ENTITIES
from sluice.operators.cleaning import clean, snapshot_of
from sluice.operators.kpi import daily_kpi
from sluice.operators.reconcile import sanitize_snapshots
from sluice.plans.gate import require_approval, run_gate, staged_rows
from sluice.plans.rulebook import BEFORE_GOLD, BEFORE_SILVER
from sluice.sources.raw import read_raw_csv
from sluice.sources.tables import Lake

KPI_TABLE = "kpi_hospital_daily"


def ingest_bronze(lake: Lake, raw_root: str, odate: date, as_of: datetime | None = None) -> None:
    for entity in ENTITIES:
        raw = read_raw_csv(lake.spark, raw_root, entity, odate, as_of)
        lake.replace_partition(raw, "bronze", entity, odate)


def silver_rows(lake: Lake, entity: str, odate: date) -> DataFrame:
    return clean(snapshot_of(lake.read("bronze", entity), odate), entity)


def promote_silver(lake: Lake, odate: date) -> None:
    """The rows that the approving run has checked; cleaned again if a later run replaced them."""
    run_id = require_approval(lake, BEFORE_SILVER, odate)
    for entity in ENTITIES:
        rows = staged_rows(lake, entity, odate, run_id)
        if rows is None:
            rows = silver_rows(lake, entity, odate)
        lake.replace_partition(rows, "silver", entity, odate)


def gold_rows(lake: Lake, entity: str, odate: date) -> DataFrame:
    """The published columns only: no lineage and no direct identifiers."""
    return lake.partition("silver", entity, odate).select(*ENTITIES[entity].published)


def kpi_rows(lake: Lake, odate: date) -> DataFrame:
    return daily_kpi(
        lake.partition("gold", "attendance", odate), lake.partition("gold", "hospitals", odate)
    )


def publish_gold(lake: Lake, odate: date) -> None:
    """Entities first: the figures are computed from the Gold rows just written."""
    require_approval(lake, BEFORE_GOLD, odate)
    for entity in ENTITIES:
        lake.replace_partition(gold_rows(lake, entity, odate), "gold", entity, odate)
    lake.replace_partition(kpi_rows(lake, odate), "gold", KPI_TABLE, odate)


def sanitize_into(
    lake: Lake,
    snapshots: Mapping[str, DataFrame],
    odate: date,
    position: Sequence[str] = ("created_at",),
    as_of: datetime | None = None,
    layer: str = "sanitized",
) -> None:
    """The five sanitised snapshots of one date, each written once and read by those behind it."""

    def keep(rows: DataFrame, name: str) -> DataFrame:
        dated = rows.withColumn(BUSINESS_DATE, F.lit(odate).cast("date"))
        lake.replace_partition(dated, layer, name, odate)
        return lake.partition(layer, name, odate).drop(BUSINESS_DATE)

    sanitize_snapshots(snapshots, position, as_of, keep)


def refresh(
    lake: Lake, raw_root: str, odate: date, run_id: str, as_of: datetime | None = None
) -> None:
    """All five steps; the first rejected gate ends the run."""
    ingest_bronze(lake, raw_root, odate, as_of)
    run_gate(lake, BEFORE_SILVER, odate, run_id, as_of)
    promote_silver(lake, odate)
    run_gate(lake, BEFORE_GOLD, odate, run_id, as_of)
    publish_gold(lake, odate)
