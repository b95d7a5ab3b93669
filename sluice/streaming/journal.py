"""The update's own event log and timeline, in the shape the monitoring datasets read."""

from __future__ import annotations

import json
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names of the metrics observed in the flows.
WRITTEN = "written_rows"
OUTCOMES = "rule_outcomes"

EVENT_LOG_SCHEMA = StructType(
    [
        StructField(
            "origin",
            StructType(
                [
                    StructField(name, StringType())
                    for name in ("update_id", "pipeline_id", "flow_name", "dataset_name")
                ]
            ),
        ),
        StructField("event_type", StringType()),
        StructField("timestamp", TimestampType()),
        StructField("details", StringType()),
    ]
)
TIMELINE_SCHEMA = StructType(
    [
        StructField("pipeline_id", StringType()),
        StructField("update_id", StringType()),
        StructField("period_start_time", TimestampType()),
        StructField("period_end_time", TimestampType()),
        StructField("result_state", StringType()),
    ]
)


def observed(progress, name: str) -> dict[str, int] | None:
    """One observed metric of a micro-batch's progress as a dict."""
    found = (progress["observedMetrics"] or {}).get(name)
    if found is None:
        return None
    return found.asDict() if hasattr(found, "asDict") else dict(found)


def drained(query: StreamingQuery, every: float = 0.1) -> list:
    """Wait for the end of a query and return the progress of all its micro-batches.

    The query itself keeps only its latest entries, so they are picked up while it runs, by batch
    id. A batch id missing between two others would mean lost counts and fails.
    """
    batches: dict[int, object] = {}
    while query.isActive:
        batches.update((p["batchId"], p) for p in query.recentProgress)
        # A failure is left to the caller, who still needs the counts.
        time.sleep(every)
    batches.update((p["batchId"], p) for p in query.recentProgress)
    ids = sorted(batches)
    if ids and ids != list(range(ids[0], ids[-1] + 1)):
        raise RuntimeError(f"progress of {query.name} has gaps; counters would be short")
    return [batches[i] for i in ids]


def rule_outcomes(batches: list) -> dict[str, dict[str, int]]:
    """Passed and failed events per rule, added up over the given micro-batches.

    Progress counters serve monitoring: a retried task may be counted twice. Exact
    counts come from ``operators.checks.rule_outcomes`` over the stored rows.
    """
    totals: dict[str, dict[str, int]] = {}
    for progress in batches:
        values = observed(progress, OUTCOMES)
        if values is None:
            continue
        checked = values.pop("checked")
        for rule, failed in values.items():
            total = totals.setdefault(rule, {"passed_records": 0, "failed_records": 0})
            total["passed_records"] += checked - failed
            total["failed_records"] += failed
    return totals


def _details(batches: list, dataset: str, status: str) -> str:
    written = [observed(p, WRITTEN) for p in batches]
    dropped = [
        operator["numRowsDroppedByWatermark"]
        for progress in batches
        for operator in progress["stateOperators"]
    ]
    expectations = [
        {"name": rule, "dataset": dataset, **counts}
        for rule, counts in rule_outcomes(batches).items()
    ]
    quality = {"dropped_records": sum(dropped), "expectations": expectations}
    return json.dumps(
        {
            "flow_progress": {
                "status": status,
                "metrics": {"num_output_rows": sum(w["rows"] for w in written if w)},
                "data_quality": quality,
            }
        }
    )


def log_rows(
    spark: SparkSession,
    queries: dict[str, StreamingQuery],
    batches: dict[str, list],
    datasets: dict[str, str],
    pipeline_id: str,
    update_id: str,
    at: datetime,
) -> DataFrame:
    """One ``flow_progress`` entry per flow of an update."""
    rows = [
        {
            "origin": {
                "update_id": update_id,
                "pipeline_id": pipeline_id,
                "flow_name": flow,
                "dataset_name": datasets[flow],
            },
            "event_type": "flow_progress",
            "timestamp": at,
            "details": _details(
                batches.get(flow, []),
                datasets[flow],
                "FAILED" if query.exception() else "COMPLETED",
            ),
        }
        for flow, query in queries.items()
    ]
    return spark.createDataFrame(rows, EVENT_LOG_SCHEMA)


def timeline_row(
    spark: SparkSession,
    pipeline_id: str,
    update_id: str,
    started: datetime,
    finished: datetime,
    state: str,
) -> DataFrame:
    row = (pipeline_id, update_id, started, finished, state)
    return spark.createDataFrame([row], TIMELINE_SCHEMA)
