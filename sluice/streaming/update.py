"""One streaming update: drain the source into Bronze, quarantine, Silver, late events, Gold.

Each is a query of its own with its own checkpoint, so a fatal event stops Silver and what follows it
only. A run takes what is available and ends; a restart continues from the checkpoints.

Late events and Gold are written per micro-batch, under the number of the batch: a batch that is run
again replaces what it wrote the first time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.checks import ERRORS, rejected, rule_outcomes
from sluice.operators.clustering import laid_out
from sluice.operators.rules import row_rules
from sluice.sources.tables import Lake
from sluice.streaming.contract import (
    ACCEPTED_LATENESS,
    CLOCK_SKEW,
    QUARANTINE_FIELDS,
    SILVER_FIELDS,
    event_rules,
)
from sluice.streaming.events import (
    bronze_rows,
    parsed_rows,
    require_disk_state,
    silver_rows,
    valid_rows,
)
from sluice.streaming.journal import OUTCOMES, WRITTEN, drained, log_rows, timeline_row
from sluice.streaming.measures import (
    patient_5m,
    patient_5m_of,
    population_hourly,
    population_hourly_of,
    stored_partials,
)

BRONZE = ("bronze", "vital_events_raw")
QUARANTINE = ("quarantine", "vital_events")
SILVER = ("silver", "vital_events")
LATE = ("quarantine", "vital_events_late")
PARTIALS = ("gold", "vital_partials")
PATIENT_5M = ("gold", "vital_patient_5m")
POPULATION_HOURLY = ("gold", "vital_population_hourly")
RULE_COUNTS = ("observability", "vital_rule_counts")
EVENT_LOG = ("observability", "vital_pipeline_events")
TIMELINE = ("observability", "pipeline_update_timeline")

# The columns that each table is laid out by.
LAYOUT = {
    BRONZE: ("eventhub_partition", "eventhub_enqueued_at"),
    SILVER: ("event_time", "patient_id"),
}
DAY = {BRONZE: "eventhub_enqueued_at_date", SILVER: "event_time_date"}
COPY = "_laid_out"
ROWS_PER_FILE = 1_000_000
# Rows below which a task that lays out rows is not worth its start.
ROWS_PER_TASK = 20_000

# Upper bound of files per micro-batch; it also bounds the rows of one hot event id.
MAX_FILES = 1_000


@dataclass(frozen=True)
class VitalStream:
    """The stream's tables in ``lake``; ``checkpoints`` is a shared folder.

    A micro-batch takes up to ``max_files`` files or, if given, up to ``max_bytes``
    (one file at least).
    """

    lake: Lake
    checkpoints: str
    max_files: int = MAX_FILES
    pipeline_id: str = "vitals"
    max_bytes: int | None = None

    def _follow(self, layer: str, table: str) -> DataFrame:
        reader = self.lake.spark.readStream
        if self.max_bytes is None:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        else:
            reader = reader.option("maxBytesPerTrigger", self.max_bytes)
        return reader.table(self.lake.name(layer, table))

    def _start(self, rows: DataFrame, target: tuple[str, str], day: str) -> StreamingQuery:
        """Append to a table split by the day of ``day``, exactly once per checkpoint."""
        self.lake.ensure_layer(target[0])
        flow = "_".join(target)
        dated = rows.withColumn(f"{day}_date", F.col(day).cast("date"))
        counted = dated.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
        return (
            counted.writeStream.queryName(flow)
            .format(self.lake.fmt)
            .partitionBy(f"{day}_date")
            .outputMode("append")
            .option("checkpointLocation", f"{self.checkpoints}/{flow}")
            .trigger(availableNow=True)
            .toTable(self.lake.name(*target))
        )

    def start_bronze(self, records: DataFrame, as_of=None) -> StreamingQuery:
        return self._start(bronze_rows(records, as_of), BRONZE, "eventhub_enqueued_at")

    def start_quarantine(self) -> StreamingQuery:
        """Bad events with reasons; counts every rule in the query's progress."""
        rules = event_rules()
        counted = parsed_rows(self._follow(*BRONZE)).observe(
            OUTCOMES,
            F.count(F.lit(1)).alias("checked"),
            *(F.count_if(rule.failed).alias(rule.name) for rule in row_rules(rules)),
        )
        bad = rejected(counted, rules).select(*QUARANTINE_FIELDS, ERRORS)
        return self._start(bad, QUARANTINE, "eventhub_enqueued_at")

    def start_rule_counts(self) -> StreamingQuery:
        """Passed and failed events of each rule, kept under the number of the micro-batch.

        A batch that is run again replaces its counts, so they are exact.
        """
        return self._each_batch(self._follow(*BRONZE), RULE_COUNTS, self._count_rules)

    def _count_rules(self, rows: DataFrame, batch_id: int) -> None:
        counts = rule_outcomes(parsed_rows(rows), event_rules())
        numbered = counts.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        self.lake.replace_slices(numbered, *RULE_COUNTS, by=["batch_id"])

    def rule_counts(self) -> DataFrame:
        """Passed and failed events of each rule since the stream began."""
        stored = self.lake.read(*RULE_COUNTS)
        names = ("passed_records", "failed_records")
        return stored.groupBy("dq_rule").agg(*(F.sum(n).alias(n) for n in names))

    def start_silver(self) -> StreamingQuery:
        require_disk_state(self.lake.spark)
        return self._start(silver_rows(self._follow(*BRONZE)), SILVER, "event_time")

    def silver(self) -> DataFrame:
        return self.lake.read(*SILVER).select(*SILVER_FIELDS)

    def quarantine(self) -> DataFrame:
        return self.lake.read(*QUARANTINE).select(*QUARANTINE_FIELDS, ERRORS)

    def late(self) -> DataFrame:
        return self.lake.read(*LATE).select(*SILVER_FIELDS)

    def _each_batch(self, rows: DataFrame, target: tuple[str, str], write) -> StreamingQuery:
        flow = "_".join(target)
        return (
            rows.writeStream.queryName(flow)
            .option("checkpointLocation", f"{self.checkpoints}/{flow}")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )

    def start_late(self) -> StreamingQuery:
        """Valid events that Silver does not hold: it met them behind its watermark.

        Runs after Silver has taken all of Bronze.
        """
        return self._each_batch(self._follow(*BRONZE), LATE, self._keep_late)

    def _keep_late(self, rows: DataFrame, batch_id: int) -> None:
        valid = valid_rows(rows)
        # Valid events lie this near to their arrival, so nothing is parsed to find the days.
        queued = F.col("eventhub_enqueued_at")
        earliest = F.min(queued - F.expr(ACCEPTED_LATENESS)).cast("date")
        latest = F.max(queued + F.expr(CLOCK_SKEW)).cast("date")
        first, last = rows.agg(earliest, latest).first()
        if first is None:
            return
        held = self.lake.read(*SILVER).where(F.col("event_time_date").between(first, last))
        late = valid.join(held.select("event_id"), "event_id", "left_anti")
        kept = late.dropDuplicates(["event_id"]).select(*SILVER_FIELDS)
        numbered = kept.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        self.lake.replace_slices(numbered, *LATE, by=["batch_id"])

    def start_gold(self) -> StreamingQuery:
        """Both aggregates of the days that new Silver rows fall into."""
        return self._each_batch(self._follow(*SILVER), PARTIALS, self._fold)

    def _fold(self, rows: DataFrame, batch_id: int) -> None:
        """Store the new rows' partial aggregates, then merge those of their days.

        Nothing but the new rows and the touched days' partial rows is read.
        """
        parts = _dated(stored_partials(rows)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        slices = self.lake.replace_slices(parts, *PARTIALS, by=["window_date", "batch_id"])
        days = sorted({values["window_date"] for values in slices})
        if days:
            touched = self.lake.read(*PARTIALS).where(F.col("window_date").isin(*days))
            self._publish(patient_5m_of(touched), population_hourly_of(touched))

    def refresh_gold(self, since: date | None = None) -> None:
        """Recompute both aggregates from Silver, or only the days from ``since`` on.

        Windows tile the UTC day, so replacing whole days is exact.
        """
        events = self.lake.read(*SILVER)
        if since is not None:
            events = events.where(F.col("event_time_date") >= F.lit(since))
        self._publish(patient_5m(events), population_hourly(events))

    def _publish(self, patients: DataFrame, population: DataFrame) -> None:
        for rows, target in ((patients, PATIENT_5M), (population, POPULATION_HOURLY)):
            self.lake.replace_slices(_dated(rows), *target, by=["window_date"])

    # -- layout of closed days ---------------------------------------------

    def lay_out(
        self, table: tuple[str, str], before: date, rows_per_file: int = ROWS_PER_FILE
    ) -> list[date]:
        """Copies of a table's days before ``before``, in files with narrow ranges.

        The stream keeps writing its own files in the order of arrival. Days whose copy
        is up to date are left alone; returns the days that were copied. Files are only
        skipped by time if ``spark.sql.parquet.outputTimestampType`` is not INT96.
        """
        layer, name = table
        day = DAY[table]
        stored = self.lake.read(layer, name)
        counts = {d: n for d, n in _by_day(stored, day) if d is not None and d < before}
        copied = self._copied(table)
        changed = sorted(d for d, n in counts.items() if copied.get(d) != n)
        for when in changed:
            rows = stored.where(F.col(day) == F.lit(when))
            # A task writes several files if they are small: their number is no number of tasks.
            tasks = max(1, -(-counts[when] // max(rows_per_file, ROWS_PER_TASK)))
            self.lake.replace_slice(
                laid_out(rows, LAYOUT[table], tasks), layer, name + COPY, {day: when}, rows_per_file
            )
        return changed

    def _copied(self, table: tuple[str, str]) -> dict[date, int]:
        layer, name = table
        if not self.lake.exists(layer, name + COPY):
            return {}
        return dict(_by_day(self.lake.read(layer, name + COPY), DAY[table]))

    def history(self, table: tuple[str, str]) -> DataFrame:
        """All rows of a table, days with an up-to-date copy from there."""
        layer, name = table
        day = DAY[table]
        stored = self.lake.read(layer, name)
        copied = self._copied(table)
        counts = dict(_by_day(stored.where(F.col(day).isin(*copied)), day)) if copied else {}
        current = [d for d, n in copied.items() if counts.get(d) == n]
        if not current:
            return stored
        rest = stored.where(F.col(day).isNull() | ~F.col(day).isin(*current))
        copies = self.lake.read(layer, name + COPY).where(F.col(day).isin(*current))
        return rest.unionByName(copies)

    def run(self, records: DataFrame, as_of=None) -> str:
        """A whole update; returns its id.

        Raises if Silver met a bad event, after quarantining it. Either way the
        update is entered into the event log and the timeline.
        """
        _require_utc(self.lake.spark)
        update_id = uuid.uuid4().hex
        started = datetime.now(timezone.utc)
        queries: dict[str, StreamingQuery] = {}
        batches: dict[str, list] = {}
        state = "FAILED"

        def finish(flow: str, query: StreamingQuery) -> None:
            queries[flow] = query
            batches[flow] = drained(query)
            query.awaitTermination()

        try:
            finish("bronze", self.start_bronze(records, as_of))
            finish("quarantine", self.start_quarantine())
            self.start_rule_counts().awaitTermination()
            finish("silver", self.start_silver())
            # The journal has no entries of these; a failure of theirs is the caller's.
            for follower in (self.start_late(), self.start_gold()):
                follower.awaitTermination()
            state = "COMPLETED"
        finally:
            self._journal(queries, batches, update_id, started, state)
        return update_id

    def _journal(
        self,
        queries: dict[str, StreamingQuery],
        batches: dict[str, list],
        update_id: str,
        started: datetime,
        state: str,
    ) -> None:
        spark, finished = self.lake.spark, datetime.now(timezone.utc)
        tables = {"bronze": BRONZE, "quarantine": QUARANTINE, "silver": SILVER}
        names = {flow: ".".join(table) for flow, table in tables.items()}
        if queries:
            entries = log_rows(
                spark, queries, batches, names, self.pipeline_id, update_id, finished
            )
            self.lake.append(entries, *EVENT_LOG)
        slice_row = timeline_row(spark, self.pipeline_id, update_id, started, finished, state)
        self.lake.append(slice_row, *TIMELINE)


def _by_day(rows: DataFrame, day: str) -> list[tuple[date, int]]:
    """Rows of each day, a partition column; rows are only added, so a count shows a change."""
    return [tuple(r) for r in rows.groupBy(day).agg(F.count(F.lit(1)).alias("n")).collect()]


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window_date", F.col("window_start").cast("date"))


def _require_utc(spark: SparkSession) -> None:
    """Days and windows are those of UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"the session's time zone must be UTC, not {zone}")
