"""Event-stream queries: batch forms of each step and real streaming runs."""

from __future__ import annotations

from datetime import date

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.checks import ERRORS, rule_outcomes
from sluice.session import scratch_path
from sluice.streaming.contract import (
    PAYLOAD_FIELDS,
    SILVER_FIELDS,
    event_rules,
)
from sluice.streaming.events import (
    ROCKSDB,
    STATE_PROVIDER,
    bronze_rows,
    classified_rows,
    parsed_rows,
    producer_breaches,
    quarantined_rows,
    silver_rows,
    valid_rows,
    with_abnormal_flag,
)
from sluice.streaming.journal import drained
from sluice.streaming.measures import patient_5m, population_hourly
from sluice.streaming.update import SILVER, VitalStream
from sluice.streaming.publish import to_records
from workload.derive import DERIVED, Spark, frame, load, sql
from workload.lake import fresh_lake
from workload.registry import error_list, half_up, register


def bronze(spark, sf_dir) -> DataFrame:
    records = frame(spark, sf_dir, "records")
    return bronze_rows(records, as_of=F.col("arrived"))


BRONZE_SQL = (
    "SELECT \"key\" AS event_key, \"value\" AS raw_payload, topic AS eventhub_name, "
    "\"partition\" AS eventhub_partition, \"offset\" AS eventhub_offset, "
    "\"timestamp\" AS eventhub_enqueued_at, arrived AS ingested_at, "
    f"sha256(\"value\") AS payload_sha256 FROM ({sql('records')}) r"
)
_COORDINATES = "eventhub_partition, eventhub_offset, eventhub_enqueued_at, ingested_at, payload_sha256"


def _field(name: str, kind: str) -> str:
    return f"TRY_CAST(j->>'$.{name}' AS {kind})"


_TYPED = ", ".join(
    f"{e} AS {n}"
    for n, e in {
        "schema_version": _field("schema_version", "INT"),
        "event_id": "lower(trim(j->>'$.event_id'))",
        "event_type": "trim(j->>'$.event_type')",
        "patient_id": _field("patient_id", "BIGINT"),
        "heart_rate_bpm": _field("heart_rate_bpm", "INT"),
        "oxygen_saturation_pct": _field("oxygen_saturation_pct", "DOUBLE"),
        "temperature_c": _field("temperature_c", "DOUBLE"),
        "blood_pressure_systolic_mmhg": _field("blood_pressure_systolic_mmhg", "INT"),
        "blood_pressure_diastolic_mmhg": _field("blood_pressure_diastolic_mmhg", "INT"),
        "event_time": "TRY_CAST(trim(j->>'$.event_time') AS TIMESTAMP)",
        "produced_at": "TRY_CAST(trim(j->>'$.produced_at') AS TIMESTAMP)",
        "producer_run_id": "lower(trim(j->>'$.producer_run_id'))",
        "source": "trim(j->>'$.source')",
        "_event_time_raw": "trim(j->>'$.event_time')",
        "_produced_at_raw": "trim(j->>'$.produced_at')",
        "_keys": "json_keys(j)",
    }.items()
)
PARSED_SQL = (
    f"SELECT *, {_TYPED} FROM (SELECT *, CASE WHEN json_valid(raw_payload) THEN raw_payload END AS j "
    f"FROM ({BRONZE_SQL}) b) v"
)
_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
_UTC = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?Z$"
_KNOWN = "[" + ", ".join(f"'{f}'" for f in PAYLOAD_FIELDS) + "]"
_QUEUED = "eventhub_enqueued_at"
EVENT_RULES_SQL = {
    "payload_parseable": "j IS NOT NULL AND _keys IS NOT NULL",
    "payload_fields_exact": f"len(_keys) = 13 AND len(list_intersect(_keys, {_KNOWN})) = 13",
    "schema_version_supported": "schema_version = 1",
    "event_type_supported": "event_type = 'patient_vital_signs'",
    "event_id_valid_uuid": f"regexp_matches(event_id, '{_UUID}')",
    "producer_run_id_valid_uuid": f"regexp_matches(producer_run_id, '{_UUID}')",
    "patient_id_positive": "patient_id > 0",
    "event_time_utc_format": f"regexp_matches(_event_time_raw, '{_UTC}')",
    "event_time_present": "event_time IS NOT NULL",
    "produced_at_utc_format": f"regexp_matches(_produced_at_raw, '{_UTC}')",
    "produced_at_present": "produced_at IS NOT NULL",
    "event_time_not_future": f"event_time <= {_QUEUED} + INTERVAL 5 MINUTE",
    "event_time_not_stale": f"event_time >= {_QUEUED} - INTERVAL 24 HOUR",
    "produced_at_not_future": f"produced_at <= {_QUEUED} + INTERVAL 5 MINUTE",
    "produced_at_not_stale": f"produced_at >= {_QUEUED} - INTERVAL 24 HOUR",
    "event_precedes_production": "event_time <= produced_at + INTERVAL 5 MINUTE",
    "heart_rate_in_range": "heart_rate_bpm BETWEEN 30 AND 220",
    "oxygen_saturation_in_range": "oxygen_saturation_pct BETWEEN 50 AND 100",
    "temperature_in_range": "temperature_c BETWEEN 30 AND 45",
    "systolic_pressure_in_range": "blood_pressure_systolic_mmhg BETWEEN 60 AND 250",
    "diastolic_pressure_in_range": "blood_pressure_diastolic_mmhg BETWEEN 30 AND 150",
    "systolic_above_diastolic": "blood_pressure_systolic_mmhg > blood_pressure_diastolic_mmhg",
    "source_present": "length(source) > 0",
}
CLASSIFIED_SQL = f"SELECT *, {error_list(EVENT_RULES_SQL)} AS _dq_errors FROM ({PARSED_SQL}) p"
QUARANTINE_SQL = (
    f"SELECT raw_payload, eventhub_name, {_COORDINATES}, event_id, patient_id, producer_run_id, "
    f"_dq_errors FROM ({CLASSIFIED_SQL}) c WHERE _dq_errors <> ''"
)
SILVER_SQL = f"SELECT {', '.join(SILVER_FIELDS)} FROM ({CLASSIFIED_SQL}) c WHERE _dq_errors = ''"
_ABNORMAL = (
    "(heart_rate_bpm < 50 OR heart_rate_bpm > 120 OR oxygen_saturation_pct < 92 "
    "OR temperature_c < 35.5 OR temperature_c > 38.0 OR blood_pressure_systolic_mmhg > 180 "
    "OR blood_pressure_diastolic_mmhg > 120)"
)


def _named(errors: DataFrame, column: str = ERRORS) -> DataFrame:
    return errors.withColumn(column, F.array_join(column, ","))


register("event_bronze", bronze, BRONZE_SQL)
register(
    "event_classified",
    lambda s, d: _named(classified_rows(bronze(s, d))).select(
        "eventhub_offset", "event_id", "event_time", "produced_at", "patient_id", ERRORS
    ),
    "SELECT eventhub_offset, event_id, event_time, produced_at, patient_id, _dq_errors "
    f"FROM ({CLASSIFIED_SQL}) c",
)
register("event_quarantine", lambda s, d: _named(quarantined_rows(bronze(s, d))), QUARANTINE_SQL)
register("event_silver", lambda s, d: valid_rows(bronze(s, d)), SILVER_SQL)
OUTCOMES_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS dq_rule, count(*) FILTER (WHERE coalesce({p}, false)) AS passed_records, "
    f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed_records FROM ({PARSED_SQL}) p"
    for n, p in EVENT_RULES_SQL.items()
)
register(
    "event_rule_outcomes",
    lambda s, d: rule_outcomes(parsed_rows(bronze(s, d)), event_rules()),
    OUTCOMES_SQL,
)
_PRODUCER_SQL = {
    "heart_rate_produced": "heart_rate_bpm BETWEEN 40 AND 180",
    "oxygen_saturation_produced": "oxygen_saturation_pct BETWEEN 70 AND 100",
    "temperature_produced": "temperature_c BETWEEN 35 AND 41",
    "systolic_pressure_produced": "blood_pressure_systolic_mmhg BETWEEN 90 AND 180",
    "diastolic_pressure_produced": "blood_pressure_diastolic_mmhg BETWEEN 60 AND 120",
    "oxygen_saturation_whole": "oxygen_saturation_pct = floor(oxygen_saturation_pct)",
}
register(
    "producer_breaches",
    lambda s, d: _named(producer_breaches(bronze(s, d)), "_producer_errors"),
    f"SELECT * FROM (SELECT *, {error_list(_PRODUCER_SQL)} AS _producer_errors "
    f"FROM ({SILVER_SQL}) s) x WHERE _producer_errors <> ''",
)
register(
    "event_abnormal",
    lambda s, d: with_abnormal_flag(valid_rows(bronze(s, d))).select("event_id", "is_abnormal"),
    f"SELECT event_id, {_ABNORMAL} AS is_abnormal FROM ({SILVER_SQL}) s",
)


def _windowed_sql(width: str, key: str, measures: str, last: str = "") -> str:
    return (
        f"SELECT {key}window_start, window_start + INTERVAL {width} AS window_end, {measures}, "
        f"abnormal_count, {half_up('CAST(abnormal_count AS DOUBLE) / n', 4)} AS abnormal_rate{last} "
        f"FROM (SELECT {key}time_bucket(INTERVAL {width}, event_time) AS window_start, "
        "count(event_id) AS n, count(DISTINCT patient_id) AS people, avg(heart_rate_bpm) AS hr, "
        "min(oxygen_saturation_pct) AS low, avg(oxygen_saturation_pct) AS ox, "
        "avg(temperature_c) AS temp, avg(blood_pressure_systolic_mmhg) AS sys, "
        "avg(blood_pressure_diastolic_mmhg) AS dia, "
        f"CAST(sum(CAST({_ABNORMAL} AS INT)) AS BIGINT) AS abnormal_count, max(event_time) AS seen "
        f"FROM ({SILVER_SQL}) s GROUP BY ALL) w"
    )


PATIENT_5M_SQL = _windowed_sql(
    "5 MINUTE",
    "patient_id, ",
    f"n AS measurement_count, {half_up('hr', 2)} AS avg_heart_rate_bpm, "
    f"low AS min_oxygen_saturation_pct, {half_up('temp', 2)} AS avg_temperature_c, "
    f"{half_up('sys', 2)} AS avg_systolic_mmhg, {half_up('dia', 2)} AS avg_diastolic_mmhg",
    ", seen AS last_event_time",
)
HOURLY_SQL = _windowed_sql(
    "1 HOUR",
    "",
    f"n AS event_count, people AS patient_count, {half_up('hr', 2)} AS avg_heart_rate_bpm, "
    f"{half_up('ox', 2)} AS avg_oxygen_saturation_pct, {half_up('temp', 2)} AS avg_temperature_c",
)
register("vitals_patient_5m", lambda s, d: patient_5m(valid_rows(bronze(s, d))), PATIENT_5M_SQL)
register(
    "vitals_population_hourly",
    lambda s, d: population_hourly(valid_rows(bronze(s, d))),
    HOURLY_SQL,
)
register(
    "event_records",
    lambda s, d: to_records(load(s, d, "events").withColumnRenamed("user_id", "patient_id")),
    "SELECT CAST(user_id AS VARCHAR) AS key, '{\"event_id\":' || event_id || ',\"ts\":\"' || "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' "
    "ELSE strftime(ts, '.%f') END || 'Z\",\"patient_id\":' || user_id || ',\"event_type\":\"' "
    "|| event_type || '\",\"value\":' || CAST(value AS VARCHAR) || ',\"props\":\"' || "
    "replace(props, '\"', '\\\"') || '\"}' AS value FROM events",
)


# -- streaming runs --------------------------------------------------------


def _record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream of broker records."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A pattern, because a stream accepts a single file only through one.
    path = f"{sf_dir}/events.parque[t]"
    columns = DERIVED["records"](Spark)[1]
    events = spark.readStream.schema(schema).parquet(path)
    return events.selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def _bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(_record_stream(spark, sf_dir), as_of=F.col("arrived"))


def _drained(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Run the stream to its end into the shared folder and read the result."""
    home = scratch_path(spark, label)
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{home}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{home}/rows")


#: Files per core that a landing of records has: enough for all cores to end at about the same time.
_FILES_PER_CORE = 4


def _spread_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``bronze``, made by all cores from a few files with few row groups.

    The events are dealt out, by a hash of all columns that needs no sort, before the texts are made.
    """
    columns = DERIVED["records"](Spark)[1]
    events = load(spark, sf_dir, "events")
    parts = _FILES_PER_CORE * spark.sparkContext.defaultParallelism
    dealt = events.repartition(parts, *events.columns)
    records = dealt.selectExpr(*(f"{e} AS `{c}`" for c, e in columns.items()))
    return bronze_rows(records, as_of=F.col("arrived"))


def _valid_records(spark: SparkSession, sf_dir: str, update: str = "0") -> DataFrame:
    """The broker records whose events break no rule, made and checked once and stored.

    ``update`` is an expression over the checked event: the number of the update it comes with.
    """
    folder = scratch_path(spark, "valid-records")
    valid = classified_rows(_spread_bronze(spark, sf_dir)).where(F.size(ERRORS) == 0)
    records = _as_records(valid, F.expr(update).cast("int").alias("update"))
    records.write.parquet(folder)
    return spark.read.schema(records.schema).parquet(folder)


def _as_records(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(
        F.col("event_key").alias("key"),
        F.col("raw_payload").alias("value"),
        F.col("eventhub_name").alias("topic"),
        F.col("eventhub_partition").alias("partition"),
        F.col("eventhub_offset").alias("offset"),
        F.col("eventhub_enqueued_at").alias("timestamp"),
        F.col("ingested_at").alias("arrived"),
        *more,
    )


def _of_update(records: DataFrame, number: int) -> DataFrame:
    return records.where(F.col("update") == number).drop("update")


class _Landing:
    """A folder of broker records that grows between updates of one stream."""

    def __init__(self, spark: SparkSession, label: str, **options):
        # The stream keeps its ids in RocksDB and does not start without it.
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
        self.spark = spark
        self.folder = scratch_path(spark, f"{label}-records")
        lake = fresh_lake(spark, label)
        self.stream = VitalStream(lake, scratch_path(spark, f"{label}-checkpoints"), **options)

    def land(self, records: DataFrame) -> DataFrame:
        """The stream of all that has landed, these records included."""
        records.write.mode("append").parquet(self.folder)
        return self.spark.readStream.schema(records.schema).parquet(self.folder)

    def run(self, records: DataFrame) -> None:
        self.stream.run(self.land(records), as_of=F.col("arrived"))

    def drain(self, records: DataFrame, follow) -> None:
        """Bronze, Silver and one flow behind them."""
        self.stream.start_bronze(self.land(records), F.col("arrived")).awaitTermination()
        self.stream.start_silver().awaitTermination()
        if follow is not None:
            follow().awaitTermination()


def stream_silver(spark, sf_dir) -> DataFrame:
    """Every valid event arrives twice and is kept once, through the rows of a Silver update."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    folder = scratch_path(spark, "stream-silver-records")
    records = _valid_records(spark, sf_dir).drop("update")
    records.union(records).write.parquet(folder)
    source = spark.readStream.schema(records.schema).parquet(folder)
    rows = silver_rows(bronze_rows(source, as_of=F.col("arrived")))
    return _drained(spark, rows, "stream-silver")


_FIRST_SQL = f"SELECT DISTINCT ON (event_id) * FROM ({SILVER_SQL}) f"
register("stream_silver", stream_silver, _FIRST_SQL)
register(
    "stream_quarantine",
    lambda s, d: _drained(
        s, _named(quarantined_rows(_bronze_stream(s, d))), "stream-quarantine"
    ),
    QUARANTINE_SQL,
)
register(
    "stream_bronze",
    lambda s, d: _drained(s, _bronze_stream(s, d), "stream-bronze"),
    BRONZE_SQL,
)
register(
    "stream_vitals_patient_5m",
    lambda s, d: patient_5m(stream_silver(s, d)),
    PATIENT_5M_SQL.replace(SILVER_SQL, _FIRST_SQL),
)

#: The moment that parts the updates of one stream, inside a day.
_CUT = "TIMESTAMP '2024-01-16 15:00:00'"
#: How long before it some events still come with the second update, within the watermark.
_OVERLAP = "INTERVAL 20 HOUR"


def _two_updates(spark, sf_dir, label: str) -> VitalStream:
    """All valid events in two updates; days before the cut get rows from both."""
    landing = _Landing(spark, label)
    second = (
        f"event_time >= {_CUT} OR (event_time >= {_CUT} - {_OVERLAP} AND eventhub_offset % 3 = 0)"
    )
    records = _valid_records(spark, sf_dir, f"CASE WHEN {second} THEN 1 ELSE 0 END")
    for number in range(2):
        landing.drain(_of_update(records, number), landing.stream.start_gold)
    return landing.stream


def stream_gold_patient_5m(spark, sf_dir) -> DataFrame:
    """Gold after an update that only reads and rewrites its own days."""
    stream = _two_updates(spark, sf_dir, "gold-patient")
    return stream.lake.read("gold", "vital_patient_5m").drop("window_date")


def stream_gold_hourly(spark, sf_dir) -> DataFrame:
    stream = _two_updates(spark, sf_dir, "gold-hourly")
    return stream.lake.read("gold", "vital_population_hourly").drop("window_date")


register("stream_gold_patient_5m", stream_gold_patient_5m, PATIENT_5M_SQL)
register("stream_gold_hourly", stream_gold_hourly, HOURLY_SQL)


def stream_late_events(spark, sf_dir) -> DataFrame:
    """Events before the cut come after those behind it: what the watermark shuts out."""
    landing = _Landing(spark, "late")
    update = f"CASE WHEN event_time < {_CUT} THEN 0 ELSE 1 + eventhub_offset % 2 END"
    records = _valid_records(spark, sf_dir, update)
    # The second update moves the watermark to 25 hours before its latest event.
    for number in range(3):
        landing.drain(_of_update(records, number), landing.stream.start_late)
    return landing.stream.late()


register(
    "stream_late_events",
    stream_late_events,
    f"WITH valid AS ({SILVER_SQL}) SELECT * FROM valid WHERE event_time >= {_CUT} "
    "AND eventhub_offset % 2 = 1 AND event_time < (SELECT max(event_time) FROM valid "
    f"WHERE event_time >= {_CUT} AND eventhub_offset % 2 = 0) - INTERVAL 25 HOUR",
)


def stream_fatal_event(spark, sf_dir) -> DataFrame:
    """Rows of each table after a good update and one with events that break rules."""
    landing = _Landing(spark, "fatal")
    classified = classified_rows(bronze(spark, sf_dir))
    first = f"event_time < {_CUT}"
    landing.run(_as_records(classified.where((F.size(ERRORS) == 0) & F.expr(first))))
    rest = classified.where((F.size(ERRORS) > 0) | ~F.coalesce(F.expr(first), F.lit(False)))
    try:
        landing.run(_as_records(rest))
    except StreamingQueryException:
        lake = landing.stream.lake
        counted = [
            lake.read(layer, name).agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("rows"))
            for layer, name in (
                ("bronze", "vital_events_raw"),
                ("quarantine", "vital_events"),
                ("silver", "vital_events"),
            )
        ]
        return counted[0].union(counted[1]).union(counted[2])
    raise AssertionError("an update with bad events went through")


register(
    "stream_fatal_event",
    stream_fatal_event,
    f"SELECT 'bronze' AS layer, count(*) AS rows FROM ({BRONZE_SQL}) b UNION ALL "
    f"SELECT 'quarantine', count(*) FROM ({QUARANTINE_SQL}) q UNION ALL "
    f"SELECT 'silver', count(*) FROM ({SILVER_SQL}) s WHERE event_time < {_CUT}",
)


def stream_bounded_batches(spark, sf_dir) -> DataFrame:
    """A drain of Bronze by bytes: its rows, and whether it took as many batches as the bound asks."""
    records = _valid_records(spark, sf_dir).drop("update")
    landing = _Landing(spark, "bounded")
    # Files well below the bound, whatever the size of the table.
    records.repartition(64).write.parquet(landing.folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    size = files.load(landing.folder).agg(F.sum("length")).first()[0]
    bound = size // 8
    source = spark.readStream.schema(records.schema).option("maxBytesPerTrigger", bound)
    batches = drained(
        landing.stream.start_bronze(source.parquet(landing.folder), F.col("arrived"))
    )
    taken = [b["numInputRows"] for b in batches if b["numInputRows"]]
    return landing.stream.lake.read("bronze", "vital_events_raw").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(taken) >= 8).alias("bounded")
    )


register(
    "stream_bounded_batches",
    stream_bounded_batches,
    f"SELECT count(*) AS rows, true AS bounded FROM ({SILVER_SQL}) s",
)


def stream_rule_outcomes(spark, sf_dir) -> DataFrame:
    """Rule counters of a stream in several micro-batches, one of them run twice."""
    landing = _Landing(spark, "outcomes", max_files=60)
    stream = landing.stream
    # Dealt out by a hash: a plain repartition sorts its rows, here with their texts.
    every = _as_records(_spread_bronze(spark, sf_dir))
    every.repartition(6, *every.columns).write.parquet(landing.folder)
    records = spark.read.parquet(landing.folder)
    source = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 2)
    stream.start_bronze(source.parquet(landing.folder), F.col("arrived")).awaitTermination()
    stream.start_rule_counts().awaitTermination()
    counts = stream.lake.read("observability", "vital_rule_counts")
    again = counts.where("batch_id = 0")
    stream.lake.replace_slices(again, "observability", "vital_rule_counts", by=["batch_id"])
    return stream.rule_counts()


register("stream_rule_outcomes", stream_rule_outcomes, OUTCOMES_SQL)


def stream_history_silver(spark, sf_dir) -> DataFrame:
    """Silver read through the laid out copies of its first days and the stream's own files."""
    landing = _Landing(spark, "history")
    landing.drain(_valid_records(spark, sf_dir).drop("update"), None)
    copied = landing.stream.lay_out(SILVER, date(2024, 1, 4), rows_per_file=100)
    if not copied:
        raise AssertionError("no day was laid out")
    return landing.stream.history(SILVER).select(*SILVER_FIELDS)


register("stream_history_silver", stream_history_silver, SILVER_SQL)
