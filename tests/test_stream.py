"""Event parsing, the 23 rules, and streaming runs from files."""

import json
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fixtures import START, event, record
from sluice.operators.checks import rule_outcomes as batch_outcomes
from sluice.session import scratch_path
from sluice.sources.broker import RECORD_DDL, consumer_options, read_replay
from sluice.sources.tables import Lake
from sluice.streaming.contract import EVENT_TYPE, PAYLOAD_FIELDS, SILVER_FIELDS, event_rules
from sluice.streaming.events import (
    STATE_PROVIDER,
    bronze_rows,
    classified_rows,
    first_copies,
    parsed_rows,
    producer_breaches,
    quarantined_rows,
    valid_rows,
)
from sluice.streaming.publish import publish_files, to_records
from sluice.plans.monitoring import expectation_metrics, flow_metrics, pipeline_updates
from sluice.streaming.journal import rule_outcomes
from sluice.streaming.measures import patient_5m, population_hourly
from sluice.streaming.update import VitalStream

QUEUED = START + timedelta(hours=1)


def bronze_of(spark, payloads, queued=QUEUED):
    rows = [record(p, i, queued) for i, p in enumerate(payloads)]
    return bronze_rows(spark.createDataFrame(rows, RECORD_DDL), datetime(2026, 1, 2))


def z(moment, micros=0):
    return (moment + timedelta(microseconds=micros)).isoformat() + "Z"


def at(moment, **more):
    return {"event_time": moment, "produced_at": moment, **more}


FIVE = QUEUED + timedelta(minutes=5)
STALE = QUEUED - timedelta(hours=24)
UUID = str(uuid.UUID(int=9, version=4))
# (changes to a good event, rules that must fail)
CASES = [
    ({}, []),
    ({"schema_version": 2}, ["schema_version_supported"]),
    ({"schema_version": None}, ["schema_version_supported"]),
    ({"event_type": "  patient_vital_signs "}, []),
    ({"event_type": "other"}, ["event_type_supported"]),
    ({"event_id": UUID.upper()}, []),
    ({"event_id": "x"}, ["event_id_valid_uuid"]),
    ({"event_id": None}, ["event_id_valid_uuid"]),
    ({"producer_run_id": UUID.replace("-4", "-6", 1)}, ["producer_run_id_valid_uuid"]),
    ({"patient_id": 0}, ["patient_id_positive"]),
    ({"patient_id": "7"}, ["patient_id_positive"]),
    ({"patient_id": 72.5}, ["patient_id_positive"]),
    ({"event_time": z(START)[:-1]}, ["event_time_utc_format"]),
    ({"event_time": "never"}, ["event_time_utc_format", "event_time_present", "event_time_not_future", "event_time_not_stale", "event_precedes_production"]),
    ({"produced_at": None}, ["produced_at_utc_format", "produced_at_present", "produced_at_not_future", "produced_at_not_stale", "event_precedes_production"]),
    (at(z(FIVE)), []),
    (at(z(FIVE, 1)), ["event_time_not_future", "produced_at_not_future"]),
    (at(z(STALE)), []),
    (at(z(STALE, -1)), ["event_time_not_stale", "produced_at_not_stale"]),
    ({"event_time": z(QUEUED), "produced_at": z(QUEUED - timedelta(minutes=5))}, []),
    ({"event_time": z(QUEUED, 1), "produced_at": z(QUEUED - timedelta(minutes=5))}, ["event_precedes_production"]),
    ({"heart_rate_bpm": 30}, []),
    ({"heart_rate_bpm": 220}, []),
    ({"heart_rate_bpm": 29}, ["heart_rate_in_range"]),
    ({"heart_rate_bpm": 221}, ["heart_rate_in_range"]),
    ({"heart_rate_bpm": None}, ["heart_rate_in_range"]),
    ({"oxygen_saturation_pct": 50.0}, []),
    ({"oxygen_saturation_pct": 49.9}, ["oxygen_saturation_in_range"]),
    ({"oxygen_saturation_pct": 100.1}, ["oxygen_saturation_in_range"]),
    ({"temperature_c": 45.0}, []),
    ({"temperature_c": 29.9}, ["temperature_in_range"]),
    ({"blood_pressure_systolic_mmhg": 251}, ["systolic_pressure_in_range"]),
    ({"blood_pressure_systolic_mmhg": 59, "blood_pressure_diastolic_mmhg": 40}, ["systolic_pressure_in_range"]),
    ({"blood_pressure_diastolic_mmhg": 29}, ["diastolic_pressure_in_range"]),
    ({"blood_pressure_systolic_mmhg": 200, "blood_pressure_diastolic_mmhg": 151}, ["diastolic_pressure_in_range"]),
    ({"blood_pressure_systolic_mmhg": 80}, ["systolic_above_diastolic"]),
    ({"source": "  "}, ["source_present"]),
    ({"source": None}, ["source_present"]),
    ({"extra": 1}, ["payload_fields_exact"]),
]


def test_truth_table_of_the_event_rules(spark):
    payloads = [event(i, **changes) for i, (changes, _) in enumerate(CASES)]
    found = classified_rows(bronze_of(spark, payloads)).collect()
    by_offset = {r["eventhub_offset"]: r["_dq_errors"] for r in found}
    for number, (changes, expected) in enumerate(CASES):
        assert by_offset[number] == expected, changes
    assert len(event_rules()) == 23 and len(PAYLOAD_FIELDS) == 13 and len(SILVER_FIELDS) == 18


def test_unreadable_payloads_are_kept_in_quarantine(spark):
    good = json.dumps(event(1))
    missing = {k: v for k, v in event(2).items() if k != "source"}
    twice = good[:-1] + ', "source": "again"}'
    legacy = '{"event_id": 10, "patient_id": 41906, "heart_rate": 68, "event_timestamp": "2026-05-01T07:39:47"}'
    payloads = ["{bad", "[1]", "", good[:60], missing, twice, legacy, good]
    bronze = bronze_of(spark, payloads)
    bad = {r["eventhub_offset"]: r for r in quarantined_rows(bronze).collect()}
    assert sorted(bad) == [0, 1, 2, 3, 4, 5, 6]
    for number in (0, 1, 2, 3):
        assert "payload_parseable" in bad[number]["_dq_errors"]
        assert bad[number]["raw_payload"] == payloads[number]
    assert "payload_fields_exact" in bad[4]["_dq_errors"]
    assert bad[5]["_dq_errors"] == ["payload_fields_exact"]
    assert valid_rows(bronze).count() == 1
    outcomes = {r["dq_rule"]: r for r in batch_outcomes(parsed_rows(bronze), event_rules()).collect()}
    assert outcomes["payload_fields_exact"]["failed_records"] == 7
    assert outcomes["payload_fields_exact"]["passed_records"] == 1


def test_payload_is_parsed_once(spark):
    bronze = bronze_of(spark, [event(1)])
    for rows in (valid_rows(bronze), quarantined_rows(bronze), classified_rows(bronze)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_producer_limits_are_narrower(spark):
    payloads = [event(1), event(2, heart_rate_bpm=181), event(3, oxygen_saturation_pct=97.5), event(4, heart_rate_bpm=500)]
    found = {r["event_id"]: r["_producer_errors"] for r in producer_breaches(bronze_of(spark, payloads)).collect()}
    assert found == {
        payloads[1]["event_id"]: ["heart_rate_produced"],
        payloads[2]["event_id"]: ["oxygen_saturation_whole"],
    }


def test_windows(spark):
    payloads = [
        event(0, patient_id=1, heart_rate_bpm=60),
        event(4, patient_id=1, heart_rate_bpm=121),
        event(5, patient_id=1),
        event(4, patient_id=2, event_id=UUID, temperature_c=35.4),
    ]
    rows = valid_rows(bronze_of(spark, payloads))
    by_key = {(r["patient_id"], r["window_start"]): r for r in patient_5m(rows).collect()}
    assert len(by_key) == 3
    first = by_key[1, START]
    assert (first["measurement_count"], first["avg_heart_rate_bpm"], first["abnormal_rate"]) == (2, 90.5, 0.5)
    assert first["window_end"] == START + timedelta(minutes=5)
    hour = population_hourly(rows).first()
    assert (hour["event_count"], hour["patient_count"], hour["abnormal_count"]) == (4, 2, 2)
    assert "patient_id" not in population_hourly(rows).columns


def test_published_records(spark):
    rows = [(7, datetime(2026, 1, 1, 1, 2, 3), None), (7, datetime(2026, 1, 1, 1, 2, 3, 450000), "ç")]
    frame = spark.createDataFrame(rows, "patient_id BIGINT, event_time TIMESTAMP, note STRING")
    found = [(r["key"], json.loads(r["value"])) for r in to_records(frame).collect()]
    assert found[0] == ("7", {"patient_id": 7, "event_time": "2026-01-01T01:02:03Z", "note": None})
    assert found[1][1]["event_time"] == "2026-01-01T01:02:03.450000Z"
    folder = scratch_path(spark, "published")
    publish_files(frame, folder)
    assert spark.read.parquet(folder).count() == 2
    with pytest.raises(Exception, match="without a key"):
        to_records(frame.withColumn("patient_id", F.lit(None).cast("bigint"))).collect()


def test_consumer_options():
    options = consumer_options("host:9093", "vitals", "group", max_offsets=5, extra="x")
    assert options["subscribe"] == "vitals" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "5" and options["failOnDataLoss"] == "true"


@pytest.fixture
def stream(spark):
    for layer in ("bronze", "silver", "gold", "quarantine", "observability"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")
    yield VitalStream(Lake(spark), scratch_path(spark, "checkpoints"), max_files=1)
    for layer in ("bronze", "silver", "gold", "quarantine", "observability"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def land(spark, folder, payloads, offset, queued=QUEUED):
    rows = [record(p, offset + i, queued) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, RECORD_DDL).coalesce(1).write.mode("append").parquet(folder)


def test_update_deduplicates_resumes_and_fails_closed(spark, stream):
    folder = scratch_path(spark, "landing")
    land(spark, folder, [event(i) for i in range(12)] + [event(0)], 0)
    land(spark, folder, [event(i) for i in range(6, 18)], 100)
    stream.run(read_replay(spark, folder, 1))
    assert stream.silver().count() == 18
    assert stream.quarantine().count() == 0
    log = spark.table("observability.vital_pipeline_events")
    flows = {r["flow_name"]: r for r in flow_metrics(log, "vitals").collect()}
    assert {n: r["output_rows"] for n, r in flows.items()} == {"bronze": 25, "quarantine": 0, "silver": 18}
    rules = expectation_metrics(log, "vitals").collect()
    assert len(rules) == 23 and {r["passed_records"] for r in rules} == {25}
    gold = spark.table("gold.vital_population_hourly").collect()
    assert [r["event_count"] for r in gold] == [18]

    # Nothing new: nothing changes, and the aggregates can be rebuilt by day.
    stream.run(read_replay(spark, folder, 1))
    stream.refresh_gold(since=START.date())
    assert stream.silver().count() == 18
    assert spark.table("gold.vital_population_hourly").count() == 1

    # One bad event: Bronze and quarantine advance, Silver keeps its rows.
    land(spark, folder, [event(20), event(21, heart_rate_bpm=500)], 200)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="violate the contract"):
            stream.run(read_replay(spark, folder, 1))
        assert stream.silver().count() == 18
        assert spark.table("bronze.vital_events_raw").count() == 27
        assert [r["_dq_errors"] for r in stream.quarantine().collect()] == [["heart_rate_in_range"]]
    timeline = spark.table("observability.pipeline_update_timeline")
    states = [r["result_state"] for r in pipeline_updates(timeline, "vitals").collect()]
    assert states == ["FAILED", "FAILED", "COMPLETED", "COMPLETED"]


def test_progress_counts_rules(spark, stream):
    folder = scratch_path(spark, "landing")
    land(spark, folder, [event(1), event(2, heart_rate_bpm=500)], 0)
    stream.start_bronze(read_replay(spark, folder)).awaitTermination()
    query = stream.start_quarantine()
    query.awaitTermination()
    totals = rule_outcomes(query.recentProgress)
    assert totals["heart_rate_in_range"] == {"passed_records": 1, "failed_records": 1}
    assert totals["source_present"] == {"passed_records": 2, "failed_records": 0}


@pytest.mark.parametrize("thin", [False, True])
def test_late_events_are_dropped_and_counted(spark, thin):
    folder = scratch_path(spark, "late")
    # The watermark that drops late rows is the one before the previous micro-batch.
    days = timedelta(days=3)
    for number, moment in enumerate([START, START + days, START + days, START + timedelta(hours=1)]):
        payload = event(number, **at(z(moment)))
        land(spark, folder, [payload, payload], number * 10, queued=moment)
    rows = valid_rows(bronze_rows(read_replay(spark, folder, 1)))
    home = scratch_path(spark, "late-out")
    query = (
        first_copies(rows, thin)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{home}/rows")
    )
    query.awaitTermination()
    kept = spark.read.parquet(f"{home}/rows").collect()
    assert len({r["event_id"] for r in kept}) == len(kept) == 3
    dropped = [
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    ]
    assert sum(dropped) >= 1
    assert EVENT_TYPE == kept[0]["event_type"]


def test_late_events_go_aside_and_gold_rewrites_its_days_only(spark, stream):
    folder = scratch_path(spark, "landing")
    days = [START + timedelta(days=n) for n in (0, 3, 4)]

    def land_at(moment, first, count, offset):
        seen = [moment + timedelta(minutes=3 * n) for n in range(count)]
        land(spark, folder, [event(first + n, **at(z(t))) for n, t in enumerate(seen)], offset, queued=moment + timedelta(hours=2))

    def gold():
        found = spark.table("gold.vital_population_hourly")
        files = {r["window_date"]: r["f"] for r in found.select("window_date", F.col("_metadata.file_path").alias("f")).collect()}
        return files, sum(r["event_count"] for r in found.collect())

    land_at(days[0], 0, 20, 0)
    land_at(days[1], 100, 20, 100)
    stream.run(read_replay(spark, folder, 1))
    before, events = gold()
    assert events == 40 and len(before) == 2

    # One new day, one more event of the last day, one copy, and two events of the first day: too late.
    land_at(days[2], 200, 5, 200)
    land_at(days[1], 100, 1, 300)
    land_at(days[1] + timedelta(hours=5), 300, 1, 400)
    land_at(days[0], 400, 2, 500)
    stream.run(read_replay(spark, folder, 1))
    after, events = gold()
    assert events == 46 and stream.silver().count() == 46
    assert sorted(r["event_id"] for r in stream.late().collect()) == sorted(event(n)["event_id"] for n in (400, 401))
    changed = {day for day in after if after[day] != before.get(day)}
    assert changed == {days[1].date(), days[2].date()}

    # The same as a full recompute.
    names = ("vital_patient_5m", "vital_population_hourly")

    def rows():
        return {t: sorted(map(str, spark.table(f"gold.{t}").collect())) for t in names}

    merged = rows()
    stream.refresh_gold()
    assert rows() == merged

    # A batch that is run again replaces what it wrote.
    last = spark.table("silver.vital_events").where(F.col("event_time_date") == days[2].date())
    stream._fold(last, 999)
    once = rows()
    stream._fold(last, 999)
    assert rows() == once != merged


def test_silver_has_one_stateful_step_on_disk(spark, stream):
    folder = scratch_path(spark, "landing")
    land(spark, folder, [event(i % 4) for i in range(40)], 0)
    stream.start_bronze(read_replay(spark, folder)).awaitTermination()
    query = stream.start_silver()
    query.awaitTermination()
    states = [p["stateOperators"] for p in query.recentProgress]
    assert {len(s) for s in states} == {1}
    assert any("rocksdb" in name for name in states[0][0]["customMetrics"])
    # Of the copies in one task only one went through the shuffle.
    assert max(s[0]["numRowsUpdated"] for s in states) == 4
    assert sum(s[0]["customMetrics"]["numDroppedDuplicateRows"] for s in states) < 36
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(RuntimeError, match="RocksDB"):
            stream.start_silver()
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def test_updates_need_utc(spark, stream):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            stream.run(None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_batches_are_bounded_by_bytes(spark):
    folder, home = scratch_path(spark, "bytes"), scratch_path(spark, "bytes-out")
    spark.range(0, 4000, 1, 20).selectExpr("id", "md5(CAST(id AS STRING)) AS m").write.parquet(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    sizes = files.agg(F.max("length").alias("one"), F.sum("length").alias("all")).first()
    lake = Lake(spark)
    lake.ensure_layer("bounded")
    spark.sql("DROP TABLE IF EXISTS bounded.source")
    spark.sql(f"CREATE TABLE bounded.source USING parquet LOCATION '{folder}'")
    stream = VitalStream(lake, home, max_bytes=3 * sizes["one"])
    query = (
        stream._follow("bounded", "source").writeStream.option("checkpointLocation", f"{home}/c")
        .trigger(availableNow=True).start(f"{home}/rows")
    )
    query.awaitTermination()
    taken = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(taken) == 4000 and max(taken) <= 3 * 200 and len(taken) >= 6
