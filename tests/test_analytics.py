"""Reconciliation, snapshots, profiles, monitoring, charts and alerts on small fixtures."""

from datetime import date, datetime

from pyspark.sql import functions as F

from fixtures import AS_OF, ODATE, raw_frame
from sluice.operators.profile import against_expected, profile
from sluice.operators.reconcile import (
    align_to_parent,
    existing,
    orphans,
    sanitize_snapshots,
    with_contract,
)
from sluice.operators.snapshots import previous_snapshot, roll_forward, snapshot_delta
from sluice.plans import alerts, charts
from sluice.plans import monitoring as m

SLICES = (
    "job_id STRING, pipeline_id STRING, run_id STRING, update_id STRING, "
    "period_start_time TIMESTAMP, period_end_time TIMESTAMP, result_state STRING, "
    "termination_code STRING"
)
METRICS = (
    "checked_at TIMESTAMP, dq_run_id STRING, dq_stage STRING, source_table STRING, "
    "input_rows BIGINT, checked_rows BIGINT, valid_rows BIGINT, quarantined_rows BIGINT, "
    "status STRING, odate DATE"
)
LOG = (
    "origin STRUCT<update_id: STRING, pipeline_id: STRING, flow_name: STRING, "
    "dataset_name: STRING>, event_type STRING, timestamp TIMESTAMP, details STRING"
)


def test_sanitize_closes_references(spark):
    raw = {
        "patients": [
            {"patient_id": "1", "gender": " m ", "state": "pe", "birth_date": "2000-01-01"},
            {"patient_id": "2", "gender": "X", "state": "PE", "birth_date": "2000-01-01"},
            {"patient_id": "3", "gender": "F", "state": "PE", "birth_date": "2030-01-01"},
        ],
        "hospitals": [
            {"hospital_id": "1", "state": "PE", "capacity": "10"},
            {"hospital_id": "2", "state": "PE", "capacity": "2000.5"},
            {"hospital_id": "3", "state": "RN", "capacity": "1"},
        ],
        "doctors": [
            # The later copy names an invalid hospital, so the earlier one counts.
            {"doctor_id": "1", "hospital_id": "1", "crm": "5", "created_at": "2026-01-01"},
            {"doctor_id": "1", "hospital_id": "2", "crm": "5", "created_at": "2026-01-02"},
            {"doctor_id": "2", "hospital_id": "3.0", "crm": "6.0"},
            {"doctor_id": "3", "hospital_id": "1", "crm": "0"},
        ],
        "diseases": [
            {"disease_id": "1", "severity_level": "5"},
            {"disease_id": "2", "severity_level": "5.4"},
        ],
        "attendance": [
            {"attendance_id": "1", "patient_id": "1", "doctor_id": "1", "disease_id": "1"},
            {"attendance_id": "2", "patient_id": "1", "doctor_id": "2", "disease_id": "1"},
            {"attendance_id": "3", "patient_id": "2", "doctor_id": "1", "disease_id": "1"},
            {"attendance_id": "4", "patient_id": "1", "doctor_id": "3", "disease_id": "1"},
            {"attendance_id": "5", "patient_id": "1", "doctor_id": "1", "disease_id": "2"},
            {"attendance_id": "6", "patient_id": "1.5", "doctor_id": "1", "disease_id": "1"},
            {"attendance_id": "0", "patient_id": "1", "doctor_id": "1", "disease_id": "1"},
            {"attendance_id": "1e30", "patient_id": "1", "doctor_id": "1", "disease_id": "1"},
        ],
    }
    more = {
        "hospital_id": "77",
        "attendance_date": "2026-01-01",
        "severity_score": "3.0",
        "wait_time_minutes": "301",
        "cost": "-1",
        "discharge_flag": "2",
    }
    raw["attendance"] = [{**more, **r} for r in raw["attendance"]]
    frames = {name: raw_frame(spark, name, rows) for name, rows in raw.items()}
    clean = {k: v.collect() for k, v in sanitize_snapshots(frames, as_of=AS_OF).items()}
    assert [(r["patient_id"], r["gender"], r["state"]) for r in clean["patients"]] == [(1, "M", "PE")]
    assert sorted(r["hospital_id"] for r in clean["hospitals"]) == [1, 3]
    assert {r["doctor_id"]: r["hospital_id"] for r in clean["doctors"]} == {1: 1, 2: 3}
    assert [r["disease_id"] for r in clean["diseases"]] == [1]
    visits = {r["attendance_id"]: r for r in clean["attendance"]}
    assert {k: r["hospital_id"] for k, r in visits.items()} == {1: 1, 2: 3}
    assert visits[1]["wait_time_minutes"] is None and visits[1]["cost"] is None
    assert visits[1]["discharge_flag"] is None and visits[1]["severity_score"] == 3


def test_references_ignore_copies_and_missing_values(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k BIGINT")
    parents = spark.createDataFrame([(1, 5), (1, 7), (None, 9)], "id BIGINT, v INT")
    assert existing(child, "k", parents, "id").count() == 2
    assert orphans(child, "k", parents, "id").count() == 2
    aligned = align_to_parent(child.withColumn("v", F.lit(0)), "k", "v", parents, "id")
    assert sorted(str(r["v"]) for r in aligned.collect()) == ["7", "7", "None", "None"]


def test_contract_projection(spark):
    frame = spark.createDataFrame([("x", 1)], "extra STRING, b INT")
    assert with_contract(frame, ["a", "b"]).collect()[0].asDict() == {"a": None, "b": 1}


def test_snapshots(spark):
    days = [date(2026, 8, d) for d in (1, 3, 9)]
    history = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k INT, odate DATE")
    assert [r["k"] for r in previous_snapshot(history, date(2026, 8, 9)).collect()] == [1]
    assert previous_snapshot(history, date(2026, 8, 1)).count() == 0
    before = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k INT")
    after = spark.createDataFrame([(1,), (3,), (4,), (None,)], "k INT")
    assert tuple(snapshot_delta(before, after, "k").first()) == (5, 4, 1, 1, 4)
    rolled = roll_forward(before, spark.createDataFrame([(1,)], "k INT"), after.where("k = 4"), "k")
    assert sorted(str(r["k"]) for r in rolled.collect()) == ["2", "3", "4", "None"]


def test_profile(spark):
    rows = [(1, "a"), (1, None), (2, None), (None, "b")]
    found = profile(spark.createDataFrame(rows, "k INT, c STRING"), "k", ["c"])
    judged = against_expected(found, {"c": 0.45}, 0.0, 0.1).collect()
    by_item = {(r["kind"], r["item"]): r for r in judged}
    assert (by_item["nulls", "c"]["hits"], by_item["nulls", "c"]["within_tolerance"]) == (2, True)
    assert by_item["duplicates", "k"]["hits"] == 1
    assert by_item["duplicates", "k"]["within_tolerance"] is False


def slices(spark, rows):
    filled = [(j, "p", r, r, a, b, s, "SUCCESS") for j, r, a, b, s in rows]
    return spark.createDataFrame(filled, SLICES)


def test_health_is_one_row_even_without_runs(spark):
    none = slices(spark, [])
    assert tuple(m.batch_health(none, ["1"], AS_OF).first()) == (0, 0, None)
    assert tuple(m.streaming_health(none, "p", none, "1", AS_OF).first()) == (0, None, 0)
    metrics = spark.createDataFrame([], METRICS)
    log = spark.createDataFrame([], LOG)
    assert tuple(m.quality_health(metrics, log, "p", AS_OF).first()) == (0, 0)
    assert m.flow_metrics(log, "p", AS_OF).count() == 0
    events = "event_time TIMESTAMP, eventhub_enqueued_at TIMESTAMP, ingested_at TIMESTAMP"
    assert m.stream_freshness(spark.createDataFrame([], events), AS_OF).count() == 1
    empty = spark.createDataFrame([], "odate DATE")
    row = m.gold_freshness({"t": empty}, AS_OF).first()
    assert tuple(row) == ("t", None, 0, 0, None)


def test_runs_alerts_and_charts(spark):
    def t(hour, minute=0):
        return datetime(2026, 8, 9, hour, minute)

    rows = [
        ("1", "a", t(1), t(2), None),
        ("1", "a", t(2), t(4), "SUCCESS"),
        ("1", "b", t(5), t(5, 1), "failed"),
        ("2", "c", t(6), None, None),
        ("2", "d", t(0), t(23), "CANCELED"),
        ("9", "e", t(7), t(7, 30), "TIMED_OUT"),
        ("1", "old", datetime(2026, 1, 1), datetime(2026, 1, 2), "FAILED"),
    ]
    frame = slices(spark, rows)
    runs = {r["run_id"]: r for r in m.batch_runs(frame, ["1", "2", "9"], {"1": "Main"}, AS_OF).collect()}
    assert set(runs) == {"a", "b", "c", "d", "e"}
    assert (runs["a"]["duration_seconds"], runs["a"]["job_name"]) == (10800, "Main")
    assert (runs["c"]["result_state"], runs["c"]["duration_seconds"]) == ("RUNNING", None)
    assert runs["e"]["job_name"] == "Job 9"
    assert tuple(m.batch_health(frame, ["1", "2", "9"], AS_OF).first()) == (3, 1, 1800)
    rolled = m.roll_up_slices(frame, ["job_id", "run_id"], AS_OF)
    raised = {
        (r["run_id"], r["event_type"])
        for r in alerts.run_alerts(rolled, {"1": alerts.BATCH_LIMIT_SECONDS}).collect()
    }
    assert raised == {
        ("a", alerts.ON_DURATION),
        ("b", alerts.ON_FAILURE),
        ("e", alerts.ON_FAILURE),
    }
    by_job = charts.failures_by_job(m.batch_runs(frame, ["1", "2"], {"1": "Main"}, AS_OF))
    assert {tuple(r) for r in by_job.collect()} == {("Main", 1), ("Job 2", 1)}


def test_quality_runs_use_the_newest_run(spark):
    rows = [
        (datetime(2026, 8, 1), "r1", "s", "t", 10, 10, 9, 1, "FAILED", ODATE),
        (datetime(2026, 8, 2), "r2", "s", "t", 10, 8, 8, 0, "PASSED", ODATE),
        (datetime(2026, 8, 2), "r2", "s", "u", 5, 5, 4, 0, "PASSED", ODATE),
        (datetime(2020, 1, 1), "r0", "s", "t", 5, 5, 5, 0, "PASSED", date(2020, 1, 1)),
    ]
    metrics = spark.createDataFrame(rows, METRICS)
    approved = spark.createDataFrame(
        [("s", ODATE, "r2")] * 2, "dq_stage STRING, odate DATE, dq_run_id STRING"
    )
    found = m.latest_quality_runs(metrics, approved, AS_OF).collect()
    shown = [(r["source_table"], r["removed_by_cleaning"], r["reconciliation_ok"], r["promotion_approved"]) for r in found]
    assert shown == [("t", 2, True, True), ("u", 0, False, True)]


def test_event_log(spark):
    def detail(status, backlog, failed):
        rules = f'[{{"name":"r","dataset":"d","passed_records":1,"failed_records":{failed}}}]'
        extra = "" if backlog is None else f',"backlog_bytes":{backlog}'
        return (
            f'{{"flow_progress":{{"status":"{status}","metrics":{{"num_output_rows":2{extra}}},'
            f'"data_quality":{{"expectations":{rules}}}}}}}'
        )

    def t(minute):
        return datetime(2026, 8, 10, 11, minute)

    rows = [
        (("u1", "p", "f", "d"), "flow_progress", t(0), detail("RUNNING", 5, 9)),
        (("u2", "p", "f", "d"), "flow_progress", t(1), detail("RUNNING", 7, 1)),
        (("u2", "p", "f", "d"), "flow_progress", t(2), detail("COMPLETED", None, 2)),
        (("u2", "p", None, "d"), "flow_progress", t(3), "{}"),
        ((None, "p", "f", "d"), "flow_progress", t(9), "{}"),
        (("u9", "other", "f", "d"), "flow_progress", t(9), "{}"),
    ]
    log = spark.createDataFrame(rows, LOG)
    flows = {r["flow_name"]: r for r in m.flow_metrics(log, "p", AS_OF).collect()}
    assert set(flows) == {"f", "d"}
    assert (flows["f"]["final_status"], flows["f"]["output_rows"]) == ("COMPLETED", 4)
    assert flows["f"]["backlog_bytes_at_last_refresh"] == 7
    assert flows["f"]["observation_age_minutes"] == 58
    assert [tuple(r) for r in m.expectation_metrics(log, "p").collect()] == [("u2", "d", "r", 2, 3)]


def test_missing_ingestions(spark):
    runs = spark.createDataFrame(
        [(date(2026, 8, 5), "Succeeded"), (date(2026, 8, 6), "Failed")], "odate DATE, status STRING"
    )
    found = alerts.missing_ingestions(runs, runs).collect()
    assert [r["odate"] for r in found] == [date(2026, 8, 6)]
