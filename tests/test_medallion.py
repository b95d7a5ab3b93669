"""Gates and the whole refresh, over catalogue tables."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, GOOD, NEXT, ODATE, write_raw
from sluice.__main__ import run
from sluice.plans import gate, medallion
from sluice.plans.rulebook import BEFORE_GOLD, BEFORE_SILVER
from sluice.sources.raw import list_landed, read_raw_csv, require_landed
from sluice.sources.tables import EmptyPartition, Lake

LAYERS = ("bronze", "silver", "gold", "quarantine", "observability")


@pytest.fixture
def lake(spark):
    for layer in LAYERS:
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")
    yield Lake(spark)
    for layer in LAYERS:
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "raw")


def metrics(lake):
    return lake.read("observability", "dq_run_metrics")


def broken(entity, *lines):
    return {**GOOD, entity: [*GOOD[entity], *lines]}


def snapshot(lake, layer, table):
    return sorted(str(r) for r in lake.read(layer, table).drop("_ingested_at").collect())


def test_refresh_of_two_dates_and_rerun(lake, root):
    write_raw(root, ODATE, GOOD)
    write_raw(root, NEXT, GOOD)
    medallion.refresh(lake, root, ODATE, "r1", AS_OF)
    first = {t: snapshot(lake, "gold", t) for t in ("patients", "kpi_hospital_daily")}
    medallion.refresh(lake, root, NEXT, "r2", AS_OF)
    medallion.refresh(lake, root, ODATE, "r3", AS_OF)
    for table, rows in first.items():
        again = lake.partition("gold", table, ODATE).collect()
        assert sorted(str(r) for r in again) == rows
        assert lake.partition("gold", table, NEXT).count() == len(rows)
    patients = lake.read("gold", "patients")
    assert set(patients.columns).isdisjoint({"full_name", "cpf", "email", "phone", "_source_file"})
    kpi = {
        (r["hospital_id"], str(r["attendance_date"])): r
        for r in lake.partition("gold", "kpi_hospital_daily", ODATE).collect()
    }
    busy = kpi[1, "2026-03-01"]
    assert (busy["attendance_count"], busy["avg_wait_time_minutes"]) == (2, 10.0)
    assert (str(busy["total_cost"]), busy["discharge_rate"]) == ("150.75", 1.0)
    assert busy["hospital_name"] == "North" and busy["state"] == "PE"
    unknown = kpi[9, "2026-03-02"]
    assert unknown["hospital_name"] is None and unknown["discharge_rate"] == 0.0
    approved = {(r["dq_stage"], r["odate"]): r["dq_run_id"] for r in gate.approvals(lake).collect()}
    assert approved == {
        (BEFORE_SILVER, ODATE): "r3",
        (BEFORE_GOLD, ODATE): "r3",
        (BEFORE_SILVER, NEXT): "r2",
        (BEFORE_GOLD, NEXT): "r2",
    }
    assert metrics(lake).count() == 30


def test_one_bad_table_blocks_all_and_is_quarantined_masked(lake, root):
    bad = "3,Eve Secret,99988877766,eve@mail.org,5551234,Q,A+,1990-01-01,Recife,PE,2026-01-01"
    write_raw(root, ODATE, broken("patients", bad))
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    with pytest.raises(gate.GateRejected, match=r"bronze.patients: 1 row\(s\)"):
        gate.run_gate(lake, BEFORE_SILVER, ODATE, "r1", AS_OF)
    found = {r["source_table"]: r for r in metrics(lake).collect()}
    assert len(found) == 5
    assert found["bronze.patients"]["status"] == "FAILED"
    assert found["bronze.patients"]["quarantined_rows"] == 1
    assert found["bronze.doctors"]["status"] == "PASSED"
    assert '"quarantined_rows":1' in found["bronze.patients"]["violation_summary"]
    row = lake.read("quarantine", "bronze_to_silver_patients").first()
    assert row["_dq_errors"] == ["gender_allowed"] and row["_dq_run_id"] == "r1"
    assert (row["full_name"], row["cpf"], row["email"], row["phone"]) == (
        "E***",
        "***.***.***-66",
        "e***@mail.org",
        "***-1234",
    )
    with pytest.raises(gate.NotApproved):
        medallion.promote_silver(lake, ODATE)
    assert not lake.exists("silver", "doctors")
    # A rerun appends the same rows under its own run id.
    with pytest.raises(gate.GateRejected):
        gate.run_gate(lake, BEFORE_SILVER, ODATE, "r2", AS_OF)
    quarantined = lake.read("quarantine", "bronze_to_silver_patients")
    assert {r["_dq_run_id"] for r in quarantined.collect()} == {"r1", "r2"}


def test_repeated_typed_keys_reach_quarantine(lake, root):
    write_raw(root, ODATE, broken("diseases", "1.0,Flu again,Viral,2,2026-01-01"))
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    with pytest.raises(gate.GateRejected, match="diseases: 2"):
        gate.run_gate(lake, BEFORE_SILVER, ODATE, "r1", AS_OF)
    rows = lake.read("quarantine", "bronze_to_silver_diseases").collect()
    assert [r["_dq_errors"] for r in rows] == [["disease_id_unique"]] * 2


def test_counters_reconcile(lake, root):
    extra = ["2,Cold copy,Viral,5,2026-01-01", "3,No severity,Viral,,2026-01-01"]
    write_raw(root, ODATE, broken("diseases", *extra))
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    gate.run_gate(lake, BEFORE_SILVER, ODATE, "r1", AS_OF)
    row = metrics(lake).where("source_table = 'bronze.diseases'").first()
    assert (row["input_rows"], row["checked_rows"], row["valid_rows"]) == (4, 2, 2)
    assert '"removed_by_cleaning":2' in row["violation_summary"]


def test_empty_and_cleaned_away_tables_fail_the_date(lake, root):
    write_raw(root, ODATE, GOOD)
    write_raw(root, NEXT, {**GOOD, "doctors": ["1,Dr,x,Cardio,y,2026-01-01"]})
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    medallion.ingest_bronze(lake, root, NEXT, AS_OF)
    with pytest.raises(gate.GateRejected, match="cleaning produced an empty snapshot"):
        gate.run_gate(lake, BEFORE_SILVER, NEXT, "r1", AS_OF)
    with pytest.raises(gate.GateRejected, match="no rows found for odate=2026-09-01"):
        gate.run_gate(lake, BEFORE_SILVER, datetime(2026, 9, 1).date(), "r2", AS_OF)
    assert metrics(lake).count() == 10
    row = metrics(lake).where("source_table = 'bronze.doctors' AND dq_run_id = 'r1'").first()
    assert (row["input_rows"], row["checked_rows"], row["status"]) == (1, 0, "FAILED")


def test_approval_state_machine(lake, root):
    with pytest.raises(gate.NotApproved, match="does not exist"):
        gate.require_approval(lake, BEFORE_SILVER, ODATE)
    write_raw(root, ODATE, GOOD)
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    gate.run_gate(lake, BEFORE_SILVER, ODATE, "r1", AS_OF)
    gate.require_approval(lake, BEFORE_SILVER, ODATE)
    with pytest.raises(gate.NotApproved, match="not approved"):
        gate.require_approval(lake, BEFORE_GOLD, ODATE)
    # A failing rerun leaves the approval unless it is to be revoked.
    write_raw(root, ODATE, broken("hospitals", "3,Zero,Public,PE,Recife,0,2026-01-01"))
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    with pytest.raises(gate.GateRejected):
        gate.run_gate(lake, BEFORE_SILVER, ODATE, "r2", AS_OF)
    gate.require_approval(lake, BEFORE_SILVER, ODATE)
    with pytest.raises(gate.GateRejected):
        gate.run_gate(lake, BEFORE_SILVER, ODATE, "r3", AS_OF, revoke_on_failure=True)
    with pytest.raises(gate.NotApproved):
        gate.require_approval(lake, BEFORE_SILVER, ODATE)


def test_csv_reader_keeps_corrupt_lines_and_lineage(lake, root, spark):
    lines = ["1,Flu,Viral,1,2026-01-01", "2,Too,few", '3,"open quote,Viral,1,2026-01-01']
    write_raw(root, ODATE, {**GOOD, "diseases": lines})
    found = read_raw_csv(spark, root, "diseases", ODATE, AS_OF)
    assert found.count() == 3
    rows = {r["disease_id"]: r for r in found.collect()}
    assert rows["1"]["_corrupt_record"] is None
    assert rows["2"]["_corrupt_record"] == "2,Too,few"
    assert rows["1"]["_source_file"].endswith(f"diseases/odate={ODATE}/diseases.csv")
    assert rows["1"]["odate"] == ODATE and rows["1"]["_ingested_at"] == AS_OF


def test_landing(spark, root):
    write_raw(root, ODATE, GOOD)
    require_landed(spark, root, ODATE)
    write_raw(root, NEXT, {"patients": GOOD["patients"]})
    with pytest.raises(FileNotFoundError, match="attendance/odate=2026-08-06/attendance.csv"):
        require_landed(spark, root, NEXT)
    assert list_landed(spark, root).count() == 6


def test_command_line(lake, root, spark):
    write_raw(root, ODATE, GOOD)
    day = ODATE.isoformat()
    run(spark, ["landed", "--raw-root", root, "--odate", day])
    run(spark, ["refresh", "--raw-root", root, "--odate", day, "--run-id", uuid.uuid4().hex])
    assert lake.read("gold", "kpi_hospital_daily").count() == 2
    with pytest.raises(SystemExit):
        run(spark, ["silver", "--odate", ""])


def test_empty_bronze_is_refused(lake, root):
    write_raw(root, ODATE, {**GOOD, "patients": []})
    with pytest.raises(EmptyPartition):
        medallion.ingest_bronze(lake, root, ODATE)


def test_silver_reads_one_bronze_partition(lake, root):
    write_raw(root, ODATE, GOOD)
    write_raw(root, NEXT, GOOD)
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    medallion.ingest_bronze(lake, root, NEXT, AS_OF)
    rows = medallion.silver_rows(lake, "attendance", ODATE)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "odate" in plan.split("PartitionFilters: [")[1]
    assert plan.count("WindowGroupLimit") == 2
    files = rows.select(F.col("_source_file")).distinct().count()
    assert files == 1


def test_silver_is_what_the_gate_has_checked(lake, root):
    write_raw(root, ODATE, GOOD)
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    gate.run_gate(lake, BEFORE_SILVER, ODATE, "r1", AS_OF)
    # Bronze changes after the approval; the promotion publishes the rows of the approved run.
    write_raw(root, ODATE, broken("hospitals", "3,Zero,Public,PE,Recife,0,2026-01-01"))
    medallion.ingest_bronze(lake, root, ODATE, AS_OF)
    plan = gate.staged_rows(lake, "hospitals", ODATE, "r1")._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString() and "Window" not in plan.toString()
    medallion.promote_silver(lake, ODATE)
    assert lake.partition("silver", "hospitals", ODATE).count() == 2
    # The rows of another run are not taken for those of the approved one.
    assert gate.staged_rows(lake, "hospitals", ODATE, "r2") is None
    expected = medallion.silver_rows(lake, "doctors", ODATE)
    assert sorted(lake.read("silver", "doctors").columns) == sorted(expected.columns)
