from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixtures import NEXT, ODATE, raw_frame
from sluice.operators.cleaning import clean, path_odate, snapshot_of, with_effective_odate

HOSPITAL = {"capacity": "5", "state": "PE"}


def test_latest_copy_wins_then_file_then_content(spark):
    rows = [
        {"hospital_id": "1", "city": "old", "_ingested_at": datetime(2026, 8, 1), **HOSPITAL},
        {"hospital_id": "1", "city": "new", "_ingested_at": datetime(2026, 8, 2), **HOSPITAL},
        {"hospital_id": "2", "city": "b", "_source_file": "b", **HOSPITAL},
        {"hospital_id": "2", "city": "z", "_source_file": "a", **HOSPITAL},
        {"hospital_id": "3", "city": "x", **HOSPITAL},
        {"hospital_id": "3", "city": "y", **HOSPITAL},
    ]
    for order in (rows, rows[::-1]):
        found = clean(raw_frame(spark, "hospitals", order).repartition(3), "hospitals").collect()
        assert {(r["hospital_id"], r["city"]) for r in found} == {(1, "new"), (2, "b"), (3, "y")}


def test_raw_keys_are_compared_as_text_by_default(spark):
    rows = [{"hospital_id": key, **HOSPITAL} for key in ("17", "17.0", "17")]
    frame = raw_frame(spark, "hospitals", rows)
    assert [r["hospital_id"] for r in clean(frame, "hospitals").collect()] == [17, 17]
    assert clean(frame, "hospitals", dedup_on="typed").count() == 1


def test_missing_keys_collapse_to_one_row(spark):
    rows = [{"hospital_id": None, "city": str(i), **HOSPITAL} for i in range(5)]
    assert clean(raw_frame(spark, "hospitals", rows), "hospitals").count() == 1


def test_rows_without_required_values_are_dropped(spark):
    rows = [
        {"patient_id": "1", "birth_date": "2000-01-01", "gender": "f", "state": " pe "},
        {"patient_id": "2", "birth_date": "never", "gender": "f", "state": "PE"},
        {"patient_id": "3", "birth_date": "2000-01-01", "state": "PE"},
        {"patient_id": None, "birth_date": "2000-01-01", "gender": "M", "state": "PE"},
    ]
    found = clean(raw_frame(spark, "patients", rows), "patients").collect()
    assert sorted(str(r["patient_id"]) for r in found) == ["1", "None"]
    assert found[0]["state"] == "PE"


def test_flag_keeps_three_values(spark):
    base = {
        "patient_id": "1",
        "doctor_id": "1",
        "hospital_id": "1",
        "disease_id": "1",
        "attendance_date": "2026-01-02 03:04:05",
        "severity_score": "3",
    }
    rows = [
        {"attendance_id": str(i), "discharge_flag": flag, **base}
        for i, flag in enumerate(("1.0", "0", "", None, "2"))
    ]
    found = clean(raw_frame(spark, "attendance", rows), "attendance", for_gate=True).collect()
    by_id = {r["attendance_id"]: r for r in found}
    assert [by_id[i]["is_discharged"] for i in range(5)] == [True, False, None, None, False]
    assert [by_id[i]["discharge_flag"] for i in range(5)] == [1, 0, None, None, 2]
    assert by_id[0]["attendance_timestamp"] == datetime(2026, 1, 2, 3, 4, 5)


def test_lost_date_comes_from_the_path(spark):
    rows = [
        ("s3/raw/x/odate=2026-08-05/x.csv", None),
        ("odate=2026-08-06", None),
        ("s3/not-odate=2026-08-05/x.csv", None),
        ("s3/odate=2026-99-99/x.csv", None),
        ("s3/odate=2026-08-06/x.csv", ODATE),
    ]
    frame = spark.createDataFrame(rows, "_source_file STRING, odate DATE")
    found = [r["odate"] for r in with_effective_odate(frame).collect()]
    assert found == [ODATE, NEXT, None, None, ODATE]
    assert frame.select(path_odate(F.col("_source_file"))).first()[0] == ODATE
    assert snapshot_of(frame, ODATE).count() == 2
    assert snapshot_of(frame, NEXT).count() == 1


def test_unknown_entity(spark):
    with pytest.raises(ValueError):
        clean(raw_frame(spark, "hospitals", []), "nurses")
