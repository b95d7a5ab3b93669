"""Cleaned rows with the copies of their key, from one shuffle of whole rows."""

from datetime import date

import pytest
from fixtures import raw_frame
from pyspark.sql import functions as F

from sluice.operators import cleaning
from sluice.operators.checks import ERRORS, accepted, annotate, rejected
from sluice.plans.rulebook import BEFORE_SILVER, rules_for


def _visits(spark):
    """Keys as several texts, repeated texts, junk and missing keys, rows that cleaning removes."""
    texts = ["1", "1.0", "1.0", "2", "2", "3.00", "junk", "junk", "none", None, None, "4", "04"]
    rows = [
        {
            "attendance_id": text, "patient_id": str(n), "doctor_id": "5", "hospital_id": "6",
            "disease_id": "7", "attendance_date": "2026-08-01 10:00:00", "wait_time_minutes": "9",
            "cost": "1.50", "severity_score": "" if text == "04" else "2", "discharge_flag": "1",
            "created_at": "2026-08-01 10:00:00",
        }
        for n, text in enumerate(texts)
    ]
    return raw_frame(spark, "attendance", rows).repartition(3)


@pytest.mark.parametrize("most", [0, 1, 2, 100])
def test_copies_equal_a_count_of_cleaned_rows(spark, monkeypatch, most):
    monkeypatch.setattr(cleaning, "HOT_ROWS", most)
    raw = _visits(spark)
    rules = rules_for(BEFORE_SILVER, "attendance", date(2026, 8, 2))
    plain = cleaning.clean(raw, "attendance", for_gate=True)
    counted = cleaning.clean_counted(raw, "attendance", "__copies", for_gate=True)
    copies = {}
    for row in plain.collect():
        copies[row["attendance_id"]] = copies.get(row["attendance_id"], 0) + 1
    assert copies == {1: 2, 2: 1, 3: 1, 4: 1, None: 3}
    found = counted.collect()
    assert all(row["__copies"] == copies[row["attendance_id"]] for row in found)
    assert sorted(map(repr, counted.drop("__copies").collect())) == sorted(map(repr, plain.collect()))
    for part in (accepted, rejected, annotate):
        mine, theirs = part(counted, rules, copies="__copies"), part(plain, rules)
        assert mine.columns == theirs.columns
        assert sorted(map(repr, mine.collect())) == sorted(map(repr, theirs.collect()))
    assert {r["attendance_id"] for r in accepted(counted, rules, copies="__copies").collect()} == {2, 3, 4}


def test_whole_rows_are_shuffled_and_sorted_once(spark):
    rules = rules_for(BEFORE_SILVER, "attendance", date(2026, 8, 2))
    counted = cleaning.clean_counted(_visits(spark), "attendance", "__copies", for_gate=True)
    for part in (accepted, rejected):
        plan = part(counted, rules, copies="__copies")._jdf.queryExecution().executedPlan().toString()
        # Above the shuffle by typed key one sort and no other shuffle, below it no sort at all.
        above, below = plan.split("REPARTITION_BY_COL")
        assert above.count("Exchange hashpartitioning(") == 1
        assert sum(" Sort [" in line and "__texts" in line for line in above.splitlines()) == 1
        assert " Sort [" not in below[: below.index("__rows")]
        assert "SortMergeJoin" not in plan
