"""Every rule with passing, failing, missing and boundary values."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from fixtures import AS_OF
from sluice.operators.checks import annotate, rejected, split, tally
from sluice.operators.rules import not_null, sql_rule, unique_key
from sluice.plans.rulebook import BEFORE_GOLD, BEFORE_SILVER, STAGES, rules_for

TYPES = {
    "patients": "patient_id BIGINT, birth_date DATE, gender STRING, state STRING, odate DATE",
    "hospitals": "hospital_id BIGINT, capacity INT, state STRING",
    "doctors": "doctor_id BIGINT, crm BIGINT, hospital_id BIGINT",
    "diseases": "disease_id BIGINT, severity_level INT",
    "attendance": (
        "attendance_id BIGINT, patient_id BIGINT, doctor_id BIGINT, hospital_id BIGINT, "
        "disease_id BIGINT, attendance_timestamp TIMESTAMP, attendance_date DATE, "
        "wait_time_minutes INT, cost DECIMAL(12,2), severity_score INT, discharge_flag INT"
    ),
}
GOOD = {
    "patients": {
        "birth_date": date(2000, 1, 1),
        "gender": "F",
        "state": "PE",
        "odate": date(2026, 8, 5),
    },
    "hospitals": {"capacity": 10, "state": "PE"},
    "doctors": {"crm": 5, "hospital_id": 1},
    "diseases": {"severity_level": 3},
    "attendance": {
        "patient_id": 1,
        "doctor_id": 1,
        "hospital_id": 1,
        "disease_id": 1,
        "attendance_timestamp": datetime(2026, 1, 1),
        "attendance_date": date(2026, 1, 1),
        "wait_time_minutes": 5,
        "cost": Decimal("1.00"),
        "severity_score": 3,
        "discharge_flag": 1,
    },
}
# (entity, column, value, rule it breaks before Silver, rule it breaks before Gold)
CASES = [
    ("patients", "birth_date", AS_OF.date(), None, None),
    ("patients", "birth_date", date(2026, 8, 11), "birth_date_not_future", None),
    ("patients", "birth_date", None, "birth_date_not_future", None),
    ("patients", "gender", "M", None, None),
    ("patients", "gender", "X", "gender_allowed", None),
    ("patients", "gender", None, "gender_allowed", None),
    ("patients", "state", "abc", "state_is_uf", None),
    ("patients", "state", "P1", "state_is_uf", None),
    ("patients", "state", None, "state_is_uf", None),
    ("patients", "odate", None, None, "odate_present"),
    ("hospitals", "capacity", 0, "capacity_in_range", "capacity_in_range"),
    ("hospitals", "capacity", 1, None, None),
    ("hospitals", "capacity", 2000, None, None),
    ("hospitals", "capacity", 2001, "capacity_in_range", "capacity_in_range"),
    ("hospitals", "capacity", None, "capacity_in_range", "capacity_in_range"),
    ("hospitals", "state", "pe", "state_is_uf", None),
    ("hospitals", "state", None, "state_is_uf", None),
    ("doctors", "crm", 1, None, None),
    ("doctors", "crm", 0, "crm_positive", None),
    ("doctors", "crm", None, "crm_positive", None),
    ("doctors", "hospital_id", None, "doctor_hospital_present", "hospital_id_present"),
    ("diseases", "severity_level", 0, "severity_in_range", "severity_in_range"),
    ("diseases", "severity_level", 1, None, None),
    ("diseases", "severity_level", 5, None, None),
    ("diseases", "severity_level", 6, "severity_in_range", "severity_in_range"),
    ("diseases", "severity_level", None, "severity_in_range", "severity_in_range"),
    ("attendance", "patient_id", None, "attendance_patient_present", "patient_id_present"),
    ("attendance", "doctor_id", None, "attendance_doctor_present", "doctor_id_present"),
    ("attendance", "hospital_id", None, "attendance_hospital_present", "hospital_id_present"),
    ("attendance", "disease_id", None, "attendance_disease_present", "disease_id_present"),
    ("attendance", "attendance_timestamp", AS_OF, None, None),
    ("attendance", "attendance_timestamp", datetime(2026, 8, 10, 12, 0, 1), "attendance_date_valid", None),
    ("attendance", "attendance_timestamp", None, "attendance_date_valid", None),
    ("attendance", "attendance_date", None, None, "attendance_date_present"),
    ("attendance", "wait_time_minutes", None, None, None),
    ("attendance", "wait_time_minutes", 0, None, None),
    ("attendance", "wait_time_minutes", 300, None, None),
    ("attendance", "wait_time_minutes", 301, "wait_time_in_range", None),
    ("attendance", "wait_time_minutes", -1, "wait_time_in_range", None),
    ("attendance", "cost", None, None, None),
    ("attendance", "cost", Decimal("0.00"), None, None),
    ("attendance", "cost", Decimal("-0.01"), "cost_non_negative", "cost_non_negative"),
    ("attendance", "severity_score", 6, "severity_in_range", "severity_in_range"),
    ("attendance", "severity_score", None, "severity_in_range", "severity_in_range"),
    ("attendance", "discharge_flag", None, None, None),
    ("attendance", "discharge_flag", 2, "discharge_flag_allowed", None),
]


def frame_of(spark, entity, rows):
    names = [part.split()[0] for part in TYPES[entity].split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TYPES[entity])


@pytest.mark.parametrize("entity", TYPES)
def test_truth_table(spark, entity):
    cases = [c for c in CASES if c[0] == entity]
    key = TYPES[entity].split()[0]
    rows = [{key: i, **GOOD[entity], column: value} for i, (_, column, value, _, _) in enumerate(cases)]
    # Key rules: two copies fail, a missing key fails; a single one passes.
    rows += [{key: 1000, **GOOD[entity]}] * 2 + [{key: None, **GOOD[entity]}]
    frame = frame_of(spark, entity, rows)
    for position, stage in enumerate(STAGES):
        noted = annotate(frame, rules_for(stage, entity, AS_OF)).collect()
        found = {r[key]: r["_dq_errors"] for r in noted if r[key] not in (1000, None)}
        for number, case in enumerate(cases):
            expected = case[3 + position]
            assert found[number] == ([expected] if expected else []), case
        assert [r["_dq_errors"] for r in noted if r[key] == 1000] == [[f"{key}_unique"]] * 2
        assert [r["_dq_errors"] for r in noted if r[key] is None] == [[f"{key}_present"]]




def test_pack_sizes(spark):
    sizes = {
        stage: [len(rules_for(stage, entity)) for entity in TYPES] for stage in STAGES
    }
    assert sizes == {BEFORE_SILVER: [5, 4, 4, 3, 11], BEFORE_GOLD: [3, 3, 3, 3, 9]}


def test_missing_keys_are_repeated_keys(spark):
    frame = spark.createDataFrame([(None,), (None,), (1,)], "k BIGINT")
    noted = annotate(frame, [not_null("k_present", "k"), unique_key("k", "k")]).collect()
    assert sorted(r["_dq_errors"] for r in noted) == [[], ["k_present", "k_unique"], ["k_present", "k_unique"]]


def test_split_and_tally_agree_with_brute_force(spark):
    data = [(i % 37 if i % 11 else None, i % 7 - 3, i) for i in range(400)]
    frame = spark.createDataFrame(data, "k BIGINT, v INT, i INT").repartition(4)
    rules = [not_null("k_present", "k"), unique_key("k", "k"), sql_rule("v_ok", "v >= 0 AND k > 3")]
    copies = {}
    for k, _, _ in data:
        copies[k] = copies.get(k, 0) + 1
    bad = {i for k, v, i in data if k is None or copies[k] > 1 or not (v >= 0 and k > 3)}
    valid, invalid = split(frame, rules)
    assert {r["i"] for r in invalid.collect()} == bad
    assert {r["i"] for r in valid.collect()} == {i for _, _, i in data} - bad
    for pack in (rules, [rules[0], rules[2]], [*rules, unique_key("i", "i")]):
        counts = tally(frame, pack).first()
        assert counts["checked_rows"] == 400
        assert counts["quarantined_rows"] == rejected(frame, pack).count()
        assert counts["valid_rows"] + counts["quarantined_rows"] == 400


def test_known_key_count_does_not_change_the_result(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (2, -1), (3, 1)], "k BIGINT, v INT")
    rules = [unique_key("k", "k"), sql_rule("v_ok", "v > 0")]
    expected = sorted(tuple(r) for r in rejected(frame, rules).collect())
    count = tally(frame, rules).first()["repeated_keys"]
    assert count == 1
    assert sorted(tuple(r) for r in rejected(frame, rules, repeated=count).collect()) == expected
    unique = frame.where("k > 1")
    assert [r["v"] for r in rejected(unique, rules, repeated=0).collect()] == [-1]


def test_tally_of_nothing(spark):
    empty = spark.createDataFrame([], "k BIGINT")
    assert tuple(tally(empty, [unique_key("k", "k")]).first()) == (0, 0, 0, 0)
