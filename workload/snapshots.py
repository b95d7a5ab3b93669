"""Snapshot queries: cleaning, gates, Gold, figures, reconciliation, profiles."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.casts import text_as, whole_number
from sluice.functions.masking import mask_columns
from sluice.model import ENTITIES
from sluice.operators.checks import ERRORS, accepted, annotate, rejected, rule_outcomes, tally
from sluice.operators.cleaning import clean, clean_counted, path_odate, with_effective_odate
from sluice.operators.dedup import keep_latest
from sluice.operators.kpi import busiest_days, daily_kpi
from sluice.operators.profile import (
    EXPECTED_DUPLICATES,
    EXPECTED_NULLS,
    against_expected,
    profile,
)
from sluice.operators.reconcile import (
    align_to_parent,
    existing,
    null_out_of_range,
    orphan_counts,
    sanitize_snapshots,
    with_contract,
)
from sluice.operators.rules import sql_rule
from sluice.operators.snapshots import (
    key_changes,
    previous_snapshot,
    roll_forward,
    snapshot_delta,
)
from sluice.plans.monitoring import gold_freshness
from sluice.plans.rulebook import BEFORE_GOLD, BEFORE_SILVER, rules_for
from workload.derive import AS_OF, NOW_SQL, Duck, Spark, columns_of, frame, load, sql
from workload.registry import error_list, half_up, register

# -- cleaning --------------------------------------------------------------


def _num(column: str, kind: str = "BIGINT") -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS {kind})"


_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
TYPED_SQL = {
    "patients": {
        "patient_id": _num("patient_id"),
        "full_name": "left(trim(full_name), 1) || '***'",
        "cpf": f"'***.***.***-' || right({_DIGITS.format('cpf')}, 2)",
        "email": "left(lower(trim(email)), 1) || '***@' "
        "|| regexp_extract(lower(trim(email)), '@(.+)$', 1)",
        "phone": f"'***-' || right({_DIGITS.format('phone')}, 4)",
        "gender": "upper(trim(gender))",
        "blood_type": "upper(trim(blood_type))",
        "birth_date": "TRY_CAST(birth_date AS DATE)",
        "city": "trim(city)",
        "state": "upper(trim(state))",
        "created_at": "TRY_CAST(created_at AS TIMESTAMP)",
    },
    "hospitals": {
        "hospital_id": _num("hospital_id"),
        "hospital_name": "trim(hospital_name)",
        "hospital_type": "trim(hospital_type)",
        "state": "upper(trim(state))",
        "city": "trim(city)",
        "capacity": _num("capacity", "INT"),
        "created_at": "TRY_CAST(created_at AS TIMESTAMP)",
    },
    "doctors": {
        "doctor_id": _num("doctor_id"),
        "doctor_name": "trim(doctor_name)",
        "crm": _num("crm"),
        "specialty": "trim(specialty)",
        "hospital_id": _num("hospital_id"),
        "created_at": "TRY_CAST(created_at AS TIMESTAMP)",
    },
    "diseases": {
        "disease_id": _num("disease_id"),
        "disease_name": "trim(disease_name)",
        "category": "trim(category)",
        "severity_level": _num("severity_level", "INT"),
        "created_at": "TRY_CAST(created_at AS TIMESTAMP)",
    },
    "attendance": {
        "attendance_id": _num("attendance_id"),
        "patient_id": _num("patient_id"),
        "doctor_id": _num("doctor_id"),
        "hospital_id": _num("hospital_id"),
        "disease_id": _num("disease_id"),
        "attendance_timestamp": "TRY_CAST(attendance_date AS TIMESTAMP)",
        "attendance_date": "TRY_CAST(TRY_CAST(attendance_date AS TIMESTAMP) AS DATE)",
        "wait_time_minutes": _num("wait_time_minutes", "INT"),
        "cost": "TRY_CAST(cost AS DECIMAL(12,2))",
        "severity_score": _num("severity_score", "INT"),
        "is_discharged": f"{_num('discharge_flag', 'INT')} = 1",
        "created_at": "TRY_CAST(created_at AS TIMESTAMP)",
    },
}
REQUIRED_SQL = {
    "patients": "birth_date gender state",
    "hospitals": "capacity state",
    "doctors": "crm hospital_id",
    "diseases": "severity_level",
    "attendance": "patient_id doctor_id hospital_id disease_id attendance_timestamp severity_score",
}


def cleaned(spark, sf_dir, entity: str, for_gate: bool = False) -> DataFrame:
    return clean(frame(spark, sf_dir, entity), entity, for_gate)


def cleaned_sql(entity: str, for_gate: bool = False) -> str:
    columns = columns_of(entity)
    key = columns[0]
    others = [c for c in columns if c not in (key, "_ingested_at", "_source_file")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["_ingested_at", "_source_file", *others])
    typed = dict(TYPED_SQL[entity])
    if for_gate and entity == "attendance":
        typed["discharge_flag"] = _num("discharge_flag", "INT")
    listed = ", ".join(f"{e} AS {c}" for c, e in typed.items())
    needed = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_SQL[entity].split())
    return (
        f"SELECT * FROM (SELECT {listed}, odate, _source_file, _ingested_at FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM ({sql(entity)}) r) k WHERE rn = 1) t WHERE {needed}"
    )


for _name in ENTITIES:
    register(f"clean_{_name}", lambda s, d, n=_name: cleaned(s, d, n), cleaned_sql(_name))


def typed_casts(spark, sf_dir) -> DataFrame:
    raw = frame(spark, sf_dir, "attendance")
    return raw.select(
        "attendance_id",
        whole_number("attendance_id").alias("as_bigint"),
        whole_number("wait_time_minutes", "int").alias("as_int"),
        text_as("cost", "decimal(12,2)").alias("as_money"),
        text_as("attendance_date", "date").alias("as_date"),
        text_as("attendance_date", "timestamp").alias("as_time"),
    )


register(
    "typed_casts",
    typed_casts,
    f"SELECT attendance_id, {_num('attendance_id')} AS as_bigint, "
    f"{_num('wait_time_minutes', 'INT')} AS as_int, "
    "TRY_CAST(cost AS DECIMAL(12,2)) AS as_money, "
    "TRY_CAST(TRY_CAST(attendance_date AS TIMESTAMP) AS DATE) AS as_date, "
    f"TRY_CAST(attendance_date AS TIMESTAMP) AS as_time FROM ({sql('attendance')}) r",
)


def effective_odate(spark, sf_dir) -> DataFrame:
    """Orders whose date is lost unless fulfilled; the path may still name it."""
    path = (
        "CASE WHEN o_orderstatus = 'P' THEN 's3/raw/orders/not-odate=' ELSE 's3/raw/orders/odate=' "
        "END || CAST(CAST(o_orderdate AS DATE) AS STRING) || '/orders.csv'"
    )
    stored = "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END"
    orders = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{stored} AS odate", f"{path} AS _source_file"
    )
    named = orders.withColumn("path_odate", path_odate(F.col("_source_file")))
    return with_effective_odate(named)


register(
    "effective_odate",
    effective_odate,
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 's3/raw/orders/not-odate=' "
    "ELSE 's3/raw/orders/odate=' END || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) "
    "|| '/orders.csv' AS _source_file, "
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS path_odate, "
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS odate FROM orders",
)

register(
    "snapshot_dedup",
    lambda s, d: keep_latest(
        load(s, d, "orders"),
        ["o_custkey"],
        [F.col("o_orderdate").desc_nulls_last()],
        tie_break=["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"],
    ),
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY "
    "o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM orders) t WHERE rn = 1",
)

register(
    "mask_identifiers",
    lambda s, d: mask_columns(
        frame(s, d, "patients").select("patient_id", "full_name", "cpf", "email", "phone")
    ),
    "SELECT patient_id, "
    + ", ".join(f"{TYPED_SQL['patients'][c]} AS {c}" for c in ("full_name", "cpf", "email", "phone"))
    + f" FROM ({sql('patients')}) r",
)

# -- gates -----------------------------------------------------------------

_ID = "{0} IS NOT NULL"
_UNIQUE = "count(*) OVER (PARTITION BY {0}) = 1"
_STATE = "regexp_matches(state, '^[A-Z]{2}$')"


def _key_rules(key: str) -> dict[str, str]:
    return {f"{key}_present": _ID.format(key), f"{key}_unique": _UNIQUE.format(key)}


RULES_SQL = {
    (BEFORE_SILVER, "patients"): {
        **_key_rules("patient_id"),
        "birth_date_not_future": f"birth_date <= CAST({NOW_SQL} AS DATE)",
        "gender_allowed": "gender IN ('M', 'F')",
        "state_is_uf": _STATE,
    },
    (BEFORE_SILVER, "hospitals"): {
        **_key_rules("hospital_id"),
        "capacity_in_range": "capacity BETWEEN 1 AND 2000",
        "state_is_uf": _STATE,
    },
    (BEFORE_SILVER, "doctors"): {
        **_key_rules("doctor_id"),
        "crm_positive": "crm > 0",
        "doctor_hospital_present": "hospital_id IS NOT NULL",
    },
    (BEFORE_SILVER, "diseases"): {
        **_key_rules("disease_id"),
        "severity_in_range": "severity_level BETWEEN 1 AND 5",
    },
    (BEFORE_SILVER, "attendance"): {
        **_key_rules("attendance_id"),
        "attendance_patient_present": "patient_id IS NOT NULL",
        "attendance_doctor_present": "doctor_id IS NOT NULL",
        "attendance_hospital_present": "hospital_id IS NOT NULL",
        "attendance_disease_present": "disease_id IS NOT NULL",
        "attendance_date_valid": f"attendance_timestamp <= {NOW_SQL}",
        "wait_time_in_range": "wait_time_minutes IS NULL OR wait_time_minutes BETWEEN 0 AND 300",
        "cost_non_negative": "cost IS NULL OR cost >= 0",
        "severity_in_range": "severity_score BETWEEN 1 AND 5",
        "discharge_flag_allowed": "discharge_flag IS NULL OR discharge_flag IN (0, 1)",
    },
    (BEFORE_GOLD, "patients"): {
        **_key_rules("patient_id"),
        "odate_present": "odate IS NOT NULL",
    },
    (BEFORE_GOLD, "hospitals"): {
        **_key_rules("hospital_id"),
        "capacity_in_range": "capacity BETWEEN 1 AND 2000",
    },
    (BEFORE_GOLD, "doctors"): {
        **_key_rules("doctor_id"),
        "hospital_id_present": "hospital_id IS NOT NULL",
    },
    (BEFORE_GOLD, "diseases"): {
        **_key_rules("disease_id"),
        "severity_in_range": "severity_level BETWEEN 1 AND 5",
    },
    (BEFORE_GOLD, "attendance"): {
        **_key_rules("attendance_id"),
        "attendance_date_present": "attendance_date IS NOT NULL",
        "patient_id_present": "patient_id IS NOT NULL",
        "doctor_id_present": "doctor_id IS NOT NULL",
        "hospital_id_present": "hospital_id IS NOT NULL",
        "disease_id_present": "disease_id IS NOT NULL",
        "cost_non_negative": "cost IS NULL OR cost >= 0",
        "severity_in_range": "severity_score BETWEEN 1 AND 5",
    },
}
GATE = {BEFORE_SILVER: "gate1", BEFORE_GOLD: "gate2"}
COPIES = "__copies"


def _checked(spark, sf_dir, stage: str, entity: str) -> DataFrame:
    return cleaned(spark, sf_dir, entity, for_gate=stage == BEFORE_SILVER)


def _counted(spark, sf_dir, stage: str, entity: str) -> DataFrame:
    """``_checked`` with the copies of each typed key."""
    return clean_counted(frame(spark, sf_dir, entity), entity, COPIES, stage == BEFORE_SILVER)


def _checked_sql(stage: str, entity: str) -> str:
    rules = error_list(RULES_SQL[stage, entity])
    return f"SELECT *, {rules} AS _dq_errors FROM ({cleaned_sql(entity, stage == BEFORE_SILVER)}) c"


def _joined(errors: DataFrame) -> DataFrame:
    return errors.withColumn(ERRORS, F.array_join(ERRORS, ","))


def _gate_rejected(spark, sf_dir, stage: str, entity: str) -> DataFrame:
    checked = _counted(spark, sf_dir, stage, entity)
    return _joined(rejected(checked, rules_for(stage, entity, AS_OF), copies=COPIES))


def _gate_accepted(spark, sf_dir, stage: str, entity: str) -> DataFrame:
    checked = _counted(spark, sf_dir, stage, entity)
    return accepted(checked, rules_for(stage, entity, AS_OF), copies=COPIES)


def _gate_tally(spark, sf_dir, stage: str) -> DataFrame:
    parts = [
        tally(_checked(spark, sf_dir, stage, e), rules_for(stage, e, AS_OF)).select(
            F.lit(e).alias("entity"), "checked_rows", "valid_rows", "quarantined_rows"
        )
        for e in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


def _gate_tally_sql(stage: str) -> str:
    parts = (
        f"SELECT '{e}' AS entity, count(*) AS checked_rows, "
        "count(*) FILTER (WHERE _dq_errors = '') AS valid_rows, "
        "count(*) FILTER (WHERE _dq_errors <> '') AS quarantined_rows "
        f"FROM ({_checked_sql(stage, e)}) q"
        for e in ENTITIES
    )
    return " UNION ALL ".join(parts)


for _stage, _label in GATE.items():
    register(
        f"{_label}_tally", lambda s, d, st=_stage: _gate_tally(s, d, st), _gate_tally_sql(_stage)
    )
    for _name in ENTITIES:
        register(
            f"{_label}_rejected_{_name}",
            lambda s, d, st=_stage, n=_name: _gate_rejected(s, d, st, n),
            f"SELECT * FROM ({_checked_sql(_stage, _name)}) q WHERE _dq_errors <> ''",
        )
register(
    "gate1_accepted_attendance",
    lambda s, d: _gate_accepted(s, d, BEFORE_SILVER, "attendance"),
    f"SELECT * EXCLUDE (_dq_errors) FROM ({_checked_sql(BEFORE_SILVER, 'attendance')}) q "
    "WHERE _dq_errors = ''",
)


def _violations_by_rule(spark, sf_dir) -> DataFrame:
    checked = _counted(spark, sf_dir, BEFORE_SILVER, "attendance")
    noted = annotate(checked, rules_for(BEFORE_SILVER, "attendance", AS_OF), copies=COPIES)
    exploded = noted.select(F.explode(ERRORS).alias("dq_rule"))
    return exploded.groupBy("dq_rule").agg(F.count(F.lit(1)).alias("violations"))


register(
    "dq_rule_counts",
    _violations_by_rule,
    "SELECT dq_rule, count(*) AS violations FROM (SELECT unnest(string_split(_dq_errors, ',')) "
    f"AS dq_rule FROM ({_checked_sql(BEFORE_SILVER, 'attendance')}) q WHERE _dq_errors <> '') u "
    "GROUP BY dq_rule",
)


#: Rules as SQL text over the cleaned visits; unknown counts as broken.
_SQL_RULES = {
    "expensive_or_quick": "cost > 30000 OR wait_time_minutes < 120",
    "seen_when_created": "attendance_timestamp <= created_at",
    "severe_if_discharged": "NOT is_discharged OR severity_score > 1",
}


def _sql_rules(spark, sf_dir) -> DataFrame:
    rules = [sql_rule(name, text) for name, text in _SQL_RULES.items()]
    noted = annotate(_checked(spark, sf_dir, BEFORE_SILVER, "attendance"), rules)
    return _joined(noted).select("attendance_id", "hospital_id", ERRORS)


register(
    "dq_sql_rules",
    _sql_rules,
    f"SELECT attendance_id, hospital_id, {error_list(_SQL_RULES)} AS _dq_errors "
    f"FROM ({cleaned_sql('attendance', True)}) c",
)


def _row_rule_outcomes(spark, sf_dir) -> DataFrame:
    checked = _checked(spark, sf_dir, BEFORE_SILVER, "attendance")
    return rule_outcomes(checked, rules_for(BEFORE_SILVER, "attendance", AS_OF))


register(
    "dq_rule_outcomes",
    _row_rule_outcomes,
    " UNION ALL ".join(
        f"SELECT '{n}' AS dq_rule, count(*) FILTER (WHERE coalesce({p}, false)) AS passed_records, "
        f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed_records "
        f"FROM ({cleaned_sql('attendance', True)}) c"
        for n, p in RULES_SQL[BEFORE_SILVER, "attendance"].items()
        if not n.endswith("_unique")
    ),
)

# -- Gold ------------------------------------------------------------------


def published(spark, sf_dir, entity: str) -> DataFrame:
    return cleaned(spark, sf_dir, entity).select(*ENTITIES[entity].published)


def published_sql(entity: str) -> str:
    return f"SELECT {', '.join(ENTITIES[entity].published)} FROM ({cleaned_sql(entity)}) c"


for _name in ENTITIES:
    register(f"gold_{_name}", lambda s, d, n=_name: published(s, d, n), published_sql(_name))


def _visits(spark, sf_dir) -> DataFrame:
    """Line items as typed visits, without any text in between."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "DATE '2024-01-31' AS odate",
        "l_suppkey AS hospital_id",
        "CAST(l_shipdate AS DATE) AS attendance_date",
        "l_orderkey AS attendance_id",
        "CAST(l_quantity AS INT) AS wait_time_minutes",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS cost",
        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_discharged",
    )


def _facilities(spark, sf_dir) -> DataFrame:
    """Suppliers as hospitals, one row per key; those in debt have no city."""
    suppliers = keep_latest(
        load(spark, sf_dir, "supplier"),
        ["s_suppkey"],
        [F.col(c).desc_nulls_last() for c in ("s_name", "s_nationkey", "s_acctbal")],
    )
    return suppliers.selectExpr(
        "DATE '2024-01-31' AS odate",
        "s_suppkey AS hospital_id",
        "s_name AS hospital_name",
        "CASE WHEN s_acctbal < 3000 THEN 'Public' ELSE 'Private' END AS hospital_type",
        "CAST(s_nationkey AS STRING) AS state",
        "CASE WHEN s_acctbal >= 0 THEN 'City ' || CAST(s_nationkey AS STRING) END AS city",
    )


_VISITS_SQL = (
    "SELECT DATE '2024-01-31' AS odate, l_suppkey AS hospital_id, "
    "CAST(l_shipdate AS DATE) AS attendance_date, l_orderkey AS attendance_id, "
    "CAST(l_quantity AS INT) AS wait_time_minutes, "
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS cost, "
    "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_discharged FROM lineitem"
)
_FACILITIES_SQL = (
    "SELECT DATE '2024-01-31' AS odate, s_suppkey AS hospital_id, s_name AS hospital_name, "
    "CASE WHEN s_acctbal < 3000 THEN 'Public' ELSE 'Private' END AS hospital_type, "
    "CAST(s_nationkey AS VARCHAR) AS state, "
    "CASE WHEN s_acctbal >= 0 THEN 'City ' || CAST(s_nationkey AS VARCHAR) END AS city "
    "FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY s_name DESC NULLS LAST, "
    "s_nationkey DESC NULLS LAST, s_acctbal DESC NULLS LAST) AS rn FROM supplier) k WHERE rn = 1"
)


def kpi_sql(visits: str, facilities: str) -> str:
    return (
        "SELECT a.odate, a.attendance_date, a.hospital_id, h.hospital_name, h.hospital_type, "
        "h.state, h.city, a.attendance_count, "
        f"{half_up('a.wait', 2)} AS avg_wait_time_minutes, "
        "CAST(round(a.total, 2) AS DECIMAL(23,2)) AS total_cost, "
        f"{half_up('a.rate', 4)} AS discharge_rate FROM ("
        "SELECT odate, hospital_id, attendance_date, count(attendance_id) AS attendance_count, "
        "avg(wait_time_minutes) AS wait, sum(cost) AS total, "
        "avg(CAST(CAST(is_discharged AS INT) AS DOUBLE)) AS rate "
        f"FROM ({visits}) v GROUP BY ALL) a LEFT JOIN ({facilities}) h "
        "ON a.odate = h.odate AND a.hospital_id = h.hospital_id"
    )


def kpi_daily(spark, sf_dir) -> DataFrame:
    return daily_kpi(_visits(spark, sf_dir), _facilities(spark, sf_dir))


def kpi_from_snapshots(spark, sf_dir) -> DataFrame:
    return daily_kpi(published(spark, sf_dir, "attendance"), published(spark, sf_dir, "hospitals"))


_KPI_SQL = kpi_sql(_VISITS_SQL, _FACILITIES_SQL)
register("kpi_daily", kpi_daily, _KPI_SQL)
register(
    "kpi_from_snapshots",
    kpi_from_snapshots,
    kpi_sql(published_sql("attendance"), published_sql("hospitals")),
)
register(
    "kpi_top20",
    lambda s, d: busiest_days(kpi_daily(s, d)),
    f"SELECT * FROM ({_KPI_SQL}) k ORDER BY attendance_date DESC, attendance_count DESC, "
    "odate DESC, hospital_id LIMIT 20",
)
register(
    "attendance_rows",
    lambda s, d: _visits(s, d).agg(F.count(F.lit(1)).alias("attendance_rows")),
    "SELECT count(*) AS attendance_rows FROM lineitem",
)

#: Dates of the six published tables: a test table and an expression over it.
_DATED = {
    "attendance": ("lineitem", lambda d: "CAST(l_shipdate AS DATE)"),
    "patients": ("orders", lambda d: "CAST(o_orderdate AS DATE)"),
    "hospitals": ("supplier", lambda d: d.plus_days("DATE '2023-11-01'", "s_nationkey")),
    "doctors": ("part", lambda d: d.plus_days("DATE '2023-12-01'", "p_size")),
    "diseases": ("documents", lambda d: d.plus_days("DATE '2023-12-15'", "n_chars % 40")),
    "kpi_hospital_daily": ("events", lambda d: "CAST(ts AS DATE)"),
}


def _gold_freshness(spark, sf_dir) -> DataFrame:
    tables = {
        name: load(spark, sf_dir, table).selectExpr(f"{day(Spark)} AS odate")
        for name, (table, day) in _DATED.items()
    }
    return gold_freshness(tables, AS_OF)


_FRESHNESS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, max(odate) AS latest_odate, "
    "count(DISTINCT odate) AS partition_count, count(*) AS historical_rows, "
    f"date_diff('day', max(odate), CAST({NOW_SQL} AS DATE)) AS age_days "
    f"FROM (SELECT {day(Duck)} AS odate FROM {t}) t"
    for name, (t, day) in _DATED.items()
)
register("gold_freshness", _gold_freshness, _FRESHNESS_SQL)

# -- sanitising and references ---------------------------------------------


def _sanitized(spark, sf_dir) -> dict[str, DataFrame]:
    """Raw snapshots sanitised together; the ingestion time orders repeated keys."""
    raw = {e: frame(spark, sf_dir, e) for e in ENTITIES}
    return sanitize_snapshots(raw, position=("_ingested_at", "_source_file"), as_of=AS_OF)


def _last_sql(rows: str, entity: str) -> str:
    raw = ENTITIES[entity].raw
    rest = ", ".join(f"{c} DESC NULLS LAST" for c in raw[1:])
    return (
        f"SELECT {', '.join(raw)} FROM (SELECT *, row_number() OVER (PARTITION BY {raw[0]} ORDER BY "
        f"_ingested_at DESC NULLS LAST, _source_file DESC NULLS LAST, {rest}) AS rn "
        f"FROM ({rows}) v) k WHERE rn = 1"
    )


def _d(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


def _i(column: str) -> str:
    return f"CAST(trunc({_d(column)}) AS BIGINT)"


_UP = "upper(trim({0}))"
_SANE_PATIENTS = _last_sql(
    f"SELECT * REPLACE ({_i('patient_id')} AS patient_id, {_UP.format('gender')} AS gender, "
    f"{_UP.format('state')} AS state, TRY_CAST(birth_date AS DATE) AS birth_date) "
    f"FROM ({sql('patients')}) r WHERE {_d('patient_id')} > 0 "
    f"AND {_UP.format('gender')} IN ('M', 'F') "
    f"AND regexp_matches({_UP.format('state')}, '^[A-Z]{{2}}$') "
    f"AND TRY_CAST(birth_date AS TIMESTAMP) <= {NOW_SQL}",
    "patients",
)
_SANE_HOSPITALS = _last_sql(
    f"SELECT * REPLACE ({_i('hospital_id')} AS hospital_id, {_UP.format('state')} AS state, "
    f"{_i('capacity')} AS capacity) FROM ({sql('hospitals')}) r WHERE {_d('hospital_id')} > 0 "
    f"AND regexp_matches({_UP.format('state')}, '^[A-Z]{{2}}$') "
    f"AND {_d('capacity')} BETWEEN 1 AND 2000",
    "hospitals",
)
_SANE_DISEASES = _last_sql(
    f"SELECT * REPLACE ({_i('disease_id')} AS disease_id, {_i('severity_level')} AS severity_level) "
    f"FROM ({sql('diseases')}) r WHERE {_d('disease_id')} > 0 "
    f"AND {_d('severity_level')} BETWEEN 1 AND 5",
    "diseases",
)
_SANE_DOCTORS = _last_sql(
    f"SELECT * REPLACE ({_i('doctor_id')} AS doctor_id, {_i('hospital_id')} AS hospital_id, "
    f"{_i('crm')} AS crm) FROM ({sql('doctors')}) r WHERE {_d('doctor_id')} > 0 "
    f"AND {_d('crm')} > 0 AND {_d('hospital_id')} IN (SELECT hospital_id FROM ({_SANE_HOSPITALS}) h)",
    "doctors",
)
_SANE_ATTENDANCE = _last_sql(
    f"SELECT r.* REPLACE ({_i('attendance_id')} AS attendance_id, {_i('r.patient_id')} AS patient_id, "
    f"{_i('r.doctor_id')} AS doctor_id, o.hospital_id AS hospital_id, "
    f"{_i('disease_id')} AS disease_id, "
    "TRY_CAST(attendance_date AS TIMESTAMP) AS attendance_date, "
    f"CASE WHEN {_d('wait_time_minutes')} BETWEEN 0 AND 300 THEN {_d('wait_time_minutes')} END "
    f"AS wait_time_minutes, CASE WHEN {_d('cost')} >= 0 THEN {_d('cost')} END AS cost, "
    f"{_i('severity_score')} AS severity_score, "
    f"CASE WHEN {_d('discharge_flag')} IN (0, 1) THEN {_d('discharge_flag')} END "
    f"AS discharge_flag) FROM ({sql('attendance')}) r "
    f"JOIN ({_SANE_DOCTORS}) o ON {_d('r.doctor_id')} = o.doctor_id "
    f"WHERE {_d('attendance_id')} > 0 "
    f"AND {_d('r.patient_id')} IN (SELECT patient_id FROM ({_SANE_PATIENTS}) p) "
    f"AND {_d('disease_id')} IN (SELECT disease_id FROM ({_SANE_DISEASES}) s) "
    f"AND TRY_CAST(attendance_date AS TIMESTAMP) <= {NOW_SQL} "
    f"AND {_d('severity_score')} BETWEEN 1 AND 5",
    "attendance",
)
for _name, _text in {
    "patients": _SANE_PATIENTS,
    "hospitals": _SANE_HOSPITALS,
    "diseases": _SANE_DISEASES,
    "doctors": _SANE_DOCTORS,
    "attendance": _SANE_ATTENDANCE,
}.items():
    register(f"sanitize_{_name}", lambda s, d, n=_name: _sanitized(s, d)[n], _text)


def _orphans(spark, sf_dir) -> DataFrame:
    """Line items against the parties that really trade: large customers' orders etc."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F")
    parts = load(spark, sf_dir, "part").where(F.col("p_size") > 5)
    suppliers = load(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    return orphan_counts(
        lines,
        {
            "l_orderkey": (orders, "o_orderkey"),
            "l_partkey": (parts, "p_partkey"),
            "l_suppkey": (suppliers, "s_suppkey"),
        },
    )


register(
    "orphans",
    _orphans,
    " UNION ALL ".join(
        f"SELECT '{c}' AS reference, count(*) AS orphan_rows, count(DISTINCT {c}) AS orphan_values "
        f"FROM lineitem WHERE {c} NOT IN (SELECT {k} FROM {t} WHERE {w})"
        for c, k, t, w in (
            ("l_orderkey", "o_orderkey", "orders", "o_orderstatus <> 'F'"),
            ("l_partkey", "p_partkey", "part", "p_size > 5"),
            ("l_suppkey", "s_suppkey", "supplier", "s_acctbal > 0"),
        )
    ),
)


def _referential(spark, sf_dir) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    suppliers = load(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    parts = load(spark, sf_dir, "part").where(F.col("p_size") > 5)
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F")
    kept = existing(lines, "l_suppkey", suppliers, "s_suppkey")
    kept = existing(kept, "l_partkey", parts, "p_partkey")
    return existing(kept, "l_orderkey", orders, "o_orderkey")


register(
    "referential_clean",
    _referential,
    "SELECT * FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) "
    "AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5) "
    "AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')",
)


def _aligned(spark, sf_dir) -> DataFrame:
    """Visits take the hospital of their doctor (here: the part's size)."""
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey AS doctor_id", "l_suppkey AS hospital_id"
    )
    homes = load(spark, sf_dir, "part").selectExpr(
        "p_partkey AS doctor_id", "CAST(p_size AS BIGINT) AS hospital_id"
    )
    return align_to_parent(lines, "doctor_id", "hospital_id", homes, "doctor_id")


register(
    "align_parent",
    _aligned,
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey AS doctor_id, "
    "CAST(p_size AS BIGINT) AS hospital_id FROM lineitem LEFT JOIN "
    "(SELECT p_partkey, max(p_size) AS p_size FROM part GROUP BY 1) p ON l_partkey = p_partkey",
)


def _repaired(spark, sf_dir) -> DataFrame:
    return frame(spark, sf_dir, "attendance").select(
        "attendance_id",
        null_out_of_range("wait_time_minutes", 0, 300).alias("wait_time_minutes"),
        null_out_of_range("cost", 0).alias("cost"),
    )


register(
    "range_repair",
    _repaired,
    f"SELECT attendance_id, CASE WHEN {_d('wait_time_minutes')} BETWEEN 0 AND 300 THEN "
    f"{_d('wait_time_minutes')} END AS wait_time_minutes, CASE WHEN {_d('cost')} >= 0 "
    f"THEN {_d('cost')} END AS cost FROM ({sql('attendance')}) r",
)
register(
    "contract_projection",
    lambda s, d: with_contract(
        load(s, d, "part"), ["p_partkey", "p_comment", "p_type", "p_container", "p_size"]
    ),
    "SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_comment, p_type, "
    "CAST(NULL AS VARCHAR) AS p_container, p_size FROM part",
)

# -- snapshot comparison ---------------------------------------------------


def _two_snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Customers of unfinished orders before, of urgent or finished orders after."""
    orders = load(spark, sf_dir, "orders")
    before = orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_custkey")
    after = orders.where(
        (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")
    ).select("o_orderkey", "o_custkey")
    return before, after


_BEFORE_SQL = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'"
_AFTER_SQL = (
    "SELECT o_orderkey, o_custkey FROM orders "
    "WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'"
)


def _change_sql(key: str) -> str:
    return (
        f"SELECT coalesce(p.k, c.k) AS {key}, coalesce(p.n, 0) AS previous_copies, "
        "coalesce(c.n, 0) AS current_copies, CASE WHEN p.k IS NULL THEN 'added' "
        "WHEN c.k IS NULL THEN 'removed' ELSE 'retained' END AS change FROM "
        f"(SELECT {key} AS k, count(*) AS n FROM ({_BEFORE_SQL}) b GROUP BY 1) p FULL JOIN "
        f"(SELECT {key} AS k, count(*) AS n FROM ({_AFTER_SQL}) a GROUP BY 1) c ON p.k = c.k"
    )


for _key in ("o_orderkey", "o_custkey"):
    register(
        f"snapshot_delta_{_key[2:]}",
        lambda s, d, k=_key: snapshot_delta(*_two_snapshots(s, d), k),
        "SELECT CAST(sum(previous_copies) AS BIGINT) AS previous_rows, "
        "CAST(coalesce(sum(previous_copies) FILTER (WHERE change = 'retained'), 0) AS BIGINT) "
        "AS retained_rows, "
        "CAST(coalesce(sum(previous_copies) FILTER (WHERE change = 'removed'), 0) AS BIGINT) "
        "AS removed_rows, "
        "CAST(coalesce(sum(current_copies) FILTER (WHERE change = 'added'), 0) AS BIGINT) "
        "AS added_rows, CAST(sum(current_copies) AS BIGINT) AS output_rows "
        f"FROM ({_change_sql(_key)}) x",
    )
register(
    "snapshot_changes",
    lambda s, d: key_changes(*_two_snapshots(s, d), "o_orderkey"),
    _change_sql("o_orderkey"),
)


def _rolled(spark, sf_dir) -> DataFrame:
    """Finished orders leave, urgent ones are added again without their customer."""
    before, after = _two_snapshots(spark, sf_dir)
    return roll_forward(before, after, after.select("o_orderkey"), "o_orderkey")


register(
    "snapshot_roll_forward",
    _rolled,
    f"SELECT o_orderkey, o_custkey FROM ({_BEFORE_SQL}) b WHERE o_orderkey NOT IN "
    f"(SELECT o_orderkey FROM ({_AFTER_SQL}) a) UNION ALL "
    f"SELECT o_orderkey, NULL AS o_custkey FROM ({_AFTER_SQL}) a",
)


def _previous(spark, sf_dir) -> DataFrame:
    history = load(spark, sf_dir, "orders").withColumn("odate", F.col("o_orderdate").cast("date"))
    return previous_snapshot(history, date(1999, 6, 15)).drop("o_orderdate")


register(
    "snapshot_previous",
    _previous,
    "SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS odate FROM orders "
    "WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders "
    "WHERE o_orderdate < TIMESTAMP '1999-06-15 00:00:00')",
)

# -- profiles --------------------------------------------------------------


def _profile(spark, sf_dir, entity: str) -> DataFrame:
    key = ENTITIES[entity].key
    found = profile(frame(spark, sf_dir, entity), key, list(EXPECTED_NULLS[entity]))
    return against_expected(found, EXPECTED_NULLS[entity], EXPECTED_DUPLICATES[entity], 0.02)


def _profile_sql(entity: str) -> str:
    key = ENTITIES[entity].key
    items = [(c, "nulls", f"count(*) - count({c})", e) for c, e in EXPECTED_NULLS[entity].items()]
    # A NULL key counts as one key.
    distinct = f"(count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END))"
    items.append((key, "duplicates", f"count(*) - {distinct}", EXPECTED_DUPLICATES[entity]))
    parts = (
        f"SELECT '{c}' AS item, '{k}' AS kind, count(*) AS \"rows\", CAST({h} AS BIGINT) AS hits, "
        f"({h}) / count(*) AS rate, CAST({e} AS DOUBLE) AS expected_rate, "
        f"abs(({h}) / count(*) - CAST({e} AS DOUBLE)) <= CAST(0.02 AS DOUBLE) AS within_tolerance "
        f"FROM ({sql(entity)}) r"
        for c, k, h, e in items
    )
    return " UNION ALL ".join(parts)


for _name in ENTITIES:
    register(f"profile_{_name}", lambda s, d, n=_name: _profile(s, d, n), _profile_sql(_name))
