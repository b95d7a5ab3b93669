"""The test tables seen as the engine's inputs.

Each derived table is a list of SQL expressions over one test table. Spark and
the oracle evaluate the same text; only the few functions that are spelled
differently go through ``Spark`` and ``Duck``. Whole tables are used throughout.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

ODATE = date(2024, 1, 31)
AS_OF = datetime(2024, 1, 31)
DAY_SQL = "DATE '2024-01-31'"
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


class Spark:
    @staticmethod
    def clock(value: str) -> str:
        return f"date_format({value}, 'yyyy-MM-dd HH:mm:ss')"

    @staticmethod
    def iso(value: str) -> str:
        return f"""date_format({value}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""

    @staticmethod
    def plus_seconds(value: str, seconds: str) -> str:
        return f"({value} + make_dt_interval(0, 0, 0, {seconds}))"

    @staticmethod
    def plus_days(value: str, days: str) -> str:
        return f"date_add({value}, CAST({days} AS INT))"

    @staticmethod
    def origin(parts: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts.items()) + ")"


class Duck:
    @staticmethod
    def clock(value: str) -> str:
        return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"

    @staticmethod
    def iso(value: str) -> str:
        return f"strftime({value}, '%Y-%m-%dT%H:%M:%S.%fZ')"

    @staticmethod
    def plus_seconds(value: str, seconds: str) -> str:
        return f"({value} + to_seconds({seconds}))"

    @staticmethod
    def plus_days(value: str, days: str) -> str:
        return f"CAST({value} + to_days(CAST({days} AS INT)) AS DATE)"

    @staticmethod
    def origin(parts: dict[str, str]) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in parts.items()) + "}"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(value: str) -> str:
    return f"CAST(floor({value}) AS BIGINT)"


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def _file(dataset: str, name: str) -> str:
    return f"'raw/{dataset}/odate={ODATE}/{name}.csv'"


def attendance(d) -> tuple[str, dict[str, str]]:
    """Line items as visits; repeated (order, line) pairs are the duplicates."""
    visit = text("l_orderkey * 10 + l_linenumber")
    shipped = d.clock("l_shipdate")
    return "lineitem", {
        "attendance_id": f"CASE WHEN l_returnflag = 'R' THEN {visit} || '.0' ELSE {visit} END",
        "patient_id": text("l_partkey"),
        "doctor_id": text("l_partkey") + " || '.0'",
        "hospital_id": text("l_suppkey"),
        "disease_id": text("l_quantity"),
        "attendance_date": (
            "CASE WHEN l_discount > CAST(0.095 AS DOUBLE) THEN 'unknown' "
            f"ELSE {shipped} END"
        ),
        "wait_time_minutes": (
            "CASE WHEN l_discount < CAST(0.005 AS DOUBLE) THEN 'n/a' "
            f"ELSE {text('l_quantity * 8')} END"
        ),
        "cost": (
            "CASE WHEN l_tax > CAST(0.075 AS DOUBLE) THEN '-' ELSE '' END || "
            + text("l_extendedprice")
        ),
        "severity_score": f"CASE WHEN l_tax < CAST(0.005 AS DOUBLE) THEN '' "
        f"ELSE {text('l_linenumber')} || '.0' END",
        "discharge_flag": (
            "CASE WHEN l_linenumber = 5 AND l_quantity > 45 THEN '2' "
            "WHEN l_returnflag = 'R' THEN '1.0' WHEN l_returnflag = 'A' THEN '0' END"
        ),
        "created_at": shipped,
        "_source_file": f"'raw/attendance/odate={ODATE}/' || lower(l_linestatus) || '.csv'",
        "_ingested_at": "CAST(l_shipdate AS TIMESTAMP)",
        "odate": DAY_SQL,
    }


def patients(d) -> tuple[str, dict[str, str]]:
    digits = f"lpad({text('c_custkey')}, 11, '0')"
    cpf = " || ".join(
        [
            f"substr({digits}, 1, 3) || '.'",
            f"substr({digits}, 4, 3) || '.'",
            f"substr({digits}, 7, 3) || '-'",
            f"substr({digits}, 10, 2)",
        ]
    )
    letters = "substr('abcdefghijklmnopqrstuvwxyz', c_nationkey + 1, 2)"
    return "customer", {
        "patient_id": text("c_custkey"),
        "full_name": "' ' || c_name",
        "cpf": cpf,
        "email": (
            "CASE WHEN c_acctbal >= 0 THEN upper(c_name) || '@' || c_mktsegment "
            "|| '.Example.org' END"
        ),
        "phone": f"'(0' || {text('c_nationkey')} || ') ' || {text('c_custkey')}",
        "gender": (
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'm' WHEN 'AUTOMOBILE' THEN ' F ' "
            "WHEN 'MACHINERY' THEN 'M' WHEN 'HOUSEHOLD' THEN 'f' ELSE 'x' END"
        ),
        "blood_type": "CASE WHEN c_nationkey > 12 THEN ' a+' ELSE 'o-' END",
        "birth_date": text(d.plus_days("DATE '1940-01-01'", "floor(abs(c_acctbal) * 4)")),
        "city": f"' City ' || {text('c_nationkey')}",
        "state": (
            f"CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey < 3 THEN 'abc' "
            f"ELSE {letters} END"
        ),
        "created_at": "'2024-01-05 08:00:00'",
        "_source_file": _file("patients", "patients"),
        "_ingested_at": "TIMESTAMP '2024-01-31 06:00:00'",
        "odate": DAY_SQL,
    }


def hospitals(d) -> tuple[str, dict[str, str]]:
    letters = "substr('abcdefghijklmnopqrstuvwxyz', s_nationkey + 1, 2)"
    return "supplier", {
        "hospital_id": text("s_suppkey") + " || '.0'",
        "hospital_name": "s_name || ' '",
        "hospital_type": "CASE WHEN s_acctbal < 3000 THEN 'Public' ELSE ' Private' END",
        "state": f"CASE WHEN s_nationkey = 0 THEN '' ELSE {letters} END",
        "city": f"'City ' || {text('s_nationkey')}",
        "capacity": (
            f"CASE WHEN s_nationkey = 1 THEN 'many' ELSE {text(whole('abs(s_acctbal) / 4'))} END"
        ),
        "created_at": "'2024-01-05'",
        "_source_file": _file("hospitals", "hospitals"),
        "_ingested_at": "TIMESTAMP '2024-01-31 06:00:00'",
        "odate": DAY_SQL,
    }


def doctors(d) -> tuple[str, dict[str, str]]:
    return "part", {
        "doctor_id": text("p_partkey"),
        "doctor_name": "p_name",
        "crm": f"CASE WHEN p_size = 50 THEN '' ELSE {text('p_size - 1')} END",
        "specialty": "p_type",
        "hospital_id": f"CASE WHEN p_size = 49 THEN 'none' ELSE {text('p_size')} || '.0' END",
        "created_at": "'2024-01-05 08:00:00'",
        "_source_file": _file("doctors", "doctors"),
        "_ingested_at": "TIMESTAMP '2024-01-31 06:00:00'",
        "odate": DAY_SQL,
    }


def diseases(d) -> tuple[str, dict[str, str]]:
    return "documents", {
        "disease_id": text("doc_id"),
        "disease_name": "' ' || source",
        "category": "lang",
        "severity_level": (
            f"CASE WHEN n_chars < 100 THEN NULL ELSE {text(whole('n_chars / 800') + ' + 1')} END"
        ),
        "created_at": "'2024-01-05 08:00:00'",
        "_source_file": _file("diseases", "diseases"),
        "_ingested_at": "TIMESTAMP '2024-01-31 06:00:00'",
        "odate": DAY_SQL,
    }


def _payload(d) -> str:
    """Event payload text; cheap readings break it in one way per event type."""
    low = "value < 2"
    m = f"md5({text('event_id')})"
    uuid = (
        f"substr({m}, 1, 8) || '-' || substr({m}, 9, 4) || '-4' || substr({m}, 14, 3) || '-a' "
        f"|| substr({m}, 18, 3) || '-' || substr({m}, 21, 12)"
    )
    run = "md5(event_type)"
    run_id = (
        f"substr({run}, 1, 8) || '-' || substr({run}, 9, 4) || '-4' || substr({run}, 14, 3) "
        f"|| '-a' || substr({run}, 18, 3) || '-' || substr({run}, 21, 12)"
    )
    seen = d.iso("ts")
    parts = [
        "'{\"schema_version\": 1, \"event_id\": \"'",
        f"CASE WHEN event_type = 'purchase' AND {low} THEN 'none' ELSE {uuid} END",
        "'\", \"event_type\": \"patient_vital_signs\", \"patient_id\": '",
        text("user_id"),
        "', \"heart_rate_bpm\": '",
        text(whole("40 + value / 2")),
        "', \"oxygen_saturation_pct\": '",
        text(whole("100 - value / 8")),
        "', \"temperature_c\": '",
        # Quarter degrees: sums of them are exact, so averages do not depend on order.
        text(whole("35 + value / 60"))
        + f" || CASE length({text('user_id')}) WHEN 1 THEN '.0' WHEN 2 THEN '.25' ELSE '.5' END",
        "', \"blood_pressure_systolic_mmhg\": '",
        text(whole("100 + value / 3")),
        "', \"blood_pressure_diastolic_mmhg\": '",
        text(whole("60 + value / 4")),
        "', \"event_time\": \"'",
        f"CASE WHEN event_type = 'signup' AND {low} THEN substr({seen}, 1, 19) ELSE {seen} END",
        "'\", \"produced_at\": \"'",
        d.iso(d.plus_seconds("ts", "2")),
        "'\", \"producer_run_id\": \"'",
        run_id,
        "'\", \"source\": \"'",
        f"CASE WHEN event_type = 'error' AND {low} THEN ' ' ELSE 'device' END",
        f"CASE WHEN event_type = 'view' AND {low} THEN '\", \"extra\": \"1\"}}' ELSE '\"}}' END",
    ]
    whole_text = " || ".join(f"({part})" for part in parts)
    spoilt = f"event_type = 'click' AND {low}"
    return f"CASE WHEN {spoilt} THEN '!' ELSE '' END || {whole_text}"


def records(d) -> tuple[str, dict[str, str]]:
    """Events as broker records; late arrivals are the large ``error`` events."""
    delay = "CASE WHEN event_type = 'error' AND value > 150 THEN 90000 ELSE floor(value) END"
    queued = d.plus_seconds("ts", delay)
    return "events", {
        "key": text("user_id"),
        "value": _payload(d),
        "topic": "'vitals'",
        "partition": "CAST(length(event_type) AS INT)",
        "offset": "event_id",
        "timestamp": f"CAST({queued} AS TIMESTAMP)",
        "arrived": f"CAST({d.plus_seconds(queued, 'user_id')} AS TIMESTAMP)",
    }


def slices(d) -> tuple[str, dict[str, str]]:
    """Events as time slices of runs: a user's events of one day form one run."""
    return "events", {
        "workspace_id": "CASE WHEN event_type = 'signup' THEN 'w2' ELSE 'w1' END",
        "job_id": f"CAST(length({text('user_id')}) AS STRING)",
        "pipeline_id": f"'p' || CAST(length({text('user_id')}) AS STRING)",
        "run_id": f"{text('user_id')} || '-' || {text('CAST(ts AS DATE)')}",
        "update_id": f"{text('user_id')} || '-' || {text('CAST(ts AS DATE)')}",
        "period_start_time": "CAST(ts AS TIMESTAMP)",
        "period_end_time": (
            "CASE WHEN event_type = 'view' AND value < 5 THEN NULL "
            f"ELSE CAST({d.plus_seconds('ts', whole('value * 20'))} AS TIMESTAMP) END"
        ),
        "result_state": (
            "CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'SKIPPED' "
            "WHEN 'purchase' THEN 'SUCCEEDED' END"
        ),
        "termination_code": "CASE WHEN event_type = 'error' THEN 'USER_ERROR' ELSE 'SUCCESS' END",
    }


def event_log(d) -> tuple[str, dict[str, str]]:
    """Events as pipeline log entries; one update per day, one flow per event type."""
    k = "substr(props, 7, length(props) - 7)"
    details = " || ".join(
        [
            "'{\"flow_progress\": {\"status\": \"'",
            "(CASE WHEN value < 20 THEN 'RUNNING' ELSE 'COMPLETED' END)",
            "'\", \"metrics\": {\"num_output_rows\": '",
            text("user_id"),
            "(CASE WHEN event_type = 'click' THEN '' ELSE ', \"backlog_bytes\": ' || " + k + " END)",
            "'}, \"data_quality\": {\"dropped_records\": '",
            k,
            "', \"expectations\": [{\"name\": \"rule_a\", \"dataset\": \"'",
            "event_type",
            "'\", \"passed_records\": '",
            text("user_id"),
            "', \"failed_records\": '",
            k,
            "'}, {\"name\": \"rule_b\", \"dataset\": \"silver\", \"passed_records\": 1, "
            "\"failed_records\": 0}]}}}'",
        ]
    )
    return "events", {
        "origin": d.origin(
            {
                "update_id": (
                    "CASE WHEN value > 100 THEN NULL ELSE 'u' || "
                    f"{text('CAST(ts AS DATE)')} END"
                ),
                "pipeline_id": "CASE WHEN user_id = 0 THEN 'other' ELSE 'vitals' END",
                "flow_name": "CASE WHEN event_type = 'view' THEN NULL ELSE 'flow_' || event_type END",
                "dataset_name": "'set_' || event_type",
            }
        ),
        "event_type": "CASE WHEN event_type = 'signup' THEN 'create_update' ELSE 'flow_progress' END",
        "timestamp": "CAST(ts AS TIMESTAMP)",
        "details": details,
    }


def run_metrics(d) -> tuple[str, dict[str, str]]:
    """Orders as quality-run metrics: a customer's orders of one date share a run."""
    return "orders", {
        "checked_at": f"CAST({d.plus_days('o_orderdate', '2000')} AS TIMESTAMP)",
        "dq_run_id": f"'r' || {text('o_orderkey')}",
        "dq_stage": (
            "CASE WHEN o_orderstatus = 'P' THEN 'bronze_to_silver' ELSE 'silver_to_gold' END"
        ),
        "odate": "CAST(o_orderdate AS DATE)",
        "source_table": "o_orderpriority",
        "input_rows": f"{whole('o_totalprice')}",
        "checked_rows": f"{whole('o_totalprice - o_custkey')}",
        "valid_rows": f"{whole('o_totalprice - o_custkey')} - "
        "(CASE WHEN o_orderpriority = '1-URGENT' THEN 7 ELSE 0 END)",
        "quarantined_rows": "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN "
        "(CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 7 END) ELSE 0 END AS BIGINT)",
        "status": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'FAILED' ELSE 'PASSED' END",
    }


def run_approvals(d) -> tuple[str, dict[str, str]]:
    return "orders", {
        "dq_run_id": (
            f"CASE WHEN o_orderpriority = '1-URGENT' THEN 'none' ELSE 'r' || {text('o_orderkey')} END"
        ),
        "dq_stage": (
            "CASE WHEN o_orderstatus = 'P' THEN 'bronze_to_silver' ELSE 'silver_to_gold' END"
        ),
        "odate": "CAST(o_orderdate AS DATE)",
        "approved_at": "CAST(o_orderdate AS TIMESTAMP)",
    }


def ingestions(d) -> tuple[str, dict[str, str]]:
    """Orders as ingestion runs of their order date."""
    return "orders", {
        "odate": "CAST(o_orderdate AS DATE)",
        "status": (
            "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Succeeded' "
            "ELSE 'Failed' END"
        ),
    }


DERIVED = {
    f.__name__: f
    for f in (
        attendance,
        patients,
        hospitals,
        doctors,
        diseases,
        records,
        slices,
        event_log,
        run_metrics,
        run_approvals,
        ingestions,
    )
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = DERIVED[name](Spark)
    return load(spark, sf_dir, table).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def sql(name: str) -> str:
    """The derived table as a SELECT for the oracle."""
    table, columns = DERIVED[name](Duck)
    listed = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {listed} FROM {table}"


def columns_of(name: str) -> list[str]:
    return list(DERIVED[name](Duck)[1])
