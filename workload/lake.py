"""Table writes as queries: what several writes to one table leave behind."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from sluice.model import CORRUPT, ENTITIES
from sluice.session import scratch_path
from sluice.sources.raw import partition_path, read_raw_csv
from sluice.sources.tables import Lake, PartitionContract
from workload.derive import AS_OF, DAY_SQL, NOW_SQL, ODATE, frame, load, sql
from workload.registry import register

NEXT = ODATE + timedelta(days=1)


def fresh_lake(spark: SparkSession, label: str) -> Lake:
    """Layers of their own below the shared folder."""
    return Lake(spark, root=scratch_path(spark, label), prefix=f"q{uuid.uuid4().hex[:12]}_")


def _orders(spark, sf_dir, odate: date, status: str = "o_orderstatus") -> DataFrame:
    rows = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"{status} AS o_orderstatus", "o_totalprice"
    )
    return rows.withColumn("odate", F.lit(odate).cast("date"))


def _listed(table: DataFrame) -> DataFrame:
    return table.select("odate", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def partition_replace(spark, sf_dir) -> DataFrame:
    """Two dates are written, the first again with other rows."""
    lake = fresh_lake(spark, "replace")
    lake.replace_partition(_orders(spark, sf_dir, ODATE), "bronze", "orders", ODATE)
    lake.replace_partition(_orders(spark, sf_dir, NEXT), "bronze", "orders", NEXT)
    again = _orders(spark, sf_dir, ODATE, "lower(o_orderstatus)").where("o_totalprice > 50000")
    lake.replace_partition(again, "bronze", "orders", ODATE)
    return _listed(lake.read("bronze", "orders"))


def _order_sql(odate: date, status: str = "o_orderstatus") -> str:
    return (
        f"SELECT DATE '{odate}' AS odate, o_orderkey, o_custkey, {status} AS o_orderstatus, "
        "o_totalprice FROM orders"
    )


register(
    "partition_replace",
    partition_replace,
    f"{_order_sql(ODATE, 'lower(o_orderstatus)')} WHERE o_totalprice > 50000 "
    f"UNION ALL {_order_sql(NEXT)}",
)


def partition_one_date(spark, sf_dir) -> DataFrame:
    lake = fresh_lake(spark, "one-date")
    for odate in (ODATE, NEXT):
        lake.replace_partition(_orders(spark, sf_dir, odate), "bronze", "orders", odate)
    return _listed(lake.partition("bronze", "orders", NEXT))


register("partition_one_date", partition_one_date, _order_sql(NEXT))


def schema_change_refused(spark, sf_dir) -> DataFrame:
    """A schema change whose rows turn out to be of several dates leaves the old rows."""
    lake = fresh_lake(spark, "refused")
    lake.replace_partition(_orders(spark, sf_dir, ODATE), "bronze", "orders", ODATE)
    wider = _orders(spark, sf_dir, ODATE).withColumn("note", F.lit("new"))
    mixed = wider.unionByName(wider.withColumn("odate", F.lit(NEXT).cast("date")))
    try:
        lake.replace_partition(mixed, "bronze", "orders", ODATE)
    except PartitionContract:
        return _listed(lake.read("bronze", "orders"))
    raise AssertionError("rows of another date were written")


def schema_change(spark, sf_dir) -> DataFrame:
    lake = fresh_lake(spark, "changed")
    lake.replace_partition(_orders(spark, sf_dir, ODATE), "bronze", "orders", ODATE)
    wider = _orders(spark, sf_dir, ODATE).withColumn("note", F.upper("o_orderstatus"))
    lake.replace_partition(wider, "bronze", "orders", ODATE)
    return lake.read("bronze", "orders").select("odate", "o_orderkey", "note")


register("schema_change_refused", schema_change_refused, _order_sql(ODATE))
register(
    "schema_change",
    schema_change,
    f"SELECT DATE '{ODATE}' AS odate, o_orderkey, upper(o_orderstatus) AS note FROM orders",
)

_KEYED = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
    ]
)


def upsert_latest(spark, sf_dir) -> DataFrame:
    """Inserts, updates and a late older version, with a compaction in between."""
    lake = fresh_lake(spark, "upsert")
    orders = load(spark, sf_dir, "orders").select(*_KEYED.names).dropDuplicates(["o_orderkey"])

    def put(rows: DataFrame, at: int) -> None:
        lake.upsert(rows, "observability", "orders", ["o_orderkey"], _KEYED, at=at)

    put(orders.where("o_orderkey % 3 <> 0"), 10)
    put(orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("second")), 30)
    lake.compact("observability", "orders", ["o_orderkey"])
    put(orders.where("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("late")), 20)
    put(orders.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("last")), 40)
    return lake.current("observability", "orders", ["o_orderkey"])


register(
    "upsert_latest",
    upsert_latest,
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'last' WHEN o_orderkey % 2 = 0 THEN "
    "'second' ELSE o_orderstatus END AS o_orderstatus, o_totalprice "
    "FROM (SELECT DISTINCT ON (o_orderkey) * FROM orders) o "
    "WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 OR o_orderkey % 5 = 0",
)


def append_evolving(spark, sf_dir) -> DataFrame:
    """Appends with new and with lacking columns."""
    lake = fresh_lake(spark, "append")
    orders = load(spark, sf_dir, "orders")
    lake.append(orders.select("o_orderkey", "o_custkey"), "quarantine", "orders")
    lake.append(orders.select("o_orderstatus", "o_orderkey"), "quarantine", "orders")
    return lake.read("quarantine", "orders")


register(
    "append_evolving",
    append_evolving,
    "SELECT o_orderkey, o_custkey, NULL AS o_orderstatus FROM orders UNION ALL "
    "SELECT o_orderkey, NULL, o_orderstatus FROM orders",
)


#: Lines of the landed files that do not fit: too short, too long.
_SHORT, _LONG = "p_partkey % 7 = 0", "p_partkey % 11 = 0"
_RAW = ENTITIES["doctors"].raw


def _line(columns) -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in columns) + ")"


def _lines(short: str, long: str) -> str:
    return (
        f"CASE WHEN {short} THEN {_line(_RAW[:2])} WHEN {long} THEN {_line(_RAW)} || ',more' "
        f"ELSE {_line(_RAW)} END"
    )


def csv_bronze(spark, sf_dir) -> DataFrame:
    """Doctors landed as CSV with broken lines, ingested into Bronze and read back."""
    root = scratch_path(spark, "landing")
    number = "CAST(doctor_id AS BIGINT) AS p_partkey"
    lines = frame(spark, sf_dir, "doctors").selectExpr("*", number)
    # One column that is named like the header; no value holds the separator.
    landed = lines.selectExpr(f"{_lines(_SHORT, _LONG)} AS `{','.join(_RAW)}`")
    landed.write.options(header=True, sep="\u0001").csv(partition_path(root, "doctors", ODATE))
    lake = fresh_lake(spark, "csv")
    lake.replace_partition(
        read_raw_csv(spark, root, "doctors", ODATE, AS_OF), "bronze", "doctors", ODATE
    )
    folder = F.regexp_extract("_source_file", "/(doctors/odate=[0-9-]+)/[^/]+[.]csv$", 1)
    return lake.partition("bronze", "doctors", ODATE).withColumn("_source_file", folder)


def _read_back(column: str) -> str:
    value = f"nullif({column}, '')"
    return value if column in _RAW[:2] else f"CASE WHEN NOT {_SHORT} THEN {value} END"


register(
    "csv_bronze",
    csv_bronze,
    "SELECT "
    + ", ".join(f"{_read_back(c)} AS {c}" for c in _RAW)
    + f", CASE WHEN {_SHORT} OR {_LONG} THEN {_lines(_SHORT, _LONG)} END AS {CORRUPT}, "
    f"'doctors/odate={ODATE}' AS _source_file, {NOW_SQL} AS _ingested_at, {DAY_SQL} AS odate "
    f"FROM (SELECT *, CAST(doctor_id AS BIGINT) AS p_partkey FROM ({sql('doctors')}) d) r",
)
