"""The outcomes of replacing a partition, appending and upserting."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from fixtures import NEXT, ODATE
from sluice.sources import tables
from sluice.sources.tables import EmptyPartition, Lake, PartitionContract, require_rows


@pytest.fixture
def lake(spark):
    return Lake(spark)


@pytest.fixture
def layer():
    return f"l{uuid.uuid4().hex[:8]}"


def rows(spark, odate, values, name="v"):
    frame = spark.createDataFrame([(v,) for v in values], f"{name} BIGINT")
    return frame.withColumn("odate", F.lit(odate).cast("date"))


def stored(lake, layer, table="t"):
    found = {}
    for r in lake.read(layer, table).collect():
        found.setdefault(r["odate"], []).append(r[0])
    return {d: sorted(v) for d, v in found.items()}


def test_create_then_replace_one_date_only(spark, lake, layer):
    assert lake.replace_partition(rows(spark, ODATE, [1, 2]), layer, "t", ODATE) == 2
    lake.replace_partition(rows(spark, NEXT, [3]), layer, "t", NEXT)
    lake.replace_partition(rows(spark, ODATE, [9]), layer, "t", ODATE)
    lake.replace_partition(rows(spark, ODATE, [9]), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [9], NEXT: [3]}
    assert lake.partition(layer, "t", NEXT).count() == 1


def test_rows_of_another_date_are_refused(spark, lake, layer):
    lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
    for other in (NEXT, None):
        mixed = rows(spark, ODATE, [5]).unionByName(rows(spark, other, [6]))
        with pytest.raises(PartitionContract):
            lake.replace_partition(mixed, layer, "t", ODATE)
        with pytest.raises(PartitionContract):
            lake.replace_partition(mixed, layer, "fresh", ODATE)
        assert not lake.exists(layer, "fresh")
    assert stored(lake, layer) == {ODATE: [1]}


def test_empty_result_is_refused_and_changes_nothing(spark, lake, layer):
    lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
    with pytest.raises(EmptyPartition, match="2026-08-05"):
        lake.replace_partition(rows(spark, ODATE, []), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [1]}
    with pytest.raises(EmptyPartition):
        lake.replace_partition(rows(spark, ODATE, []), layer, "fresh", ODATE)
    assert not lake.exists(layer, "fresh")


def test_wrong_partitioning_is_refused(spark, lake, layer):
    lake.ensure_layer(layer)
    rows(spark, ODATE, [1]).write.format("parquet").saveAsTable(lake.name(layer, "t"))
    with pytest.raises(PartitionContract, match="partitioned"):
        lake.replace_partition(rows(spark, ODATE, [2]), layer, "t", ODATE)


def test_schema_change_needs_a_table_without_other_dates(spark, lake, layer):
    lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
    lake.replace_partition(rows(spark, ODATE, [2], name="w"), layer, "t", ODATE)
    assert lake.read(layer, "t").columns == ["w", "odate"]
    with pytest.raises(EmptyPartition):
        lake.replace_partition(rows(spark, ODATE, [], name="x"), layer, "t", ODATE)
    with pytest.raises(PartitionContract):
        lake.replace_partition(rows(spark, NEXT, [5], name="x"), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [2]}
    lake.replace_partition(rows(spark, NEXT, [3], name="w"), layer, "t", NEXT)
    with pytest.raises(PartitionContract, match="schema"):
        lake.replace_partition(rows(spark, ODATE, [4], name="x"), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [2], NEXT: [3]}


def test_clustered_write_keeps_the_rows(spark, lake, layer):
    frame = rows(spark, ODATE, [i % 5 for i in range(200)])
    lake.replace_partition(frame, layer, "t", ODATE, cluster_by=["v"])
    assert len(stored(lake, layer)[ODATE]) == 200


def test_append_adds_columns_and_fills_missing_ones(spark, lake, layer):
    lake.append(spark.createDataFrame([(1,)], "a INT"), layer, "q")
    lake.append(spark.createDataFrame([("x", 2)], "b STRING, a INT"), layer, "q")
    lake.append(spark.createDataFrame([("y",)], "b STRING"), layer, "q")
    found = {(r["a"], r["b"]) for r in lake.read(layer, "q").collect()}
    assert found == {(1, None), (2, "x"), (None, "y")}


def test_upsert_replaces_by_key(spark, lake, layer):
    schema = StructType(
        [StructField("v", StringType()), StructField("stage", StringType()), StructField("d", DateType())]
    )
    for value, stage, day in (("1", "a", ODATE), ("2", "b", ODATE), ("3", "a", NEXT), ("4", "a", ODATE)):
        row = spark.createDataFrame([(value, stage, day)], schema)
        lake.upsert(row, layer, "c", ("stage", "d"), schema)
    latest = {("a", ODATE): "4", ("b", ODATE): "2", ("a", NEXT): "3"}

    def found():
        rows = lake.current(layer, "c", ("stage", "d")).collect()
        assert len(rows) == 3
        return {(r["stage"], r["d"]): r["v"] for r in rows}

    assert found() == latest
    before = lake.current(layer, "c", ("stage", "d"))
    assert lake.compact(layer, "c", ("stage", "d")) == 4
    assert lake.compact(layer, "c", ("stage", "d")) == 1
    assert found() == latest and before.count() == 3


def test_writers_of_one_key_do_not_undo_each_other(spark, lake, layer):
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])

    def put(value, at):
        row = spark.createDataFrame([("x", value), (None, value)], schema)
        lake.upsert(row, layer, "c", ("k",), schema, at=at)

    lake.ensure_keyed(layer, "c", schema)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(put, "abcd", (3, 9, 5, 7)))
    # A late writer with an older version, and a compaction in between.
    lake.compact(layer, "c", ("k",))
    put("e", 8)
    found = {r["k"]: r["v"] for r in lake.current(layer, "c", ("k",)).collect()}
    assert found == {"x": "b", None: "b"}
    put("f", 10)
    assert {r["v"] for r in lake.current(layer, "c", ("k",)).collect()} == {"f"}


def test_upserts_merge_their_slices(spark, lake, layer, monkeypatch):
    monkeypatch.setattr(tables, "SLICES", 3)
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    for number in range(8):
        row = spark.createDataFrame([(str(number % 3), str(number))], schema)
        lake.upsert(row, layer, "c", ("k",), schema)
    found = {r["k"]: r["v"] for r in lake.current(layer, "c", ("k",)).collect()}
    assert found == {"0": "6", "1": "7", "2": "5"}
    assert len(lake._slices(lake.name(layer, "c"))) <= 4


def test_failed_writes_keep_the_old_rows(spark, lake, layer, monkeypatch):
    lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
    wrong = rows(spark, ODATE, [2]).withColumn("v", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        lake.replace_partition(wrong, layer, "t", ODATE)
    with pytest.raises(Exception, match="broken"):
        lake.replace_partition(wrong.withColumnRenamed("v", "w"), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [1]} and lake.read(layer, "t").columns == ["v", "odate"]

    # The writer is lost before and between the renames of a schema change.
    changed = rows(spark, ODATE, [7], name="w")
    for lost in ("__fresh RENAME", "t RENAME"):
        run = spark.sql

        def stop(text, *args, **kwargs):
            if lost in text:
                raise KeyboardInterrupt
            return run(text, *args, **kwargs)

        monkeypatch.setattr(spark, "sql", stop)
        with pytest.raises(KeyboardInterrupt):
            lake.replace_partition(changed, layer, "t", ODATE)
        monkeypatch.undo()
        lake._finish_swap(layer, "t")
        assert stored(lake, layer) == {ODATE: [1]}
    lake.replace_partition(changed, layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [7]} and not lake.exists(layer, "t__old")


def test_a_partition_can_be_rewritten_from_itself(spark, lake, layer):
    lake.replace_partition(rows(spark, ODATE, [1, 2]), layer, "t", ODATE)
    before = lake.partition(layer, "t", ODATE)
    lake.replace_partition(before.withColumn("v", F.col("v") + 10), layer, "t", ODATE)
    assert stored(lake, layer) == {ODATE: [11, 12]}
    assert before.count() == 2


def test_slices_are_replaced_by_what_is_written(spark, lake, layer):
    frame = spark.range(6).selectExpr("id", "date_add(DATE'2026-08-05', CAST(id % 3 AS INT)) AS d", "7 AS b")
    assert len(lake.replace_slices(frame, layer, "t", ["d", "b"])) == 3
    assert lake.replace_slices(frame.where("false"), layer, "t", ["d", "b"]) == []
    part = frame.where("id = 4").withColumn("id", F.lit(40).cast("bigint"))
    lake.replace_slices(part, layer, "t", ["d", "b"])
    assert sorted(r["id"] for r in lake.read(layer, "t").collect()) == [0, 2, 3, 5, 40]
    assert lake.replace_slices(frame.where("false"), layer, "empty", ["d"]) == []
    assert lake.read(layer, "empty").columns == ["id", "b", "d"]


def test_writes_leave_the_session_alone(spark, lake, layer):
    settings = "spark.sql.sources.partitionOverwriteMode"
    for mode in ("static", "dynamic"):
        spark.conf.set(settings, mode)
        lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
        lake.replace_partition(rows(spark, NEXT, [2]), layer, "t", NEXT)
        lake.replace_partition(rows(spark, ODATE, [3]), layer, "t", ODATE)
        assert stored(lake, layer) == {ODATE: [3], NEXT: [2]}
        assert spark.conf.get(settings) == mode
    spark.conf.unset(settings)


def test_require_rows(spark):
    assert require_rows(rows(spark, ODATE, [1]), "t", ODATE).count() == 1
    with pytest.raises(EmptyPartition):
        require_rows(rows(spark, ODATE, []), "t", ODATE)


def test_partition_filter_prunes(spark, lake, layer):
    lake.replace_partition(rows(spark, ODATE, [1]), layer, "t", ODATE)
    lake.replace_partition(rows(spark, date(2026, 8, 7), [2]), layer, "t", date(2026, 8, 7))
    plan = lake.partition(layer, "t", ODATE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(odate" in plan
