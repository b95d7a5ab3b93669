"""Writes of one date or one slice, which need no sort by partition columns."""

from pyspark.sql import functions as F

from fixtures import ODATE
from sluice.plans import gate
from sluice.sources.tables import Lake
from workload.lake import fresh_lake


def test_rows_of_one_date_are_written_without_partitioned_write(spark, monkeypatch):
    def partitioned(*_):
        raise AssertionError("rows of one partition were sorted by its columns")

    monkeypatch.setattr(Lake, "_write_beside", partitioned)
    lake = fresh_lake(spark, "one-date-test")
    rows = spark.range(10).select("id", F.lit(ODATE).alias("odate"), (F.col("id") * 2).alias("v"))
    assert lake.replace_partition(rows, "bronze", "t", ODATE) == 10
    found = lake.partition("bronze", "t", ODATE)
    assert found.columns == ["id", "v", "odate"] and found.exceptAll(rows.select(*found.columns)).isEmpty()
    schema = spark.range(0).schema
    lake.upsert(spark.range(5), "observability", "k", ["id"], schema)
    assert lake.current("observability", "k", ["id"]).count() == 5


def test_staged_rows_stay_if_cleaning_leaves_nothing(spark):
    lake = fresh_lake(spark, "staged-test")
    raw = spark.createDataFrame(
        [("1", "h", "public", "PE", "c", "5", None, "f")],
        "hospital_id STRING, hospital_name STRING, hospital_type STRING, state STRING, "
        "city STRING, capacity STRING, created_at STRING, _source_file STRING",
    ).withColumns({"_ingested_at": F.current_timestamp(), "odate": F.lit(ODATE)})
    assert gate.stage_rows(lake, raw, "hospitals", ODATE, "r1").count() == 1
    nothing = raw.withColumn("capacity", F.lit("none"))
    assert gate.stage_rows(lake, nothing, "hospitals", ODATE, "r2") is None
    assert gate.staged_rows(lake, "hospitals", ODATE, "r1").count() == 1
