"""Files with narrow ranges in several columns, by the statistics in their footers."""

import glob
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sluice.operators.clustering import laid_out
from sluice.session import scratch_path
from sluice.sources.tables import Lake
from sluice.streaming.update import BRONZE, COPY, SILVER, VitalStream


def ranges(folder, columns):
    """Per file the rows and, for each column, the smallest and the largest value."""
    found = []
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.read_metadata(path)
        names = meta.schema.names
        stats = []
        for column in columns:
            groups = [meta.row_group(g).column(names.index(column)).statistics for g in range(meta.num_row_groups)]
            stats.append((min(g.min for g in groups), max(g.max for g in groups)))
        found.append((meta.num_rows, stats))
    return found


def mean_share(found, which, low, high):
    """The mean share of the whole range that a file spans."""
    return sum((s[which][1] - s[which][0]) / (high - low) for _, s in found) / len(found)


def test_files_are_narrow_in_both_columns(spark):
    folder, out = scratch_path(spark, "wide"), scratch_path(spark, "narrow")
    rows = spark.range(64_000).selectExpr("id", "pmod(xxhash64(id), 1000) AS a", "pmod(xxhash64(id, 7), 1000) AS b")
    rows.write.parquet(folder)
    laid_out(spark.read.parquet(folder), ["a", "b"], 64).write.parquet(out)
    found = ranges(out, ["a", "b"])
    assert sum(n for n, _ in found) == 64_000 and len(found) >= 48
    for which in (0, 1):
        assert mean_share(found, which, 0, 999) < 0.25
        assert mean_share(ranges(folder, ["a", "b"]), which, 0, 999) > 0.9
    assert spark.read.parquet(out).agg(F.sum("id")).first()[0] == 64_000 * 63_999 // 2


def test_a_frequent_value_is_split(spark):
    folder, out = scratch_path(spark, "frequent"), scratch_path(spark, "split")
    rows = spark.range(32_000).selectExpr(
        "id", "IF(id % 2 = 0, 'same', md5(CAST(id AS STRING))) AS a", "IF(id % 3 = 0, NULL, DATE'2026-01-01' + CAST(id % 500 AS INT)) AS b"
    )
    # And a third of all rows are equal.
    rows.union(spark.range(16_000).selectExpr("-1L", "'same'", "DATE'2026-02-01'")).write.parquet(folder)
    laid_out(spark.read.parquet(folder), ["a", "b"], 24).write.parquet(out)
    sizes = [pq.read_metadata(p).num_rows for p in glob.glob(f"{out}/*.parquet")]
    # Equal rows have one hash, so at most the third of equal rows meets in one file.
    assert sum(sizes) == 48_000 and sorted(sizes)[-2] < 3 * 48_000 / 24
    with pytest.raises(ValueError, match="array"):
        laid_out(spark.range(1).selectExpr("array(id) AS a"), ["a"], 2)


def test_closed_days_of_the_stream_are_laid_out(spark):
    home = scratch_path(spark, "layout")
    lake = Lake(spark, root=home, prefix=f"l{uuid.uuid4().hex[:8]}_")
    stream = VitalStream(lake, f"{home}/checkpoints")
    for layer in ("bronze", "silver"):
        lake.ensure_layer(layer)

    def events(first, count):
        return spark.range(first, first + count).selectExpr(
            "id AS event_id",
            "timestamp_seconds(1767225600 + id * 7) AS event_time",
            "pmod(xxhash64(id), 500) AS patient_id",
            "CAST(pmod(xxhash64(id), 16) AS INT) AS eventhub_partition",
            "timestamp_seconds(1767225600 + id * 7) AS eventhub_enqueued_at",
        )

    def land(rows):
        for table, column in ((SILVER, "event_time"), (BRONZE, "eventhub_enqueued_at")):
            dated = rows.withColumn(f"{column}_date", F.col(column).cast("date"))
            dated.write.mode("append").partitionBy(f"{column}_date").saveAsTable(lake.name(*table))

    land(events(0, 40_000))
    last = lake.read(*SILVER).agg(F.max("event_time_date")).first()[0]
    for table, columns in ((SILVER, ["event_time", "patient_id"]), (BRONZE, ["eventhub_partition", "eventhub_enqueued_at"])):
        days = stream.lay_out(table, last, rows_per_file=800)
        assert len(days) == 3 and stream.lay_out(table, last, rows_per_file=800) == []
        found = ranges(f"{home}/{table[0]}/_versions/{table[1]}{COPY}/*", columns)
        spans = {"patient_id": 499, "eventhub_partition": 15}
        for which, column in enumerate(columns):
            if column in spans:
                assert mean_share(found, which, 0, spans[column]) < 0.5
            else:
                seconds = [(s[which][1] - s[which][0]).total_seconds() for _, s in found]
                assert sum(seconds) / len(seconds) < 0.5 * 86_400
        assert stream.history(table).count() == 40_000
    # A late row makes the copy of its day stale until it is laid out again.
    land(events(10, 1))
    assert stream.history(SILVER).count() == 40_001
    assert len(stream.lay_out(SILVER, last, rows_per_file=800)) == 1
    assert stream.history(SILVER).groupBy("event_id").count().where("count > 1").count() == 1
    plan = stream.history(SILVER).where("patient_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(patient_id), EqualTo(patient_id,7)]" in plan
