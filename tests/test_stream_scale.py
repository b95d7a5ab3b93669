"""What keeps the landing of records, laying out and late events from growing faster than their input."""

import glob
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.sources.tables import Lake
from sluice.streaming import update
from sluice.streaming.update import COPY, SILVER, VitalStream
from workload import events

SF_DIR = "/root/testdata/sf0.001"


def test_valid_records_are_made_once_by_all_cores(spark):
    records = events._valid_records(spark, SF_DIR, "eventhub_offset % 2")
    assert len(records.inputFiles()) >= spark.sparkContext.defaultParallelism
    # What is read again is the stored text: the payload is not built anew for each update.
    plan = events._of_update(records, 1)._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "from_json" not in plan
    halves = [events._of_update(records, n) for n in range(2)]
    assert all(half.where(F.col("offset") % 2 != n).isEmpty() for n, half in enumerate(halves))
    assert sum(half.count() for half in halves) == events.valid_rows(events.bronze(spark, SF_DIR)).count()


def test_records_are_dealt_out_without_a_sort(spark):
    plan = events._spread_bronze(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and "RoundRobin" not in plan and "Sort" not in plan


def test_small_files_are_not_a_task_each(spark, monkeypatch):
    home = scratch_path(spark, "small-files")
    lake = Lake(spark, root=home, prefix=f"s{uuid.uuid4().hex[:8]}_")
    lake.ensure_layer("silver")
    rows = spark.range(3000).selectExpr(
        "id AS event_id", "timestamp_seconds(1767225600 + id * 7) AS event_time", "id % 50 AS patient_id"
    )
    dated = rows.withColumn("event_time_date", F.col("event_time").cast("date"))
    dated.write.partitionBy("event_time_date").saveAsTable(lake.name(*SILVER))
    day = lake.read(*SILVER).agg(F.max("event_time_date")).first()[0]
    tasks, laid_out = [], update.laid_out
    monkeypatch.setattr(update, "laid_out", lambda f, c, n: tasks.append(n) or laid_out(f, c, n))
    stream = VitalStream(lake, f"{home}/checkpoints")
    assert len(stream.lay_out(SILVER, day.replace(day=day.day + 1), rows_per_file=100)) == 1
    assert tasks == [1]
    sizes = [
        pq.read_metadata(p).num_rows
        for p in glob.glob(f"{home}/silver/_versions/{SILVER[1]}{COPY}/**/*.parquet", recursive=True)
    ]
    assert len(sizes) == 30 and max(sizes) == 100
    assert stream.history(SILVER).exceptAll(lake.read(*SILVER)).isEmpty()


def test_late_events_are_parsed_once(spark, monkeypatch):
    home = scratch_path(spark, "late-once")
    lake = Lake(spark, root=home, prefix=f"s{uuid.uuid4().hex[:8]}_")
    rows = events._spread_bronze(spark, SF_DIR)
    silver = events.valid_rows(rows).where("eventhub_offset % 2 = 0")
    lake.ensure_layer("silver")
    dated = silver.withColumn("event_time_date", F.col("event_time").cast("date"))
    dated.write.partitionBy("event_time_date").saveAsTable(lake.name(*SILVER))
    parsed, valid_rows = spark.sparkContext.accumulator(0), update.valid_rows

    def counted(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    def watched(bronze):
        valid = valid_rows(bronze)
        return valid.mapInArrow(counted, valid.schema)

    monkeypatch.setattr(update, "valid_rows", watched)
    VitalStream(lake, f"{home}/checkpoints")._keep_late(rows, 0)
    valid = valid_rows(rows)
    assert parsed.value == valid.count()
    late = lake.read(*update.LATE).select("event_id")
    wanted = valid.where("eventhub_offset % 2 = 1").select("event_id")
    assert late.count() > 0 and late.exceptAll(wanted).isEmpty() and wanted.exceptAll(late).isEmpty()
