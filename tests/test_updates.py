"""Counters of long updates, UTC texts and the landing of one date."""

from datetime import date

from sluice.session import scratch_path
from sluice.sources.raw import list_landed
from sluice.streaming.journal import drained
from sluice.streaming.publish import to_records

RETAINED = "spark.sql.streaming.numRecentProgressUpdates"


def test_progress_of_more_batches_than_the_query_retains(spark):
    source, target = scratch_path(spark, "many"), scratch_path(spark, "many-out")
    spark.range(120).repartition(12).write.parquet(source)
    spark.conf.set(RETAINED, 3)
    try:
        query = (
            spark.readStream.schema("id bigint")
            .option("maxFilesPerTrigger", 1)
            .parquet(source)
            .writeStream.option("checkpointLocation", f"{target}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{target}/rows")
        )
        batches = drained(query, every=0.02)
        assert len(query.recentProgress) < len(batches)
    finally:
        spark.conf.unset(RETAINED)
    assert sum(b["numInputRows"] for b in batches) == 120 == spark.read.parquet(f"{target}/rows").count()


def test_record_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.sql(
        "SELECT 1 AS patient_id, timestamp_micros(1704110400000000) AS a, "
        "timestamp_micros(1711846800500000) AS b, TIMESTAMP_NTZ'2024-03-31 02:30:00.25' AS c"
    )
    texts = []
    for zone in ("UTC", "America/Sao_Paulo", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            texts.append(to_records(rows).first()["value"])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(set(texts)) == 1
    for text in ("2024-01-01T12:00:00Z", "2024-03-31T01:00:00.500000Z", "2024-03-31T02:30:00.250000Z"):
        assert text in texts[0]


def test_landing_of_one_date_lists_only_its_folders(spark):
    root = scratch_path(spark, "landing")
    for day in ("2024-01-01", "2024-01-02"):
        for name in ("patients", "doctors"):
            spark.range(1).write.csv(f"{root}/{name}/odate={day}/{name}.csv")
    files = list_landed(spark, root, date(2024, 1, 1))
    assert "odate=2024-01-02" not in str(files.inputFiles())
    assert list_landed(spark, root, date(2023, 1, 1)).count() == 0
