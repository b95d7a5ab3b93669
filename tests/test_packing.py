"""Deduplication that moves the texts of a row as one."""

from pyspark.sql import functions as F

from sluice.operators.dedup import keep_latest, latest_snapshot_rows, packed, unpacked


def _odd_snapshot(spark):
    """Copies whose order hangs on NULL, empty, control and broken text."""
    texts = [None, "", "a", "a\u0000", "a\u0001", "a\u0002", "a\u0003", "ab", "\u0002", "é"]
    rows = [(k, a, b) for k in ("1", None) for a in texts for b in texts]
    frame = spark.createDataFrame(rows, "key STRING, a STRING, b STRING")
    broken = frame.where("a = 'ab'").withColumn("a", F.expr("CAST(X'61C3' AS STRING)"))
    frame = frame.union(broken).withColumn("key", F.coalesce(F.col("key"), F.hash("a").cast("string")))
    return frame.selectExpr(
        "key", "a", "b", "CAST(NULL AS STRING) AS _corrupt_record", "nullif(a, '') AS _source_file",
        "TIMESTAMP '2024-01-01' AS _ingested_at", "DATE '2024-01-01' AS odate",
    )


def test_packed_texts_keep_rows_and_order(spark):
    """The same copies as an order column by column keeps, byte by byte."""
    frame = _odd_snapshot(spark)
    order = ("_ingested_at", "_source_file", "a", "b", "_corrupt_record", "odate")
    plain = keep_latest(frame, ["key"], [F.col(c).desc_nulls_last() for c in order])
    kept = latest_snapshot_rows(frame, "key")

    def rows(found):
        shown = found.select("key", F.hex("a"), F.hex("b"), F.hex("_source_file"), "odate")
        return sorted(shown.collect(), key=repr)

    assert kept.columns == plain.drop("_corrupt_record").columns
    assert rows(kept) == rows(plain)
    everything = frame.select("a", "b", F.col("a").alias("_a"), F.col("b").alias("_b"))
    everything = everything.withColumn("t", packed(["a", "b"]))
    back = unpacked(everything, "t", ["a", "b"])
    assert back.where("NOT (a <=> _a AND b <=> _b)").isEmpty()
    by_text = [tuple(r) for r in everything.dropDuplicates(["t"]).orderBy("t").select("a", "b").collect()]
    assert by_text == [tuple(r) for r in frame.select("a", "b").distinct().orderBy("a", "b").collect()]


def test_snapshot_rows_are_shuffled_as_one_text(spark):
    plan = latest_snapshot_rows(_odd_snapshot(spark), "key")._jdf.queryExecution().executedPlan()
    sorts = [line for line in plan.toString().splitlines() if " Sort [" in line]
    assert len(sorts) == 2 and all("__texts" in s and "_source_file" not in s for s in sorts)
