"""Plans and skew: no step may gather a hot key, a whole table or a cross product."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.casts import whole_number
from sluice.operators.checks import accepted, rejected, tally
from sluice.operators.dedup import keep_latest
from sluice.operators.reconcile import existing
from sluice.operators.rules import sql_rule, unique_key
from sluice.plans.monitoring import latest_update_id


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, another group has no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 30 == 1, None).otherwise(F.col("id"))
    return spark.range(60_000).select(key.alias("k"), F.col("id").alias("v")).repartition(8, "v")


def test_dedup_reduces_below_the_shuffle(spark, hot):
    kept = keep_latest(hot, ["k"], [F.col("v").desc_nulls_last()])
    text = plan(kept)
    exchange = text.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]
    expected = hot.groupBy("k").agg(F.max("v").alias("v"))
    assert kept.exceptAll(expected).isEmpty() and kept.count() == expected.count()


def test_key_rules_never_use_a_window(spark, hot):
    rules = [unique_key("k", "k"), sql_rule("v_ok", "v % 2 = 0")]
    bad = rejected(hot, rules)
    assert "Window" not in plan(bad) and "Window" not in plan(tally(hot, rules))
    rows = hot.collect()
    copies = {}
    for r in rows:
        copies[r["k"]] = copies.get(r["k"], 0) + 1
    expected = sum(1 for r in rows if copies[r["k"]] > 1 or r["v"] % 2)
    assert bad.count() == expected == tally(hot, rules).first()["quarantined_rows"]


def test_hot_join_keys_are_split(spark, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        parents = spark.range(60_000).select(F.col("id").alias("p"))
        for frame in (existing(hot, "k", parents, "p"), rejected(hot, [unique_key("k", "k")])):
            frame.collect()
            assert "skew=true" in plan(frame)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_latest_update_needs_no_single_task_window(spark):
    log = spark.createDataFrame(
        [], "origin STRUCT<update_id: STRING, pipeline_id: STRING>, timestamp TIMESTAMP"
    )
    text = plan(latest_update_id(log, "p"))
    assert "Window" not in text and "partial_max" in text


def test_split_shares_one_dedup_shuffle(spark, hot):
    rules = [unique_key("t", "t"), sql_rule("t_present", "t IS NOT NULL")]
    # The hot key occurs as two texts, so there is a repeated typed key to find.
    form = F.when(F.col("v") % 2 == 0, "%d").otherwise("%d.0")
    text = hot.select(F.replace(form, F.lit("%d"), F.col("k").cast("string")).alias("raw"), "v")
    kept = keep_latest(text, ["raw"], [F.col("v").desc_nulls_last()])
    typed = kept.select(whole_number("raw").alias("t"), "v")
    for part in (accepted(typed, rules), rejected(typed, rules)):
        part.collect()
        assert "ReusedExchange" in plan(part)
