"""Keys of accepted rows without a join of whole rows."""

from pyspark.sql import functions as F

from sluice.operators.checks import accepted, accepted_keys
from sluice.operators.rules import sql_rule, unique_key


def test_accepted_keys_are_those_of_accepted_rows(spark):
    rules = [unique_key("k", "k"), sql_rule("v_ok", "v % 2 = 0")]
    key = F.when(F.col("id") % 7 == 0, 7).when(F.col("id") != 50, F.col("id"))
    rows = spark.range(200).select(key.alias("k"), F.col("id").alias("v"))
    found = accepted_keys(rows, rules)
    wanted = accepted(rows, rules).select("k")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    assert found.where("k IS NULL").count() == 1
