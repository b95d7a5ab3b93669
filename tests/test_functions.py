from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions.casts import text_as, whole_number
from sluice.functions.clock import elapsed, iso_date
from sluice.functions.masking import mask_columns


def one(spark, columns, **values):
    ddl = ", ".join(f"{k} STRING" for k in values)
    return spark.createDataFrame([tuple(values.values())], ddl).select(*columns).first()


def test_whole_number_cuts_fractions_and_rejects_the_rest(spark):
    texts = ["17", "17.0", "17.9", "-3.9", "1e20", "nan", "", "abc", None, " 5 "]
    frame = spark.createDataFrame([(t,) for t in texts], "x STRING")
    found = [r[0] for r in frame.select(whole_number("x")).collect()]
    assert found == [17, 17, 17, -3, None, None, None, None, None, 5]


def test_int_overflow_is_null(spark):
    assert one(spark, [whole_number("x", "int")], x="3000000000")[0] is None


def test_money_and_dates(spark):
    texts = ["10.005", "99999999999.9", "-1", "x"]
    frame = spark.createDataFrame([(t,) for t in texts], "x STRING")
    found = [r[0] for r in frame.select(text_as("x", "decimal(12,2)")).collect()]
    assert found == [Decimal("10.01"), None, Decimal("-1.00"), None]
    row = one(spark, [text_as("x", "date"), text_as("x", "timestamp")], x="2026-03-21 03:10:46")
    assert tuple(row) == (date(2026, 3, 21), datetime(2026, 3, 21, 3, 10, 46))
    assert one(spark, [text_as("x", "date")], x="2026")[0] == date(2026, 1, 1)


def test_masks(spark):
    ddl = "full_name STRING, cpf STRING, email STRING, phone STRING"
    rows = [
        (" Ana Lima", "765.324.801-26", " Ana@Example.ORG ", "+55 (081) 1867 7804"),
        ("  ", "1", "no-domain", "12"),
        (None, None, None, None),
    ]
    masked = mask_columns(spark.createDataFrame(rows, ddl))
    found = [tuple(r) for r in masked.collect()]
    assert found == [
        ("A***", "***.***.***-26", "a***@example.org", "***-7804"),
        ("***", "***.***.***-1", "n***@", "***-12"),
        (None, None, None, None),
    ]
    again = [tuple(r) for r in mask_columns(masked).collect()]
    assert again[0] == found[0] and again[2] == found[2]
    # A blank-only name is the documented exception.
    assert again[1][0] == "****"


def test_elapsed_counts_complete_units(spark):
    frame = spark.createDataFrame(
        [(datetime(2026, 1, 1, 0, 0, 30), datetime(2026, 1, 1, 0, 2, 29))], "a TIMESTAMP, b TIMESTAMP"
    )
    row = frame.select(
        elapsed("MINUTE", F.col("a"), F.col("b")), elapsed("SECOND", F.col("a"), F.col("b"))
    ).first()
    assert tuple(row) == (1, 119)


@pytest.mark.parametrize("bad", ["", "2026-8-5", "20260805", "2026-13-01", "today"])
def test_business_date_is_strict(bad):
    with pytest.raises(ValueError):
        iso_date(bad)
    assert iso_date("2026-08-05") == date(2026, 8, 5)
