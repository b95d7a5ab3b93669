"""Events as keyed broker records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

NO_KEY = "an event without a key cannot be published"


def utc_text(events: DataFrame, column: str) -> Column:
    """ISO 8601 in UTC with ``Z``, whatever the session's zone; a zero fraction is left out.

    Timestamps without a zone are read as UTC.
    """
    kind = dict(events.dtypes)[column]
    value = f"`{column}`"
    if kind == "timestamp":
        seconds = f"CAST(CAST(unix_micros({value}) AS DECIMAL(20, 0)) / 1000000 AS DECIMAL(18, 6))"
        value = f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    text = F.expr(f"CAST({value} AS STRING)")
    whole = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(
        whole,
        F.when(F.length(text) > 19, F.concat(F.lit("."), fraction)).otherwise(""),
        F.lit("Z"),
    )


def to_records(events: DataFrame, key: str = "patient_id") -> DataFrame:
    """(key, value) text pairs; NULL fields stay in the JSON, a NULL key fails."""
    texts = [
        utc_text(events, f.name).alias(f.name)
        if isinstance(f.dataType, TimestampType | TimestampNTZType)
        else F.col(f.name)
        for f in events.schema.fields
    ]
    keyed = F.when(F.col(key).isNull(), F.raise_error(F.lit(NO_KEY))).otherwise(
        F.col(key).cast("string")
    )
    return events.select(
        keyed.alias("key"),
        F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish(events: DataFrame, servers: str, topic: str, key: str = "patient_id") -> None:
    """Send to a topic. The producer batches by size, per partition of the key."""
    records = to_records(events, key).write.format("kafka")
    records.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_files(events: DataFrame, path: str, key: str = "patient_id") -> None:
    """The same records as Parquet files, for replay without a broker."""
    to_records(events, key).write.mode("append").parquet(path)
