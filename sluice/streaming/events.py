"""Row transformations of the event stream; all work on batch frames too."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.clock import instant
from sluice.operators.checks import ERRORS, annotate, rejected
from sluice.operators.once import with_columns_once
from sluice.operators.rules import row_failed
from sluice.streaming.contract import (
    PAYLOAD_DDL,
    PAYLOAD_FIELDS,
    QUARANTINE_FIELDS,
    SILVER_FIELDS,
    WATERMARK,
    event_rules,
    is_abnormal,
    producer_rules,
)

FATAL = "events violate the contract"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bronze_rows(records: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Broker records as text with their coordinates and a payload fingerprint."""
    payload = F.col("value").cast("string")
    return records.select(
        F.col("key").cast("string").alias("event_key"),
        payload.alias("raw_payload"),
        F.col("topic").alias("eventhub_name"),
        F.col("partition").cast("int").alias("eventhub_partition"),
        F.col("offset").cast("long").alias("eventhub_offset"),
        F.col("timestamp").alias("eventhub_enqueued_at"),
        instant(as_of).alias("ingested_at"),
        F.sha2(payload, 256).alias("payload_sha256"),
    )


def parsed_rows(bronze: DataFrame) -> DataFrame:
    """Payload fields trimmed and typed; the timestamp texts are kept beside.

    Parsing and typing happen once per event, however many rules look at a field.
    """
    opened = with_columns_once(
        bronze,
        {
            "_parsed_payload": F.from_json("raw_payload", PAYLOAD_DDL),
            "_payload_keys": F.json_object_keys("raw_payload"),
        },
    )
    fields = {name: F.col(f"_parsed_payload.{name}") for name in PAYLOAD_FIELDS}
    for name in ("event_id", "producer_run_id"):
        fields[name] = F.lower(F.trim(fields[name]))
    for name in ("event_type", "source"):
        fields[name] = F.trim(fields[name])
    for name in ("event_time", "produced_at"):
        fields[f"_{name}_raw"] = F.trim(fields[name])
        fields[name] = F.try_to_timestamp(fields[f"_{name}_raw"])
    return with_columns_once(opened, fields)


def classified_rows(bronze: DataFrame) -> DataFrame:
    """Every event with the names of the rules it violates."""
    return annotate(parsed_rows(bronze), event_rules())


def quarantined_rows(bronze: DataFrame) -> DataFrame:
    bad = rejected(parsed_rows(bronze), event_rules())
    return bad.select(*QUARANTINE_FIELDS, ERRORS)


def valid_rows(bronze: DataFrame) -> DataFrame:
    """Clean events only, for batch use."""
    return parsed_rows(bronze).where(~row_failed(event_rules())).select(*SILVER_FIELDS)


def all_valid_or_fail(bronze: DataFrame) -> DataFrame:
    """All events; one violating event fails the job or micro-batch that reads it."""
    stop = F.raise_error(F.lit(FATAL)).cast("boolean")
    clean = F.when(row_failed(event_rules()), stop).otherwise(F.lit(True))
    return parsed_rows(bronze).where(clean).select(*SILVER_FIELDS)


def _without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each Arrow batch with the first of the rows that agree in id and time."""
    for batch in batches:
        places = pa.array(range(batch.num_rows), pa.int64())
        keys = pa.table([batch["event_id"], batch["event_time"], places], ["id", "time", "place"])
        first = keys.group_by(["id", "time"], use_threads=False).aggregate([("place", "min")])
        yield batch.take(first["place_min"].combine_chunks().sort())


def first_copies(events: DataFrame, thin: bool = True) -> DataFrame:
    """The first copy per event id within the watermark (streaming only).

    One stateful step. It has no partial step before its shuffle, so a stateless one
    goes ahead: of a batch of rows inside a task only one copy is sent on, and an id
    that fills a third of a micro-batch costs its receiver one row for each of them.
    """
    thinned = events.mapInArrow(_without_copies, events.schema) if thin else events
    return thinned.withWatermark("event_time", WATERMARK).dropDuplicatesWithinWatermark(["event_id"])


def require_disk_state(spark: SparkSession) -> None:
    """25 hours of event ids belong into RocksDB, not into the executors' heaps."""
    provider = spark.conf.get(STATE_PROVIDER)
    if not provider.endswith("RocksDBStateStoreProvider"):
        raise RuntimeError(f"set {STATE_PROVIDER} to {ROCKSDB}")


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Checked events without repeated copies.

    The check stands before the stateful operator, so no bad event can vanish as
    a duplicate or as late data.
    """
    return first_copies(all_valid_or_fail(bronze))


def producer_breaches(bronze: DataFrame) -> DataFrame:
    """Events the consumer accepts although the producer should not have sent them."""
    accepted = parsed_rows(bronze).where(~row_failed(event_rules()))
    return rejected(accepted.select(*SILVER_FIELDS), producer_rules(), errors="_producer_errors")


def with_abnormal_flag(events: DataFrame) -> DataFrame:
    return events.withColumn("is_abnormal", is_abnormal())
