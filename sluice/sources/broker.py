"""Event-broker reads and writes through Spark's Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The consumer's options.
MAX_OFFSETS = 10_000
CONSUMER_OPTIONS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "true",
    "kafka.request.timeout.ms": "60000",
    "kafka.session.timeout.ms": "30000",
}

# What a broker row looks like; file-based replays use the same columns.
RECORD_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)


def consumer_options(
    servers: str, topic: str, group: str, max_offsets: int = MAX_OFFSETS, **extra: str
) -> dict[str, str]:
    return {
        **CONSUMER_OPTIONS,
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "maxOffsetsPerTrigger": str(max_offsets),
        **extra,
    }


def read_broker(spark: SparkSession, servers: str, topic: str, group: str, **options) -> DataFrame:
    """A topic as a stream. Needs the Kafka connector on the class path."""
    chosen = consumer_options(servers, topic, group, **options)
    return spark.readStream.format("kafka").options(**chosen).load()


def read_replay(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """Recorded broker rows from Parquet files, as a stream with bounded batches."""
    return (
        spark.readStream.schema(RECORD_DDL).option("maxFilesPerTrigger", max_files).parquet(path)
    )
