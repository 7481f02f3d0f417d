"""Sources of ingest events: any (key, value) stream or table, Kafka being the usual one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.schemas import EVENT

# Default names of the topics read and written; pass your own to match existing ones.
INGEST_TOPIC = "corpus.ingest"
UPDATE_TOPIC = "corpus.updates"
DUPLICATE_TOPIC = "corpus.duplicates"
DEAD_LETTER_TOPIC = "corpus.dead-letters"


def layered(defaults: dict, *overlays: dict | None) -> dict:
    """Options with later layers winning; a None value takes an option away."""
    merged = dict(defaults)
    for overlay in overlays:
        merged.update(overlay or {})
    return {key: value for key, value in merged.items() if value is not None}


def kafka_options(
    servers: str, topic: str = INGEST_TOPIC, poll_size: int | None = None,
    shared: dict | None = None, specific: dict | None = None,
) -> dict:
    """Reader options: topic defaults, then settings shared by all topics, then this reader's own.

    A micro-batch takes all that has arrived unless ``poll_size`` bounds it.
    """
    return layered(
        {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "maxOffsetsPerTrigger": None if poll_size is None else str(poll_size),
            "startingOffsets": "earliest",
        },
        shared, specific,
    )


# A Kafka record's place in arrival order: partitions are interleaved by offset. 2^20 partitions.
_PARTITION_BITS = 20


def stream_kafka(spark: SparkSession, options: dict) -> DataFrame:
    """Unbounded ingest events from Kafka (needs the Spark Kafka connector on the classpath)."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(
        (F.shiftleft(F.col("offset"), _PARTITION_BITS) + F.col("partition")).alias("seq"),
        F.col("key").cast("string").alias("doc_id"),
        F.col("value").cast("string").alias("value"),
    )


def stream_files(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1) -> DataFrame:
    """Unbounded ingest events from files dropped into a folder."""
    return (
        spark.readStream.format(fmt).schema(EVENT)
        .option("maxFilesPerTrigger", files_per_trigger).load(path)
    )


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(EVENT).load(path)


def to_kafka(messages: DataFrame, servers: str, topic: str, options: dict | None = None) -> None:
    """Write ``(key, value)`` rows to a topic."""
    (
        messages.select("key", "value").write.format("kafka")
        .options(**layered({"kafka.bootstrap.servers": servers, "topic": topic}, options)).save()
    )
