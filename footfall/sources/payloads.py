"""The message stream: rows of ``arrival`` (message number), ``value`` (JSON text) and, from a
topic, ``source`` (partition)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import schemas


# What one micro-batch takes at most; the rest waits for the next, so that a start on a
# backlog is many batches of one size.
MAX_FILES = 1_000
MAX_MESSAGES = 1_000_000


def payload_files(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Messages landed as parquet files; ``max_files`` limits one micro-batch."""
    reader = spark.readStream.schema(schemas.RAW)
    return reader.option("maxFilesPerTrigger", max_files).parquet(path)


def payload_topic(
    spark: SparkSession, servers: str, topic: str, max_messages: int = MAX_MESSAGES
) -> DataFrame:
    """Messages of a Kafka topic (needs the Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_messages)
    )
    return topic_messages(reader.load())


def topic_messages(records: DataFrame) -> DataFrame:
    """The messages of topic records; offsets grow with arrival within a partition."""
    return records.select(
        F.col("offset").cast("long").alias("arrival"),
        F.col("partition").cast("int").alias("source"),
        F.col("value").cast("string").alias("value"),
    )
