"""Stream sources of (key, value) rating messages.

The Kafka connector is a separate Spark package; the file source carries
the same messages where it is not installed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelrank.schemas import MESSAGES, TOPIC

OFFSETS = ("latest", "earliest")


def kafka_options(servers: str, topic: str, starting: str) -> dict[str, str]:
    if starting not in OFFSETS:
        raise ValueError(f"unknown starting offsets {starting!r}, expected one of {OFFSETS}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest"
) -> DataFrame:
    """``latest`` follows new records, ``earliest`` replays the topic first."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, starting))
        .load()
        .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    )


def kafka_history(spark: SparkSession, servers: str, topic: str = TOPIC) -> DataFrame:
    """The topic from its start up to now, as a bounded read."""
    return (
        spark.read.format("kafka")
        .options(**kafka_options(servers, topic, "earliest"))
        .load()
        .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    )


def file_messages(
    spark: SparkSession, path: str, files_per_trigger: int | None = 1
) -> DataFrame:
    """``files_per_trigger`` None takes all new files in one micro-batch."""
    reader = spark.readStream.schema(MESSAGES)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
