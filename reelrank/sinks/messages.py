"""Message sinks: topic payloads and envelope files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.messages import body_json
from reelrank.schemas import TOPIC


def rating_body():
    return body_json(F.col("userId"), F.col("movieId"), F.col("rating"), F.col("timestamp"))


def to_messages(ratings: DataFrame, *more: str) -> DataFrame:
    """Ratings as (key, value JSON) payloads, and the columns ``more``."""
    return ratings.select("key", rating_body().alias("value"), *more)


def publish_kafka(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


#: Bytes of a row group before compression. A file is read by at most a task for each group, and
#: the source takes whole files, so one group would leave a micro-batch of a large file to one task.
TOPIC_GROUP = 8 << 20


def publish_files(messages: DataFrame, path: str, *folders: str) -> None:
    """Appends messages as files, for the file stream source, in folders by the given columns."""
    writer = messages.select("key", "value", *folders).write.mode("append")
    writer = writer.option("parquet.block.size", TOPIC_GROUP)
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def write_envelopes(ratings: DataFrame, path: str, nested: bool = False) -> None:
    """JSON lines ``{"headers": {"key"}, "body"}``; body as JSON text or object."""
    if nested:
        body = F.struct("userId", "movieId", "rating", "timestamp")
    else:
        body = rating_body()
    envelope = F.struct(F.struct("key").alias("headers"), body.alias("body"))
    ratings.select(F.to_json(envelope).alias("value")).write.mode("overwrite").text(path)
