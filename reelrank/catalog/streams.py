"""Structured Streaming runs over the live ratings.

Messages lie in a file topic, a folder a day. One query takes them in micro-batches of so many files; as batch
numbers are days of the data, results are the same however many that are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelrank.catalog.features import (
    CUMULATIVE_SQL,
    LAST_BATCH_SQL,
    PER_DAY_SQL,
    long_rounded,
)
from reelrank.catalog.lists import RECENT_SQL, recent_columns
from reelrank.catalog.records import RATING_SQL, plain
from reelrank.catalog.registry import Inputs, query, sql
from reelrank.operators.topk import number_rows
from reelrank.session import concurrently, new_path
from reelrank.sinks.messages import publish_files, to_messages
from reelrank.sources.streams import file_messages
from reelrank.streaming import jobs, outputs
from reelrank.streaming.live import LiveTables
from reelrank.streaming.outputs import Output, table_of

ALL_NOW = {"availableNow": True}

#: Files of a micro-batch; a day of the given tables is one file.
DAYS = 8


class Run:
    """A file topic, the tables fed from it, and the folders of one streaming run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = new_path(spark, "stream")
        self.topic = f"{self.root}/topic"
        self.tables = LiveTables(spark, f"{self.root}/tables")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def publish(self, ratings: DataFrame) -> None:
        """Messages of each day in a folder of their own; those without a day come first."""
        day = F.coalesce(F.col("batch_day").cast("string"), F.lit("1970-01-01"))
        messages = to_messages(ratings.select("*", day.alias("day")), "day")
        publish_files(messages.repartition("day"), self.topic, "day")

    def messages(self, files: int | None) -> DataFrame:
        return file_messages(self.spark, self.topic, files).select("key", "value")

    def ratings(self, files: int | None) -> DataFrame:
        return jobs.ratings_of(self.messages(files))

    def drain(
        self, kept: dict[str, Output], files: int | None = DAYS, checkpoint: str = "checkpoint"
    ) -> StreamingQuery:
        """Processes what the topic holds beyond the checkpoint, in one query."""
        running = jobs.start(
            self.ratings(files), kept, self.tables, self.path(checkpoint), ALL_NOW
        )
        running.awaitTermination()
        return running

    def table(self, name: str) -> DataFrame:
        return table_of(self.tables, name)


def _follow(inputs: Inputs, kept: dict[str, Output], files: int | None = DAYS) -> Run:
    run = Run(inputs.spark)
    run.publish(inputs.stream())
    run.drain(kept, files)
    return run


_RATINGS = outputs.kept_rows("key", "userId", "movieId", "rating", "timestamp")


@query("stream_ratings_replay", sql("stream", RATING_SQL))
def replay(inputs: Inputs) -> DataFrame:
    """The whole topic, history first."""
    return plain(_follow(inputs, {"ratings": _RATINGS}, None).table("ratings"))


@query(
    "stream_ratings_latest",
    sql("stream", RATING_SQL + " WHERE batch_day > DATE '2024-01-15'"),
)
def latest(inputs: Inputs) -> DataFrame:
    """Only records that arrive after the stream took up its position."""
    run = Run(inputs.spark)
    run.publish(inputs.early())
    run.drain({}, None)
    run.publish(inputs.late())
    run.drain({"ratings": _RATINGS}, None)
    return plain(run.table("ratings"))


@query(
    "stream_upsert_ratings_by_key",
    sql(
        "stream",
        """SELECT concat(userId, '-', movieId) AS "key", userId, movieId, rating, "timestamp"
FROM stream
QUALIFY row_number() OVER (PARTITION BY userId, movieId ORDER BY ts DESC) = 1""",
    ),
)
def upsert(inputs: Inputs) -> DataFrame:
    """Keyed table fed by micro-batches; the key is the user and movie pair."""
    run = Run(inputs.spark)
    run.publish(inputs.stream().withColumn("key", F.concat_ws("-", "userId", "movieId")))
    run.drain({"ratings": outputs.keyed_ratings(order=("ts",))})
    return plain(outputs.newest_ratings(run.table("ratings"), ["ts"]))


@query("microbatch_feature_counts", PER_DAY_SQL)
def per_batch(inputs: Inputs) -> DataFrame:
    """Metrics of every day, from one query with a micro-batch for each day's file."""
    run = _follow(inputs, {"daily": outputs.daily_features(inputs.movies())}, 1)
    metrics = outputs.metrics_of(run.table("daily"))
    return long_rounded(metrics.withColumnRenamed(outputs.DAY, "batch"), "batch")


@query("stream_features_last_batch", LAST_BATCH_SQL)
def last_batch(inputs: Inputs) -> DataFrame:
    run = _follow(inputs, {"features": outputs.newest_features(inputs.movies())})
    return long_rounded(outputs.last_metrics_of(run.table("features")))


def _recent_rows(run: Run) -> DataFrame:
    return recent_columns(number_rows(run.table("recent"), F.asc("ts"), F.asc("seq")))


@query("stream_recent_buffer", RECENT_SQL)
def recent(inputs: Inputs) -> DataFrame:
    return _recent_rows(_follow(inputs, {"recent": outputs.recent()}))


POPULAR_SQL = sql("popular", "SELECT pos, movieId FROM popular")
HOT_SQL = sql("hot", "SELECT genreId, pos, movieId, cnt FROM hot")


@query("stream_popular", POPULAR_SQL)
def popular(inputs: Inputs) -> DataFrame:
    run = _follow(inputs, {"popular": outputs.popular()})
    return outputs.popular_list(run.table("popular"))


@query("stream_genre_hot", HOT_SQL)
def genre_hot(inputs: Inputs) -> DataFrame:
    run = _follow(inputs, {"hot": outputs.genre_hot(inputs.movies())})
    return outputs.genre_lists(run.table("hot"))


@query("batch_features_cumulative", CUMULATIVE_SQL)
def cumulative(inputs: Inputs) -> DataFrame:
    """Batch-scope features from the replayed topic: running totals over the
    backlog and, after a restart, what follows it; read from the state store."""
    run = Run(inputs.spark)
    for ratings in (inputs.early(), inputs.late()):
        run.publish(ratings)
        jobs.start_cumulative(
            run.ratings(None), inputs.movies(), run.path("totals"), ALL_NOW
        ).awaitTermination()
    return long_rounded(jobs.totals(inputs.spark, run.path("totals")))


@query(
    "dual_task_features",
    f"""SELECT 'streaming' AS scope, * FROM ({LAST_BATCH_SQL})
UNION ALL SELECT 'batch', * FROM ({CUMULATIVE_SQL})""",
)
def dual_task(inputs: Inputs) -> DataFrame:
    """Both tasks on one topic, each with its own state and checkpoint."""
    run = Run(inputs.spark)
    movies = inputs.movies()
    run.publish(inputs.stream())

    def drain(task: str) -> None:
        jobs.start_task(
            task, run.ratings(DAYS), movies, run.tables, run.path(task), ALL_NOW
        ).awaitTermination()

    concurrently(inputs.spark, *(lambda t=task: drain(t) for task in jobs.TASKS))
    live = outputs.last_metrics_of(run.table("features"))
    totals = jobs.totals(inputs.spark, run.path("batch"))
    return (
        long_rounded(live)
        .withColumn("scope", F.lit("streaming"))
        .unionByName(long_rounded(totals).withColumn("scope", F.lit("batch")))
    )


_ALL_SQL = f"""
SELECT 'features' AS output, concat(entity, ' ', id, ' ', metric) AS item,
       CAST(value AS DOUBLE) AS value FROM ({LAST_BATCH_SQL})
UNION ALL SELECT 'recent', concat("key", ' ', userId, ' ', movieId), CAST(pos AS DOUBLE)
FROM ({RECENT_SQL})
UNION ALL SELECT 'popular', concat(pos), CAST(movieId AS DOUBLE) FROM ({POPULAR_SQL})
UNION ALL SELECT 'genre_hot', concat(genreId, ' ', pos, ' ', movieId), CAST(cnt AS DOUBLE)
FROM ({HOT_SQL})
UNION ALL SELECT 'ratings', "key", CAST(movieId AS DOUBLE) FROM ({sql("stream", RATING_SQL)})"""


@query("stream_all_outputs", _ALL_SQL)
def all_outputs(inputs: Inputs) -> DataFrame:
    """Ratings, features, buffer and lists of one stream, committed together."""
    run = _follow(inputs, outputs.every_output(inputs.movies()))
    return all_rows_of(run)


def all_rows_of(run: Run) -> DataFrame:
    """Every output as (output, item, value)."""

    def part(name: str, rows: DataFrame, item, value: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("output"), item.alias("item"), F.col(value).cast("double").alias("value")
        )

    features = long_rounded(outputs.last_metrics_of(run.table("features")))
    hot = outputs.genre_lists(run.table("genre_hot"))
    return (
        part("features", features, F.concat_ws(" ", "entity", "id", "metric"), "value")
        .union(part("recent", _recent_rows(run), F.concat_ws(" ", "key", "userId", "movieId"), "pos"))
        .union(
            part(
                "popular",
                outputs.popular_list(run.table("popular")),
                F.col("pos").cast("string"),
                "movieId",
            )
        )
        .union(part("genre_hot", hot, F.concat_ws(" ", "genreId", "pos", "movieId"), "cnt"))
        .union(
            part("ratings", outputs.newest_ratings(run.table("ratings")), F.col("key"), "movieId")
        )
    )


@query(
    "stream_quarantine",
    sql(
        "stream",
        """SELECT "key", concat('{broken ', "key") AS value, n_in, n_in - n_bad AS n_good, n_bad
FROM stream, (SELECT count(*) AS n_in, count(*) FILTER (seq % 7 = 0) AS n_bad FROM stream)
WHERE seq % 7 = 0""",
    ),
)
def quarantine(inputs: Inputs) -> DataFrame:
    """Malformed messages with the counters of the run that kept them apart: in = good + bad.

    Every seventh message of the topic is broken on the way.
    """
    run = Run(inputs.spark)
    run.publish(inputs.stream())
    broken = F.when(F.col("key").cast("long") % 7 == 0, F.concat(F.lit("{broken "), "key"))
    arriving = run.messages(DAYS).withColumn("value", F.coalesce(broken, "value"))
    running = jobs.start(
        jobs.ratings_of(arriving), {"ratings": _RATINGS}, run.tables, run.path("checkpoint"), ALL_NOW
    )
    running.awaitTermination()
    counts = jobs.balance(running)
    return run.table(jobs.BAD).select(
        "key", "value", *(F.lit(n).cast("long").alias(name) for name, n in counts.items())
    )
