"""Rating stream jobs.

A job is a set of outputs (``outputs``) that one stream keeps in one set of tables (``live``). Each
micro-batch is computed once, and all its changes become visible together.
"""

from __future__ import annotations

from threading import Event

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelrank.functions.genres import genre_hits, genre_mask
from reelrank.functions.polarity import is_positive
from reelrank.plans.feature_tables import METRICS, with_ratios
from reelrank.sources.files import decode_ratings
from reelrank.streaming.live import Append, LiveTables
from reelrank.streaming.outputs import DAY, Output, all_rows, newest_features

TRIGGER = {"processingTime": "30 seconds"}

#: The table of malformed messages, and the counters that a progress report carries.
BAD, COUNTERS = "bad_messages", "messages"


def ratings_of(messages: DataFrame, on_bad: str = "quarantine") -> DataFrame:
    """Messages -> ratings with ``ts`` and ``seq`` giving the arrival order, and the ``day`` of ``ts``.

    Timestamps may be text, or seconds or milliseconds since 1970; what is neither counts as
    the start of 1970. Keys that are no numbers are ordered by their hash, so the order
    never depends on a null. Malformed messages come with ``bad`` true; ``start`` keeps
    them apart.
    """
    # No number has a colon; casts that fail are slow, as each throws and catches an exception.
    number = F.when(~F.contains("timestamp", F.lit(":")), F.col("timestamp").try_cast("bigint"))
    # Seconds reach this size in the year 5138, milliseconds passed it in 1973.
    seconds = F.when(F.abs(number) < 100_000_000_000, number).otherwise(number / 1000)
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    text = F.when(number.isNull(), F.col("timestamp").try_cast("timestamp_ntz"))
    since = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return (
        decode_ratings(messages, on_bad)
        .withColumns(
            {
                "ts": F.coalesce(text, since, epoch),
                "seq": F.coalesce(F.col("key").try_cast("bigint"), F.xxhash64("key")),
            }
        )
        .withColumn(DAY, F.to_date("ts"))
    )


def start(
    ratings: DataFrame,
    outputs: dict[str, Output],
    tables: LiveTables,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keeps ``outputs`` up to date in ``tables``, a commit for every micro-batch.

    Malformed messages go to the table ``bad_messages`` in the same commit. The counters ``n_in``,
    ``n_good`` and ``n_bad`` of each micro-batch are in the query's progress under ``messages``.
    """
    counted = "bad" in ratings.columns
    if counted:
        ratings = ratings.observe(
            COUNTERS,
            F.count(F.lit(1)).alias("n_in"),
            F.count_if(~F.col("bad")).alias("n_good"),
            F.count_if("bad").alias("n_bad"),
        )
    started, run = Event(), {}

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The id belongs to the checkpoint and outlives restarts.
        started.wait()
        if tables.has(run["id"], batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            changes = {}
            if counted:
                # Counting fills the cache; all that follows reads it.
                if batch.where("bad").count():
                    bad = batch.where("bad").select("key", "value")
                    changes[BAD] = Append(bad, all_rows)
                batch = batch.where("NOT bad").drop("bad", "value")
            changes |= {name: change(batch) for name, change in outputs.items()}
            tables.commit(run["id"], batch_id, changes)
        finally:
            batch.unpersist()

    query = (
        ratings.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )
    run["id"] = query.id
    started.set()
    return query


def balance(query: StreamingQuery) -> dict[str, int]:
    """Counters of the micro-batches that ``query`` still reports, added up; all messages are good or bad."""
    found = dict.fromkeys(("n_in", "n_good", "n_bad"), 0)
    for progress in query.recentProgress:
        counters = progress.observedMetrics.get(COUNTERS)
        for name in found if counters else ():
            found[name] += counters[name]
    if found["n_in"] != found["n_good"] + found["n_bad"]:
        raise ValueError(f"messages are missing: {found}")
    return found


def cumulative_features(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Running totals over everything streamed so far, kept in Spark's state store.

    The metrics come in the order of ``METRICS``, as ``totals`` reads them from the store. Malformed
    messages add to no total; the run that keeps the ratings logs them.
    """
    if "bad" in ratings.columns:
        ratings = ratings.where("NOT bad")
    masks = movies.select("movieId", genre_mask(F.col("genres")).alias("mask"))
    masked = ratings.select("userId", "movieId", "rating").join(masks, "movieId", "left")
    entities = F.explode(
        F.array(
            F.struct(F.lit("user").alias("entity"), F.col("userId").alias("id")),
            F.struct(F.lit("movie").alias("entity"), F.col("movieId").alias("id")),
        )
    ).alias("e")
    rows = masked.select("rating", "mask", entities).select(
        "e.entity",
        "e.id",
        "rating",
        F.when(F.col("e.entity") == "user", F.col("mask")).alias("mask"),
    )
    rating = F.col("rating")
    return (
        rows.withColumn("positive", is_positive(rating))
        .groupBy("entity", "id")
        .agg(
            F.count_if(is_positive(rating)).alias("pos_cnt"),
            F.count_if(rating == F.lit(0.0)).alias("neg_cnt"),
            *genre_hits("positive"),
        )
    )


def start_cumulative(
    ratings: DataFrame, movies: DataFrame, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Batch-scope features by replay: totals never shrink to the last batch.

    The totals live in the state store below the checkpoint and nowhere else.
    """
    return (
        cumulative_features(ratings, movies)
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def totals(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(entity, id, metrics) after a micro-batch of ``start_cumulative``, by default the last one."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    # The store names all counts alike; they come in the order of METRICS.
    counts = F.col("value").cast(f"struct<{','.join(f'{m}: bigint' for m in METRICS)}>")
    found = reader.load(checkpoint).select("key.entity", "key.id", counts.alias("v"))
    return with_ratios(
        found.select("entity", "id", *(F.nullif(f"v.{m}", F.lit(0)).alias(m) for m in METRICS))
    ).where("pos_cnt IS NOT NULL OR neg_cnt IS NOT NULL")


TASKS = ("streaming", "batch")


def start_task(
    task: str,
    ratings: DataFrame,
    movies: DataFrame,
    tables: LiveTables,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """One code path for both scopes: ``streaming`` follows the newest day in ``tables``,
    ``batch`` keeps totals in its checkpoint (``totals``)."""
    if task == "streaming":
        return start(ratings, {"features": newest_features(movies)}, tables, checkpoint, trigger)
    if task == "batch":
        return start_cumulative(ratings, movies, checkpoint, trigger)
    raise ValueError(f"unknown task {task!r}, expected one of {TASKS}")
