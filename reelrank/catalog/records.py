"""Sources, sinks and record shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.catalog.registry import Inputs, query, sql
from reelrank.functions.messages import record_json
from reelrank.functions.polarity import is_positive
from reelrank.operators.cells import (
    cell_rows,
    explode_cells,
    pivot_cells,
    pivot_cells_as_stored,
    unpivot_cells,
)
from reelrank.operators.upsert import latest_by_key
from reelrank.schemas import GENRE_FLAGS, MESSAGES
from reelrank.session import new_path
from reelrank.sinks.messages import (
    publish_files,
    rating_body,
    to_messages,
    write_envelopes,
)
from reelrank.sinks.tables import (
    stored_ratings,
    write_keyed_ratings,
    write_movies,
    write_movies_onehot,
)
from reelrank.sources.files import (
    decode_ratings,
    decode_stored,
    movies_from_onehot,
    read_cell_rows,
    read_envelopes,
    read_movies,
    read_movies_onehot,
    scan_keyed_ratings,
)

RATING_SQL = 'SELECT "key", userId, movieId, rating, "timestamp" FROM stream'


def plain(ratings: DataFrame, *extra: str) -> DataFrame:
    rating = F.col("rating").cast("double").alias("rating")
    return ratings.select("key", "userId", "movieId", rating, "timestamp", *extra)


def _envelopes(inputs: Inputs, nested: bool) -> DataFrame:
    path = new_path(inputs.spark, "envelopes")
    write_envelopes(inputs.stream(), path, nested)
    return plain(read_envelopes(inputs.spark, path, on_bad="fail"))


@query("read_envelope_string_body", sql("stream", RATING_SQL))
def read_envelope_string_body(inputs: Inputs) -> DataFrame:
    return _envelopes(inputs, nested=False)


@query("read_envelope_nested_body", sql("stream", RATING_SQL))
def read_envelope_nested_body(inputs: Inputs) -> DataFrame:
    return _envelopes(inputs, nested=True)


def _onehot(inputs: Inputs) -> DataFrame:
    path = new_path(inputs.spark, "movies-csv")
    write_movies_onehot(inputs.movies(), path)
    return read_movies_onehot(inputs.spark, path)


@query(
    "read_movies_onehot_csv",
    sql(
        "movies",
        "SELECT movieId, title, "
        + ", ".join(
            f"CAST(list_contains(genres, {g}) AS INT) AS g{g}" for g in range(len(GENRE_FLAGS))
        )
        + " FROM movies",
    ),
)
def read_movies_onehot_csv(inputs: Inputs) -> DataFrame:
    return _onehot(inputs).drop("unused1", "unused2")


MOVIES_SQL = sql(
    "movies", "SELECT movieId, title, array_to_string(genres, ',') AS genres FROM movies"
)


def movie_text(movies: DataFrame) -> DataFrame:
    return movies.select("movieId", "title", F.array_join("genres", ",").alias("genres"))


@query("onehot_to_genres", MOVIES_SQL)
def onehot_to_genres(inputs: Inputs) -> DataFrame:
    return movie_text(movies_from_onehot(_onehot(inputs)))


@query("write_movies_dim", MOVIES_SQL)
def write_movies_dim(inputs: Inputs) -> DataFrame:
    path = new_path(inputs.spark, "movies")
    write_movies(inputs.movies(), path)
    return movie_text(read_movies(inputs.spark, path))


HISTORY_SQL = sql(
    "history",
    'SELECT "key", userId, movieId, rating, CAST(ts AS VARCHAR) AS "timestamp" FROM history',
)


def _with_text_time(ratings: DataFrame) -> DataFrame:
    return ratings.withColumn("timestamp", F.col("ts").cast("string"))


@query("upsert_ratings_by_key", HISTORY_SQL)
def upsert_ratings_by_key(inputs: Inputs) -> DataFrame:
    newest = latest_by_key(
        inputs.raw(), ["key"], [F.desc("ts"), F.desc("movieId"), F.desc("rating")]
    )
    return plain(_with_text_time(newest))


@query("scan_keyed_ratings", HISTORY_SQL)
def scan_keyed(inputs: Inputs) -> DataFrame:
    path = new_path(inputs.spark, "keyed-ratings")
    write_keyed_ratings(_with_text_time(inputs.history()), path)
    return plain(scan_keyed_ratings(inputs.spark, path))


@query("decode_rating_cells", HISTORY_SQL)
def decode_rating_cells(inputs: Inputs) -> DataFrame:
    stored = stored_ratings(_with_text_time(inputs.history()))
    as_bytes = stored.select(*(F.encode(c, "UTF-8").alias(c) for c in stored.columns))
    return plain(decode_stored(as_bytes, binary=True))


CELLS_SQL = sql(
    "stream",
    """SELECT "key" AS row_key, q AS qualifier, v AS value FROM (
  SELECT "key", 'movieId' AS q, CAST(movieId AS VARCHAR) AS v FROM stream
  UNION ALL SELECT "key", 'rating', CAST(CAST(rating AS DOUBLE) AS VARCHAR) FROM stream
  UNION ALL SELECT "key", 'timestamp', "timestamp" FROM stream
  UNION ALL SELECT "key", 'userId', CAST(userId AS VARCHAR) FROM stream)""",
)


def _cell_rows(inputs: Inputs, ratings: DataFrame) -> DataFrame:
    path = new_path(inputs.spark, "cells")
    cell_rows(ratings).write.parquet(path)
    return read_cell_rows(inputs.spark, path)


@query("scan_cells_long", CELLS_SQL)
def scan_cells_long(inputs: Inputs) -> DataFrame:
    return explode_cells(_cell_rows(inputs, inputs.stream()))


@query(
    "cells_unpivot",
    CELLS_SQL.replace("row_key", '"key"', 1).replace("q AS qualifier", "'details:' || q AS qualifier"),
)
def cells_unpivot(inputs: Inputs) -> DataFrame:
    return unpivot_cells(inputs.stream())


def _with_gaps(inputs: Inputs) -> DataFrame:
    """Negative ratings lose their rating cell."""
    return inputs.stream().withColumn(
        "rating", F.when(is_positive(F.col("rating")), F.col("rating"))
    )


def _pivot_sql(missing: str) -> str:
    return sql(
        "stream",
        f"""SELECT "key" AS row_key, CAST(movieId AS VARCHAR) AS movieId,
  CASE WHEN rating = 1 THEN '1.0' ELSE {missing} END AS rating, "timestamp",
  CAST(userId AS VARCHAR) AS userId FROM stream""",
    )


@query("cells_pivot", _pivot_sql("NULL"))
def cells_pivot(inputs: Inputs) -> DataFrame:
    return pivot_cells(_cell_rows(inputs, _with_gaps(inputs)))


@query("cells_pivot_as_written", _pivot_sql("'Null'"))
def cells_pivot_as_written(inputs: Inputs) -> DataFrame:
    return pivot_cells_as_stored(cell_rows(_with_gaps(inputs)))


@query(
    "decode_rating_json",
    sql(
        "stream",
        """SELECT "key", bad, CASE WHEN NOT bad THEN userId END AS userId,
  CASE WHEN NOT bad THEN movieId END AS movieId, CASE WHEN NOT bad THEN rating END AS rating,
  CASE WHEN NOT bad THEN "timestamp" END AS "timestamp"
FROM (SELECT *, hour(ts) = 0 AS bad FROM stream)""",
    ),
)
def decode_rating_json(inputs: Inputs) -> DataFrame:
    """Messages of each day's first hour are cut off; they are quarantined."""
    cut = F.when(F.hour("ts") == 0, F.left("value", F.lit(12))).otherwise(F.col("value"))
    stream = inputs.stream()
    messages = stream.select("ts", "key", rating_body().alias("value")).withColumn("value", cut)
    return plain(decode_ratings(messages, on_bad="quarantine"), "bad")


@query(
    "rating_to_json",
    sql(
        "stream",
        """SELECT "key", CAST(userId AS VARCHAR) AS userId, CAST(movieId AS VARCHAR) AS movieId,
  CAST(CAST(rating AS DOUBLE) AS VARCHAR) AS rating, "timestamp" FROM stream""",
    ),
)
def rating_to_json(inputs: Inputs) -> DataFrame:
    """Buffered records read back field by field: key order in JSON is free."""
    record = record_json(*(F.col(c) for c in ("userId", "movieId", "rating", "timestamp")))
    fields = ["userId", "movieId", "rating", "timestamp"]
    return (
        inputs.stream()
        .select("key", record.alias("record"))
        .select("key", *(F.get_json_object("record", f"$.{f}").alias(f) for f in fields))
    )


@query("publish_ratings", sql("stream", RATING_SQL))
def publish_ratings(inputs: Inputs) -> DataFrame:
    path = new_path(inputs.spark, "topic")
    publish_files(to_messages(inputs.stream()), path)
    messages = inputs.spark.read.schema(MESSAGES).parquet(path)
    return plain(decode_ratings(messages, on_bad="fail"))


@query(
    "positive_user_movie_pairs",
    sql("history", "SELECT userId, movieId FROM history WHERE rating = 1"),
)
def positive_user_movie_pairs(inputs: Inputs) -> DataFrame:
    return inputs.history().where(is_positive(F.col("rating"))).select("userId", "movieId")


@query(
    "head_sample",
    sql("stream", RATING_SQL + " ORDER BY ts, seq LIMIT 3"),
)
def head_sample(inputs: Inputs) -> DataFrame:
    """The first three records by arrival; the limit is the feature."""
    return plain(inputs.stream().orderBy("ts", "seq").limit(3))
