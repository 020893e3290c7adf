"""Hot lists, buffers and other bounded lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.catalog.registry import CUTOFF, Inputs, query, sql, text
from reelrank.operators.counts import rating_counts
from reelrank.operators.numbering import numbered
from reelrank.operators.topk import (
    genre_first,
    genre_hot_last_batch,
    genre_hot_topk,
    popular_bounded,
    popular_topk,
    recent_ratings,
)
from reelrank.operators.training_window import record_index
from reelrank.operators.upsert import append_bounded, replace_lists
from reelrank.schemas import GENRE_NAMES, RECENT_SIZE
from reelrank.session import new_path
from reelrank.sources.features import read_ordered
from reelrank.streaming.live import LiveTables, Upsert


def day_movie_counts(inputs: Inputs) -> DataFrame:
    return rating_counts(inputs.stream(), "batch_day", "movieId")


@query(
    "popular_topk",
    sql(
        "day_top", "SELECT CAST(batch_day AS VARCHAR) AS batch_day, pos, movieId, cnt FROM day_top"
    ),
)
def popular_per_batch(inputs: Inputs) -> DataFrame:
    return popular_topk(inputs.stream(), "batch_day").select(
        text("batch_day"), "pos", "movieId", "cnt"
    )


@query("popular_bounded30", sql("popular", "SELECT pos, movieId FROM popular"))
def popular_30(inputs: Inputs) -> DataFrame:
    return popular_bounded(day_movie_counts(inputs), "batch_day").select("pos", "movieId")


@query("read_ordered_list", sql("popular", "SELECT pos, movieId FROM popular WHERE pos <= 9"))
def read_list(inputs: Inputs) -> DataFrame:
    """Entries 0 to 9 of the popular list, in order."""
    popular = popular_bounded(day_movie_counts(inputs), "batch_day").select("pos", "movieId")
    return read_ordered(popular, 0, 9)


def _hot_sql(where: str = "TRUE") -> str:
    return f"""SELECT genreId, movieId, cnt,
  row_number() OVER (PARTITION BY genreId ORDER BY cnt DESC, movieId) AS pos
FROM (SELECT genreId, movieId, count(*) AS cnt FROM stream JOIN movie_genres USING (movieId)
      WHERE {where} GROUP BY genreId, movieId) QUALIFY pos <= 10"""


@query("genre_hot_topk", sql("stream movie_genres", _hot_sql()))
def hot(inputs: Inputs) -> DataFrame:
    return genre_hot_topk(inputs.stream(), inputs.movies())


@query("genre_hot_last_batch", sql("hot", "SELECT genreId, pos, movieId, cnt FROM hot"))
def hot_last_batch(inputs: Inputs) -> DataFrame:
    lists = genre_hot_last_batch(day_movie_counts(inputs), inputs.movies(), "batch_day")
    return lists.select("genreId", "pos", "movieId", "cnt")


@query(
    "genre_first10",
    sql(
        "stream movie_genres",
        """SELECT genreId, movieId, row_number() OVER (PARTITION BY genreId ORDER BY ts, seq) AS pos
FROM stream JOIN movie_genres USING (movieId) QUALIFY pos <= 10""",
    ),
)
def first_10(inputs: Inputs) -> DataFrame:
    return genre_first(inputs.stream(), inputs.movies()).select("genreId", "movieId", "pos")


RECENT_SQL = sql(
    "buffer", 'SELECT i AS pos, "key", userId, movieId, rating, "timestamp" FROM buffer'
)


def recent_columns(buffer: DataFrame) -> DataFrame:
    return buffer.select(
        "pos",
        "key",
        "userId",
        "movieId",
        F.col("rating").cast("double").alias("rating"),
        "timestamp",
    )


@query("recent_ratings_200", RECENT_SQL)
def recent(inputs: Inputs) -> DataFrame:
    return recent_columns(recent_ratings(inputs.stream()))


@query("append_bounded_list", RECENT_SQL)
def append_list(inputs: Inputs) -> DataFrame:
    """The later ratings pushed onto the buffer the earlier ones left."""
    old = recent_ratings(inputs.early()).drop("pos")
    return recent_columns(append_bounded(old, inputs.late(), ["ts", "seq"], RECENT_SIZE))


@query("record_index", sql("buffer", 'SELECT i, "key" FROM buffer'))
def index(inputs: Inputs) -> DataFrame:
    return record_index(recent_ratings(inputs.stream())).select("i", "key")


@query(
    "record_index_stream",
    sql("stream", 'SELECT row_number() OVER (ORDER BY ts, seq) - 1 AS i, "key" FROM stream'),
)
def index_all(inputs: Inputs) -> DataFrame:
    """The position of every live rating, however many there are."""
    return numbered(inputs.stream().select("key", "ts", "seq"), "ts", "seq").select("i", "key")


@query(
    "replace_list",
    sql(
        "stream movie_genres",
        f"""SELECT * FROM ({_hot_sql(f"rating = 1 AND batch_day > DATE '{CUTOFF}'")})
UNION ALL
SELECT * FROM ({_hot_sql(f"batch_day <= DATE '{CUTOFF}'")}) WHERE genreId NOT IN (
  SELECT genreId FROM stream JOIN movie_genres USING (movieId)
  WHERE rating = 1 AND batch_day > DATE '{CUTOFF}')""",
    ),
)
def replace(inputs: Inputs) -> DataFrame:
    """Stored lists by genre; those that come again replace the old ones."""
    tables = LiveTables(inputs.spark, new_path(inputs.spark, "lists"))

    def lists(version: int, ratings: DataFrame) -> None:
        rows = genre_hot_topk(ratings, inputs.movies())
        merge = lambda old, new: replace_lists(old, new, "genreId")
        tables.commit("lists", version, {"hot": Upsert(rows, "genreId", merge, len(GENRE_NAMES))})

    lists(0, inputs.early())
    lists(1, inputs.late().where("rating = 1"))
    return tables.read("hot")
