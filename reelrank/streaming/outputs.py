"""What streams keep of the ratings: one output a table, as a change for each micro-batch.

A batch number is the day of a rating's own time, and rows of one day add up wherever they come
from. So how a trigger cuts the stream into micro-batches, and in which order days arrive, changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.operators.counts import features_single_pass, rating_counts
from reelrank.operators.genres import explode_genres, with_mask
from reelrank.operators.lookup import IdSet
from reelrank.operators.topk import latest_genre_lists, popular_bounded
from reelrank.operators.upsert import append_bounded, latest_by_key
from reelrank.plans.feature_tables import last_batch_metrics, with_ratios
from reelrank.schemas import GENRE_FLAGS, POPULAR_SIZE, RECENT_SIZE, TOP_K
from reelrank.streaming.live import Append, Change, LiveTables, Replace

Output = Callable[[DataFrame], Change]

DAY = "day"
COUNTS = ["cnt", "pos_cnt", "neg_cnt", *GENRE_FLAGS]


def all_rows(rows: DataFrame) -> DataFrame:
    """Nothing is merged but the files."""
    return rows


def kept_rows(*columns: str) -> Output:
    """The ratings themselves."""
    return lambda batch: Append(batch.select(*columns), all_rows)


def day_counts(batch: DataFrame, movies: DataFrame) -> DataFrame:
    """Counts of every user and movie by day, genres included."""
    ratings = batch.select("userId", "movieId", "rating", DAY)
    masked = with_mask(ratings, movies, IdSet.of(batch, "movieId"))
    return features_single_pass(masked, DAY, genres=True)


def added_up(rows: DataFrame) -> DataFrame:
    """One row for each user or movie and day."""
    return rows.groupBy("entity", "id", DAY).agg(*(F.sum(c).alias(c) for c in COUNTS))


def newest_counts(rows: DataFrame) -> DataFrame:
    """The days of a user or movie that are the last one for any of its counts."""
    own = Window.partitionBy("entity", "id")
    last = [F.max(F.when(F.col(c) > 0, F.col(DAY))).over(own) for c in COUNTS]
    needed = reduce(
        lambda a, b: a | b,
        ((F.col(c) > 0) & (F.col(DAY) == when) for c, when in zip(COUNTS, last, strict=True)),
    )
    return added_up(rows).withColumn("_needed", needed).where("_needed").drop("_needed")


def daily_features(movies: DataFrame) -> Output:
    """Counts of all days."""
    return lambda batch: Append(day_counts(batch, movies), added_up)


def newest_features(movies: DataFrame) -> Output:
    """Counts of the days that the last-batch features come from."""
    return lambda batch: Append(day_counts(batch, movies), newest_counts)


def metrics_of(counts: DataFrame) -> DataFrame:
    """Stored counts -> metrics per user or movie and day."""
    return with_ratios(added_up(counts))


def last_metrics_of(counts: DataFrame) -> DataFrame:
    """Stored counts -> every metric's value on the last day that has it."""
    return last_batch_metrics(metrics_of(counts), DAY)


def keyed_ratings(order: Sequence[str] = ("ts", "seq", "movieId", "rating")) -> Output:
    """Newest rating per key."""
    columns = dict.fromkeys(["key", "userId", "movieId", "rating", "timestamp", *order])

    def newest(rows: DataFrame) -> DataFrame:
        return newest_ratings(rows, order)

    return lambda batch: Append(newest(batch.select(*columns)), newest)


def newest_ratings(
    rows: DataFrame, order: Sequence[str] = ("ts", "seq", "movieId", "rating")
) -> DataFrame:
    return latest_by_key(rows, ["key"], [F.desc(c) for c in order])


def recent(order: Sequence[str] = ("ts", "seq"), size: int = RECENT_SIZE) -> Output:
    """Buffer of the newest ``size`` ratings."""
    columns = [*order, "key", "userId", "movieId", "rating", "timestamp"]

    def change(batch: DataFrame) -> Replace:
        newest = batch.select(*columns).orderBy(*(F.desc(c) for c in order)).limit(size)

        def fold(old: DataFrame | None) -> DataFrame:
            before = newest.limit(0) if old is None else old.select(*columns)
            return append_bounded(before, newest, order, size).select(*columns).coalesce(1)

        return Replace(fold)

    return change


def movie_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy(DAY, "movieId").agg(F.sum("cnt").alias("cnt"))


def popular(k: int = TOP_K, size: int = POPULAR_SIZE) -> Output:
    """Ratings by movie of the last days, as many as fill a list of ``size`` with ``k`` a day."""

    def merge(rows: DataFrame) -> DataFrame:
        counts = movie_days(rows)
        days = counts.groupBy(DAY).agg(F.least(F.count("*"), F.lit(k)).alias("_n"))
        # A row for each day: what newer days push behind a full list is out for good.
        newer = Window.orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1)
        filled = F.coalesce(F.sum("_n").over(newer), F.lit(0))
        needed = days.withColumn("_before", filled).where(F.col("_before") < size).select(DAY)
        return counts.join(needed, DAY, "left_semi")

    return lambda batch: Append(rating_counts(batch, DAY, "movieId"), merge)


def popular_list(counts: DataFrame, size: int = POPULAR_SIZE) -> DataFrame:
    """(pos, movieId) of the list in which each day pushes its top movies."""
    return popular_bounded(movie_days(counts), DAY, size).select("pos", "movieId")


def genre_hot(movies: DataFrame) -> Output:
    """Ratings by movie and genre on the last day of each genre."""

    def merge(rows: DataFrame) -> DataFrame:
        counts = genre_days(rows)
        # One row per genre.
        newest = counts.groupBy("genreId").agg(F.max(DAY).alias(DAY))
        return counts.join(newest, ["genreId", DAY], "left_semi")

    def change(batch: DataFrame) -> Append:
        ids = IdSet.of(batch, "movieId")
        exploded = explode_genres(rating_counts(batch, DAY, "movieId"), movies, ids)
        return Append(exploded.select("genreId", DAY, "movieId", "cnt"), merge)

    return change


def genre_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("genreId", DAY, "movieId").agg(F.sum("cnt").alias("cnt"))


def genre_lists(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """(genreId, pos, movieId, cnt) of the hot list of each genre."""
    return latest_genre_lists(genre_days(counts), DAY, k).select("genreId", "pos", "movieId", "cnt")


def every_output(movies: DataFrame) -> dict[str, Output]:
    """All that one stream of ratings keeps up to date."""
    return {
        "ratings": keyed_ratings(),
        "features": newest_features(movies),
        "recent": recent(),
        "popular": popular(),
        "genre_hot": genre_hot(movies),
    }


def table_of(tables: LiveTables, name: str) -> DataFrame:
    """A table that must be there."""
    found = tables.read(name)
    if found is None:
        raise ValueError(f"no batch has written {name!r} below {tables.root}")
    return found

