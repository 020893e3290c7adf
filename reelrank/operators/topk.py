"""Top-k lists.

``row_number() <= k`` lets Spark prune each group to k rows before the
shuffle (WindowGroupLimit), so few or hot groups do not pile up in a task.
All orders are total, so results do not depend on row arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelrank.operators.counts import rating_counts
from reelrank.operators.genres import explode_genres, genre_movie_counts
from reelrank.schemas import POPULAR_SIZE, RECENT_SIZE, TOP_K


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, pos: str = "pos"
) -> DataFrame:
    """First ``k`` rows per group, numbered from 1."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(pos, F.row_number().over(window)).where(F.col(pos) <= k)


def number_rows(bounded: DataFrame, *order: Column, pos: str = "pos") -> DataFrame:
    """0-based position over a whole frame; for frames of bounded size only."""
    return bounded.withColumn(pos, F.row_number().over(W.orderBy(*order)) - 1)


def popular_topk(ratings: DataFrame, *batch_keys: str, k: int = TOP_K) -> DataFrame:
    """Most rated movies, per batch if batch keys are given; ties by movie id."""
    return popular_of_counts(rating_counts(ratings, *batch_keys, "movieId"), *batch_keys, k=k)


def popular_of_counts(counts: DataFrame, *batch_keys: str, k: int = TOP_K) -> DataFrame:
    order = [F.desc("cnt"), F.asc("movieId")]
    if batch_keys:
        return top_per_group(counts, batch_keys, order, k)
    top = counts.orderBy(*order).limit(k)
    return number_rows(top, *order).withColumn("pos", F.col("pos") + 1)


def popular_bounded(counts: DataFrame, batch_key: str, size: int = POPULAR_SIZE) -> DataFrame:
    """Each batch pushes its top 10 into a FIFO of ``size``; repeats stay.

    ``counts`` are ratings per (batch, movie).
    """
    tops = popular_of_counts(counts, batch_key).withColumnRenamed("pos", "rank")
    newest = bounded_tail(tops, [batch_key, "rank"], size)
    return newest.select("pos", "movieId", batch_key, "rank")


def bounded_tail(rows: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Last ``size`` rows by ``order``, oldest first, ``pos`` from 0."""
    newest = rows.orderBy(*(F.desc(c) for c in order)).limit(size)
    return number_rows(newest, *(F.asc(c) for c in order))


def recent_ratings(
    ratings: DataFrame, order: Sequence[str] = ("ts", "seq"), size: int = RECENT_SIZE
) -> DataFrame:
    return bounded_tail(ratings, order, size)


def genre_hot_topk(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """Most rated movies of each genre."""
    counts = genre_movie_counts(ratings, movies)
    return top_per_group(counts, ["genreId"], [F.desc("cnt"), F.asc("movieId")], k)


def genre_hot_last_batch(
    counts: DataFrame, movies: DataFrame, batch_key: str, k: int = TOP_K
) -> DataFrame:
    """Hot list of each genre from the last batch in which the genre occurred.

    ``counts`` are ratings per (batch, movie).
    """
    exploded = explode_genres(counts.select(batch_key, "movieId", "cnt"), movies)
    return latest_genre_lists(exploded, batch_key, k)


def latest_genre_lists(counts: DataFrame, batch_key: str, k: int = TOP_K) -> DataFrame:
    """Per genre, the top ``k`` of its newest batch only.

    Ordering by batch first puts the newest batch on top, so one pruned
    ranking finds it; the rest of the ranking is then cut by comparing with
    the first row of the (at most ``k`` row) group.
    """
    order = [F.desc(batch_key), F.desc("cnt"), F.asc("movieId")]
    ranked = top_per_group(counts, ["genreId"], order, k)
    newest = F.max(batch_key).over(W.partitionBy("genreId"))
    marked = ranked.withColumn("newest", newest)
    return marked.where(F.col("newest") == F.col(batch_key)).drop("newest")


def genre_first(
    ratings: DataFrame,
    movies: DataFrame,
    order: Sequence[str] = ("ts", "seq"),
    k: int = TOP_K,
) -> DataFrame:
    """First ``k`` records of each genre by arrival, repeats included.

    No genre takes more than ``k`` records of a movie, so each movie's records are pruned before they are
    multiplied by its genres.
    """
    arrival = [F.asc(c) for c in order]
    first = top_per_group(ratings.select("movieId", *order), ["movieId"], arrival, k).drop("pos")
    return top_per_group(explode_genres(first, movies), ["genreId"], arrival, k)
