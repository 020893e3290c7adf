"""Positive / negative counts per user and per movie.

Most are hash aggregations with map-side partial sums, so a key that holds a
third of the input sends one row per map task to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import genre_hits
from reelrank.functions.polarity import is_positive, neg_count, pos_count
from reelrank.schemas import GENRE_FLAGS


def positive_counts(ratings: DataFrame, key: str, rule: str = "exact") -> DataFrame:
    return (
        ratings.where(is_positive(F.col("rating"), rule))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("pos_cnt"))
    )


def negative_counts(ratings: DataFrame, key: str) -> DataFrame:
    """Exact rule: only ratings equal to 0.0."""
    return (
        ratings.where(F.col("rating") == F.lit(0.0))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("neg_cnt"))
    )


def polarity_counts(ratings: DataFrame, *keys: str, rule: str = "exact") -> DataFrame:
    """Both counts per key in one pass; never-emitted metrics are null."""
    rating = F.col("rating")
    return (
        ratings.groupBy(*keys)
        .agg(pos_count(rating, rule).alias("pos_cnt"), neg_count(rating, rule).alias("neg_cnt"))
        .where("pos_cnt IS NOT NULL OR neg_cnt IS NOT NULL")
    )


def rating_counts(ratings: DataFrame, *keys: str) -> DataFrame:
    """Ratings per key, whatever their polarity."""
    return ratings.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def features_single_pass(
    ratings: DataFrame, *batch_keys: str, genres: bool = False, rule: str = "exact"
) -> DataFrame:
    """User and movie metrics from one scan and one shuffle.

    Each rating is sent to its user group and its movie group at once, and
    the rows are shuffled by group before anything is counted: a task then
    holds only the groups of its partition, not every user and movie that its
    input touches. With ``genres`` (the input then carries ``mask``) the user
    groups also count positive ratings per genre, ``g0`` .. ``g18``, without
    exploding the ratings.

    Output: ``entity`` ('user' / 'movie'), ``id``, batch keys, ``cnt``,
    ``pos_cnt``, ``neg_cnt`` and the genre counts.
    """
    carried = ["rating", *batch_keys, *(["mask"] if genres else [])]
    sides = F.array(
        F.struct(F.lit("user").alias("entity"), F.col("userId").alias("id")),
        F.struct(F.lit("movie").alias("entity"), F.col("movieId").alias("id")),
    )
    routed = ratings.select(*carried, F.inline(sides))
    return count_sides(routed, *batch_keys, genres=genres, rule=rule)


def expanded_sides(ratings: DataFrame, *carried: str) -> DataFrame:
    """Each rating for its user and for its movie, by an Expand: no array is built for a row."""
    named = ratings.select(
        *carried, F.col("userId").alias("user"), F.col("movieId").alias("movie")
    )
    return named.unpivot(list(carried), ["user", "movie"], "entity", "id")


def count_sides(
    sides: DataFrame, *batch_keys: str, genres: bool = False, rule: str = "exact"
) -> DataFrame:
    """The counts of ``features_single_pass``, of ratings that come once for each ``entity`` and ``id``."""
    rating = F.col("rating")
    groups = [*batch_keys, "entity", "id"]
    routed = sides.repartition(*(F.col(g) for g in groups))
    aggregates: list[Column] = [
        F.count(F.lit(1)).alias("cnt"),
        pos_count(rating, rule).alias("pos_cnt"),
        neg_count(rating, rule).alias("neg_cnt"),
    ]
    if genres:
        aggregates += genre_hits("positive")
        routed = routed.withColumn("positive", is_positive(rating, rule))
    grouped = routed.groupBy(*groups).agg(*aggregates)
    return grouped.selectExpr(
        "entity",
        "id",
        *batch_keys,
        "cnt",
        "pos_cnt",
        "neg_cnt",
        *(f"IF(entity = 'user', {g}, NULL) AS {g}" for g in GENRE_FLAGS if genres),
    )


def genre_ratios() -> list[str]:
    """Per genre: share of the positive ratings that carry it, null if none."""
    return [f"CAST(nullif({g}, 0) AS DOUBLE) / pos_cnt AS {g}" for g in GENRE_FLAGS]
