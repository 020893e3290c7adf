"""Feature tables of the batch and the streaming scope."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.counts import (
    count_sides,
    expanded_sides,
    features_single_pass,
    genre_ratios,
)
from reelrank.operators.genres import unpivot_genres, with_mask
from reelrank.operators.lookup import IdSet, only_keys
from reelrank.operators.upsert import latest_metrics
from reelrank.schemas import GENRE_FLAGS
from reelrank.session import stage
from reelrank.sinks.tables import feature_kv

METRICS = ["pos_cnt", "neg_cnt", *GENRE_FLAGS]


@dataclass(frozen=True)
class FeatureTables:
    """``users``: userId, pos_cnt, neg_cnt and the 19 genre ratios ``g0..g18``;
    ``movies``: movieId, pos_cnt, neg_cnt. Null means never emitted."""

    users: DataFrame
    movies: DataFrame

    def ratio(self) -> DataFrame:
        """Genre ratios in long form."""
        return unpivot_genres(self.users, "userId", value="ratio")

    def kv(self, scope: str) -> DataFrame:
        return feature_kv(scope, self.users, self.movies, self.ratio())


def split(metrics: DataFrame) -> FeatureTables:
    """(entity, id, metrics) -> the two tables."""
    users = metrics.where("entity = 'user'").select(F.col("id").alias("userId"), *METRICS)
    movies = metrics.where("entity = 'movie'").select(
        F.col("id").alias("movieId"), "pos_cnt", "neg_cnt"
    )
    emitted = "pos_cnt IS NOT NULL OR neg_cnt IS NOT NULL"
    return FeatureTables(users.where(emitted), movies.where(emitted))


def with_ratios(counts: DataFrame) -> DataFrame:
    """Genre counts -> genre ratios, other columns kept."""
    rest = [c for c in counts.columns if c not in GENRE_FLAGS]
    return counts.selectExpr(*rest, *genre_ratios())


def cumulative_metrics(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """All metrics over the whole input, one pass."""
    masked = with_mask(ratings.select("userId", "movieId", "rating"), movies)
    return with_ratios(count_sides(expanded_sides(masked, "rating", "mask"), genres=True))


def microbatch_metrics(ratings: DataFrame, movies: DataFrame, batch_key: str) -> DataFrame:
    """All metrics per batch, no state across batches."""
    masked = with_mask(ratings.select("userId", "movieId", "rating", batch_key), movies)
    return with_ratios(features_single_pass(masked, batch_key, genres=True))


def last_batch_metrics(metrics: DataFrame, batch_key: str) -> DataFrame:
    """Per metric, the value of the last batch that emitted it."""
    return latest_metrics(metrics, ["entity", "id"], METRICS, batch_key)


def batch_feature_tables(ratings: DataFrame, movies: DataFrame) -> FeatureTables:
    """Batch scope over the full history, computed once and staged."""
    return split(stage(cumulative_metrics(ratings, movies), "batch-features", "entity"))


def metrics_long(metrics: DataFrame, *keys: str) -> DataFrame:
    """Wide metrics -> (entity, id, keys, metric, value), emitted ones only."""
    pairs = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS)
    stacked = f"stack({len(METRICS)}, {pairs}) AS (metric, value)"
    return metrics.selectExpr("entity", "id", *keys, stacked).where("value IS NOT NULL")


def stage_microbatches(ratings: DataFrame, movies: DataFrame, batch_key: str) -> DataFrame:
    """Per-batch metrics as the stream job logs them."""
    return stage(microbatch_metrics(ratings, movies, batch_key), "stream-features", "entity")


def streaming_feature_tables(log: DataFrame, batch_key: str) -> FeatureTables:
    """Streaming scope from the log of per-batch metrics."""
    users = latest_metrics(log.where("entity = 'user'"), ["id"], METRICS, batch_key)
    movies = latest_metrics(
        log.where("entity = 'movie'"), ["id"], ["pos_cnt", "neg_cnt"], batch_key
    )
    return FeatureTables(
        users.withColumnRenamed("id", "userId"), movies.withColumnRenamed("id", "movieId")
    )


def feature_tables_for(
    ratings: DataFrame, movies: DataFrame, users: IdSet, movie_ids: IdSet
) -> FeatureTables:
    """Batch features of some users and movies.

    Ratings that touch neither set are dropped by lookups before anything else
    is shuffled. Rows kept for a user only make other movies' counts
    partial, and those movies are cut off again at the end.
    """
    touched = (
        ratings.select("userId", "movieId", "rating")
        .join(users.hint(users.frame.withColumn("_u", F.lit(True))), "userId", "left")
        .join(movie_ids.hint(movie_ids.frame.withColumn("_m", F.lit(True))), "movieId", "left")
        .where("_u OR _m")
        .drop("_u", "_m")
    )
    tables = batch_feature_tables(touched, movies)
    return FeatureTables(only_keys(tables.users, users), only_keys(tables.movies, movie_ids))
