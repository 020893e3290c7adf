"""Training set and click model."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import genre_mask, masked_sum
from reelrank.functions.scoring import linear_score, logistic
from reelrank.operators.lookup import IdSet, bounded_lookup, default_zero
from reelrank.operators.training_window import (
    TrainingBuffer,
    window_affinity,
    window_counts,
)
from reelrank.plans.feature_tables import FeatureTables
from reelrank.plans.serving import param_columns
from reelrank.schemas import FEATURE_COLUMNS, GENRE_FLAGS, INTERCEPT_IDX

MAX_ITER, TOLERANCE = 20, 1e-6


def join_batch_features(
    records: DataFrame, features: FeatureTables, user_ids: IdSet, movie_ids: IdSet
) -> DataFrame:
    """Buffered records with the batch counts of their user and movie.

    Records are bounded, so the feature tables are scanned for the few ids
    that occur and never shuffled.
    """
    users = features.users.select(
        "userId", F.col("pos_cnt").alias("b_user_pos"), F.col("neg_cnt").alias("b_user_neg")
    )
    movies = features.movies.select(
        "movieId", F.col("pos_cnt").alias("b_movie_pos"), F.col("neg_cnt").alias("b_movie_neg")
    )
    joined = bounded_lookup(bounded_lookup(records, users, user_ids), movies, movie_ids)
    return default_zero(joined, "b_user_pos", "b_user_neg", "b_movie_pos", "b_movie_neg")


def training_set(
    buffer: TrainingBuffer,
    movies: DataFrame,
    features: FeatureTables,
    as_written: bool = False,
) -> DataFrame:
    """Label and ten features per record of the newer half of the buffer.

    ``as_written`` keeps the historical window (own label included, record 0
    never evicted) and sums a user's ratios over all genres instead of those
    of the movie.
    """
    counts = window_counts(buffer, movies, as_written)
    joined = join_batch_features(counts, features, buffer.users, buffer.movies)
    joined = bounded_lookup(joined, features.users.select("userId", *GENRE_FLAGS), buffer.users)
    if as_written:
        affinity = F.expr(" + ".join(f"coalesce({g}, 0D)" for g in GENRE_FLAGS))
    else:
        masks = movies.select("movieId", genre_mask(F.col("genres")).alias("mask"))
        joined = bounded_lookup(joined, masks, buffer.movies)
        affinity = masked_sum(GENRE_FLAGS, "coalesce(mask, 0)")
    values = [
        F.col("b_user_pos"),
        F.col("b_user_neg"),
        F.col("b_movie_pos"),
        F.col("b_movie_neg"),
        affinity,
        F.col("w_user_pos"),
        F.col("w_user_neg"),
        F.col("w_movie_pos"),
        F.col("w_movie_neg"),
        window_affinity(),
    ]
    return joined.select(
        "i",
        F.col("rating").cast("double").alias("label"),
        *(v.cast("double").alias(f) for v, f in zip(values, FEATURE_COLUMNS, strict=True)),
    )


def assemble(training: DataFrame) -> DataFrame:
    """Ten feature columns -> one dense vector."""
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features").transform(training)


def fit_click_model(
    training: DataFrame, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE
) -> LogisticRegressionModel:
    """Logistic regression on ``label`` and ``f0..f9``; both classes must occur."""
    stats = training.agg(
        F.count_if(F.col("label") == 1.0).alias("pos"),
        F.count_if(F.col("label") == 0.0).alias("neg"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    if stats["rows"] == 0:
        raise ValueError("cannot fit a model on an empty training set")
    if stats["pos"] + stats["neg"] != stats["rows"]:
        raise ValueError("labels must be 0.0 or 1.0")
    if not (stats["pos"] and stats["neg"]):
        raise ValueError("labels of both classes are needed")
    return LogisticRegression(maxIter=max_iter, tol=tolerance).fit(
        assemble(training).select("label", "features")
    )


def fitted_moments(training: DataFrame, params: DataFrame) -> DataFrame:
    """(idx, moment): the mean of prediction times feature, with idx -1 for the feature 1.

    A fit has converged when these are the means of label times feature, so they certify
    parameters without knowing how they were found.
    """
    weights, intercept = param_columns(params)
    p = logistic(linear_score([F.col(f) for f in FEATURE_COLUMNS], weights, intercept))
    values = {INTERCEPT_IDX: F.lit(1.0), **{i: F.col(f) for i, f in enumerate(FEATURE_COLUMNS)}}
    means = training.agg(*(F.avg(p * x).alias(f"m{i + 1}") for i, x in values.items()))
    pairs = ", ".join(f"{i}, m{i + 1}" for i in values)
    return means.selectExpr(f"stack({len(values)}, {pairs}) AS (idx, moment)")
