"""Table sinks: keyed ratings, movies, features, lists, model parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.genres import genre_mask, has_genre
from reelrank.schemas import (
    CELL_COLUMNS,
    GENRE_FLAGS,
    INTERCEPT_IDX,
    MODEL_PARAMS,
)


def write_movies(movies: DataFrame, path: str) -> None:
    movies.select("movieId", "title", "genres").write.mode("overwrite").parquet(path)


def write_movies_onehot(movies: DataFrame, path: str) -> None:
    """Movies as header CSV with one 0/1 column per genre."""
    flags = [f"CAST({has_genre(g)} AS INT) AS {name}" for g, name in enumerate(GENRE_FLAGS)]
    movies.withColumn("mask", genre_mask(F.col("genres"))).selectExpr(
        "movieId", "title", "'' AS unused1", "'' AS unused2", *flags
    ).write.mode("overwrite").csv(path, header=True)


def write_keyed_ratings(ratings: DataFrame, path: str) -> None:
    """Keyed rating table, all columns stored as text.

    ``path`` must not be one the frame reads from: write beside it and switch.
    """
    stored_ratings(ratings).write.mode("overwrite").parquet(path)


def stored_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select("key", *(F.col(c).cast("string").alias(c) for c in CELL_COLUMNS))


def feature_kv(
    scope: str, users: DataFrame, movies: DataFrame, ratio: DataFrame
) -> DataFrame:
    """All features of a scope under their flat key names; values as doubles."""
    prefix = f"{scope}2feature"

    def metric(df: DataFrame, key: str, column: str, tag: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).select(
            F.concat_ws("_", F.lit(prefix), F.lit(key), F.lit(tag), F.col(key)).alias("key"),
            F.col(column).cast("double").alias("value"),
        )

    parts = [
        metric(df, key, column, tag)
        for df, key in ((users, "userId"), (movies, "movieId"))
        for column, tag in (("pos_cnt", "rating1"), ("neg_cnt", "rating0"))
    ]
    parts.append(
        ratio.select(
            F.concat_ws(
                "_", F.lit(prefix), F.lit("userId_to_genresId"), "userId", "genreId"
            ).alias("key"),
            F.col("ratio").alias("value"),
        )
    )
    return reduce(DataFrame.unionByName, parts)


def model_params(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """Coefficients by position, intercept under idx -1."""
    rows = [(i, float(c)) for i, c in enumerate(model.coefficients)]
    rows.append((INTERCEPT_IDX, float(model.intercept)))
    return params_table(spark, rows)


def params_table(spark: SparkSession, rows: list[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame(rows, MODEL_PARAMS)
