"""Ratings and genres: the movie lookup, per-genre ratios and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.genres import genre_hits, genre_mask, has_genre
from reelrank.functions.polarity import is_positive
from reelrank.operators.counts import rating_counts
from reelrank.operators.lookup import IdSet, lookup, of_ids
from reelrank.schemas import GENRE_FLAGS, GENRE_NAMES, GENRES, NUM_GENRES


def genres_dim(spark: SparkSession) -> DataFrame:
    """The fixed 19 genres as an inline table."""
    values = ", ".join(f"({g}, '{name}')" for g, name in enumerate(GENRE_NAMES))
    return spark.sql(f"SELECT * FROM VALUES {values} AS genres({', '.join(GENRES.names)})")


def explode_genres(ratings: DataFrame, movies: DataFrame, ids: IdSet | None = None) -> DataFrame:
    """One row per (rating, genre of its movie); no movie or no genres, no rows.

    ``ids`` are the movies of ``ratings``, where they were counted (``of_ids``).
    """
    genres = movies.select("movieId", "genres")
    return lookup(
        ratings, genres if ids is None else of_ids(genres, ids), "movieId", how="inner"
    ).select(*ratings.columns, F.explode("genres").alias("genreId"))


def with_mask(ratings: DataFrame, movies: DataFrame, ids: IdSet | None = None) -> DataFrame:
    """Adds the movie's genre mask; unknown or genreless movies get 0.

    ``ids`` are the movies of ``ratings``, where they were counted (``of_ids``).
    """
    masks = movies.select("movieId", genre_mask(F.col("genres")).alias("mask"))
    if ids is not None:
        masks = of_ids(masks, ids)
    return lookup(ratings, masks, "movieId").withColumn("mask", F.coalesce("mask", F.lit(0)))


def unpivot_genres(wide: DataFrame, *keys: str, value: str) -> DataFrame:
    """``g0`` .. ``g18`` columns -> (keys, genreId, value) rows, nulls dropped."""
    pairs = ", ".join(f"{g}, {name}" for g, name in enumerate(GENRE_FLAGS))
    stacked = f"stack({NUM_GENRES}, {pairs}) AS (genreId, {value})"
    return wide.selectExpr(*keys, stacked).where(F.col(value).isNotNull())


def user_genre_ratio(ratings: DataFrame, movies: DataFrame, *batch_keys: str) -> DataFrame:
    """Among a user's positive ratings, the share whose movie has each genre.

    Total and 19 genre counts come from one aggregation per user: one shuffle,
    and ratings are not multiplied by their genres.
    """
    positive = ratings.where(is_positive(F.col("rating"))).select("userId", "movieId", *batch_keys)
    counts = (
        with_mask(positive, movies)
        .groupBy("userId", *batch_keys)
        .agg(F.count(F.lit(1)).alias("total"), *genre_hits())
    )
    return _as_ratio(unpivot_genres(counts, "userId", *batch_keys, "total", value="hits"))


def _as_ratio(hits: DataFrame) -> DataFrame:
    ratio = F.col("hits").cast("double") / F.col("total")
    return hits.where("hits > 0").withColumn("ratio", ratio).drop("hits", "total")


def user_genre_share(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Loader variant: all ratings, shares of the user's genre hits (sum 1)."""
    masked = with_mask(ratings.select("userId", "movieId"), movies)
    counts = masked.groupBy("userId").agg(*genre_hits())
    totals = counts.withColumn("total", F.expr(" + ".join(GENRE_FLAGS)))
    return _as_ratio(unpivot_genres(totals, "userId", "total", value="hits"))


def genre_movie_counts(ratings: DataFrame, movies: DataFrame, *batch_keys: str) -> DataFrame:
    """Ratings per (genre, movie).

    Counting per movie comes first, so the genre step sees one row per movie
    and a hot movie is already a single number.
    """
    per_movie = rating_counts(ratings, *batch_keys, "movieId")
    return explode_genres(per_movie, movies).select(*batch_keys, "genreId", "movieId", "cnt")


def genre_record_counts(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings per genre name, all 19 names including those with none."""
    per_movie = rating_counts(ratings, "movieId")
    masked = with_mask(per_movie, movies)
    totals = masked.agg(
        *(
            F.expr(f"coalesce(sum(IF({has_genre(g)}, cnt, 0)), 0) AS {name}")
            for g, name in enumerate(GENRE_FLAGS)
        )
    )
    return genre_names(unpivot_genres(totals, value="cnt"), genres_dim(ratings.sparkSession))


def genre_names(counts: DataFrame, genres: DataFrame) -> DataFrame:
    """(genreId, cnt) with names; genres without a count read 0.

    ``counts`` has at most one row per genre of the fixed dimension.
    """
    return genres.join(F.broadcast(counts), "genreId", "left").select(
        "genreId", "name", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")
    )


def user_affinity_total(ratio: DataFrame) -> DataFrame:
    """Sum of all genre ratios of a user."""
    return ratio.groupBy("userId").agg(F.sum("ratio").alias("affinity"))
