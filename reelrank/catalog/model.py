"""Training window, training set and model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.catalog.registry import (
    COEFFICIENTS,
    INTERCEPT,
    Inputs,
    query,
    rounded,
    sql,
)
from reelrank.operators.topk import recent_ratings
from reelrank.operators.training_window import COUNTS, TrainingBuffer, window_counts
from reelrank.plans import stored
from reelrank.plans.feature_tables import batch_feature_tables, feature_tables_for
from reelrank.plans.training import (
    assemble,
    fit_click_model,
    fitted_moments,
    join_batch_features,
    training_set,
)
from reelrank.schemas import FEATURE_COLUMNS, INTERCEPT_IDX
from reelrank.session import new_path, stage
from reelrank.sinks.tables import model_params, params_table
from reelrank.streaming.live import LiveTables

IN_WINDOW = "w.i BETWEEN b.i - b.h AND b.i - 1"
IN_WINDOW_AS_WRITTEN = "(w.i BETWEEN b.i - b.h + 1 AND b.i OR w.i = 0)"


def _window_sql(inside: str) -> str:
    """Counts by joining each record to the records in its window."""
    return f"""SELECT b.i, b.userId, b.movieId, b.rating,
  CAST(coalesce(sum(w.p) FILTER (w.userId = b.userId), 0) AS BIGINT) AS w_user_pos,
  CAST(coalesce(sum(1 - w.p) FILTER (w.userId = b.userId), 0) AS BIGINT) AS w_user_neg,
  CAST(coalesce(sum(w.p) FILTER (w.movieId = b.movieId), 0) AS BIGINT) AS w_movie_pos,
  CAST(coalesce(sum(1 - w.p) FILTER (w.movieId = b.movieId), 0) AS BIGINT) AS w_movie_neg,
  CAST(coalesce(sum(w.hits) FILTER (w.userId = b.userId), 0) AS BIGINT) AS w_user_hits
FROM buf b LEFT JOIN buf w ON {inside}
WHERE b.i > b.h GROUP BY b.i, b.userId, b.movieId, b.rating"""


def _training_sql(as_written: bool) -> str:
    window = _window_sql(IN_WINDOW_AS_WRITTEN if as_written else IN_WINDOW)
    genres = "" if as_written else "JOIN movie_genres g ON g.genreId = br.genreId"
    same_movie = "" if as_written else "AND g.movieId = w.movieId"
    return sql(
        "buf bu bm br movie_genres",
        f"""SELECT w.i, CAST(w.rating AS DOUBLE) AS label,
  CAST(coalesce(bu.pos, 0) AS DOUBLE) AS f0, CAST(coalesce(bu.neg, 0) AS DOUBLE) AS f1,
  CAST(coalesce(bm.pos, 0) AS DOUBLE) AS f2, CAST(coalesce(bm.neg, 0) AS DOUBLE) AS f3,
  round(coalesce((SELECT sum(ratio) FROM br {genres}
                  WHERE br.userId = w.userId {same_movie}), 0), 6) AS f4,
  CAST(w_user_pos AS DOUBLE) AS f5, CAST(w_user_neg AS DOUBLE) AS f6,
  CAST(w_movie_pos AS DOUBLE) AS f7, CAST(w_movie_neg AS DOUBLE) AS f8,
  round(coalesce(CAST(w_user_hits AS DOUBLE) / nullif(w_user_pos + w_user_neg, 0), 0), 6) AS f9
FROM ({window}) w LEFT JOIN bu ON bu.userId = w.userId LEFT JOIN bm ON bm.movieId = w.movieId""",
    )


def training_buffer(inputs: Inputs) -> TrainingBuffer:
    """The 200-record buffer as a stored list."""
    columns = [F.col("pos").alias("i"), "userId", "movieId", "rating"]
    recent = recent_ratings(inputs.stream()).select(*columns)
    return TrainingBuffer.of(stage(recent, "recent"))


def build_training_set(inputs: Inputs, as_written: bool = False) -> DataFrame:
    buffer = training_buffer(inputs)
    movies = inputs.movies()
    features = feature_tables_for(inputs.history(), movies, buffer.users, buffer.movies)
    return training_set(buffer, movies, features, as_written)


def _rounded_set(training: DataFrame) -> DataFrame:
    return training.select("i", "label", *(rounded(f) for f in FEATURE_COLUMNS))


def _counts(inputs: Inputs, as_written: bool) -> DataFrame:
    counts = window_counts(training_buffer(inputs), inputs.movies(), as_written)
    return counts.select("i", "userId", "movieId", F.col("rating").cast("double"), *COUNTS)


@query("training_window_counts", sql("buf", _window_sql(IN_WINDOW)))
def counts_default(inputs: Inputs) -> DataFrame:
    return _counts(inputs, as_written=False)


@query("training_window_counts_as_written", sql("buf", _window_sql(IN_WINDOW_AS_WRITTEN)))
def counts_as_written(inputs: Inputs) -> DataFrame:
    return _counts(inputs, as_written=True)


@query(
    "training_join_batch_features",
    sql(
        "buffer bu bm",
        """SELECT i, userId, movieId, CAST(coalesce(bu.pos, 0) AS DOUBLE) AS b_user_pos,
  CAST(coalesce(bu.neg, 0) AS DOUBLE) AS b_user_neg,
  CAST(coalesce(bm.pos, 0) AS DOUBLE) AS b_movie_pos,
  CAST(coalesce(bm.neg, 0) AS DOUBLE) AS b_movie_neg
FROM buffer LEFT JOIN bu USING (userId) LEFT JOIN bm USING (movieId)""",
    ),
)
def join_batch(inputs: Inputs) -> DataFrame:
    buffer = training_buffer(inputs)
    features = feature_tables_for(inputs.history(), inputs.movies(), buffer.users, buffer.movies)
    return join_batch_features(buffer.records, features, buffer.users, buffer.movies).drop("rating")


@query("training_set", _training_sql(as_written=False))
def training_default(inputs: Inputs) -> DataFrame:
    return _rounded_set(build_training_set(inputs))


@query("training_set_as_written", _training_sql(as_written=True))
def training_as_written(inputs: Inputs) -> DataFrame:
    return _rounded_set(build_training_set(inputs, as_written=True))


@query("assemble_features", _training_sql(as_written=False))
def assembled(inputs: Inputs) -> DataFrame:
    """Feature vectors, unpacked again for comparison."""
    vectors = assemble(build_training_set(inputs)).select(
        "i", "label", vector_to_array("features").alias("v")
    )
    return _rounded_set(
        vectors.select(
            "i", "label", *(F.col("v")[i].alias(f) for i, f in enumerate(FEATURE_COLUMNS))
        )
    )


#: Steps and tolerance with which the fit meets its certificate to the digits that are compared.
CERTIFIED = {"max_iter": 1000, "tolerance": 1e-12}
DIGITS = 3

CERTIFICATE_SQL = "\nUNION ALL ".join(
    f"SELECT {i} AS idx, round(avg(label * {x}), {DIGITS}) AS moment FROM ({_training_sql(False)})"
    for i, x in [(-1, "1"), *enumerate(FEATURE_COLUMNS)]
)


@query("fit_click_model", CERTIFICATE_SQL)
def fitted(inputs: Inputs) -> DataFrame:
    """The certificate of a fit: predictions and labels have equal means with every feature."""
    training = stored_training_set(inputs)
    params = model_params(inputs.spark, fit_click_model(training, **CERTIFIED))
    return fitted_moments(training, params).select("idx", F.round("moment", DIGITS).alias("moment"))


def stored_training_set(inputs: Inputs) -> DataFrame:
    """The training set from stored batch features of the buffer's users and movies."""
    buffer, movies = training_buffer(inputs), inputs.movies()
    tables = LiveTables(inputs.spark, new_path(inputs.spark, "training"))
    history = batch_feature_tables(inputs.history(), movies)
    stored.store_features(tables, "history", 0, {"batch": history})
    features = stored.features_of(tables, "batch", buffer.users.frame, buffer.movies.frame)
    return stage(training_set(buffer, movies, features), "training")


@query(
    "export_model_params",
    "\nUNION ALL ".join(
        f"SELECT {version} AS version, * FROM ({CERTIFICATE_SQL})" for version in (2, 3)
    ),
)
def exported(inputs: Inputs) -> DataFrame:
    """Versions of a model, written, taken into use in turn and read back, with their certificates.

    Version 1 is a fixed one; 2 is fitted, and 3 is 2 again, which is in use at the end.
    """
    spark, training = inputs.spark, stored_training_set(inputs)
    tables = LiveTables(spark, new_path(spark, "models"))
    stored.publish_model(tables, "release", 1, fixed_params(spark))
    params = stage(model_params(spark, fit_click_model(training, **CERTIFIED)), "params")
    stored.publish_model(tables, "release", 2, params)
    stored.use_model(tables, "rollback", 0, 1)
    stored.publish_model(tables, "release", 3, stored.params_of(tables, 2))
    parts = [
        fitted_moments(training, stored.params_of(tables, version)).select(
            F.lit(shown).alias("version"), "idx", F.round("moment", DIGITS).alias("moment")
        )
        for shown, version in ((2, 2), (3, None))
    ]
    return parts[0].union(parts[1])


def fixed_params(spark: SparkSession) -> DataFrame:
    return params_table(spark, [*enumerate(COEFFICIENTS), (INTERCEPT_IDX, INTERCEPT)])
