"""Recall, scoring and ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.catalog.registry import (
    COEFFICIENTS,
    INTERCEPT,
    Inputs,
    query,
    rounded,
    sql,
)
from reelrank.operators.topk import genre_hot_last_batch, popular_bounded
from reelrank.plans import serving, stored
from reelrank.plans.feature_tables import (
    FeatureTables,
    batch_feature_tables,
    stage_microbatches,
    streaming_feature_tables,
)
from reelrank.schemas import FEATURE_COLUMNS, GENRE_FLAGS, INTERCEPT_IDX
from reelrank.session import concurrently, new_path, stage
from reelrank.sinks.tables import params_table
from reelrank.sources.driver_tables import table
from reelrank.streaming.live import LiveTables


@dataclass(frozen=True)
class Serving:
    """Stored features and lists that recommendations are made from."""

    movies: DataFrame
    streaming: FeatureTables
    popular: DataFrame
    hot: DataFrame
    batch: FeatureTables | None = None

    def favorites(self) -> DataFrame:
        favorite = serving.favorite_of(GENRE_FLAGS)
        return self.streaming.users.select("userId", favorite.alias("genreId"))

    def recalled(self) -> DataFrame:
        return serving.recall(self.favorites(), self.popular, self.hot)

    def joined(self) -> DataFrame:
        """Candidates with user and movie features of both scopes."""
        profiles = serving.user_profiles(self.batch, self.streaming)
        pool = serving.candidate_movies(
            self.popular, self.hot, self.movies, self.batch, self.streaming
        )
        return serving.join_candidates(serving.recall(profiles, self.popular, self.hot), pool)

    def vectors(self, as_written: bool = False) -> DataFrame:
        return serving.feature_vector(self.joined(), as_written=as_written)

    def scored(self) -> DataFrame:
        return serving.score(self.vectors(), COEFFICIENTS, INTERCEPT)

    def recommended(self, as_written: bool = False) -> DataFrame:
        return serving.recommend(
            self.popular,
            self.hot,
            self.movies,
            self.batch,
            self.streaming,
            COEFFICIENTS,
            INTERCEPT,
            as_written=as_written,
        )


def build(inputs: Inputs, with_batch: bool = True) -> Serving:
    """Feature jobs as they run before serving: the stream log and the batch
    features are each computed in one pass and stored, side by side."""
    movies = inputs.movies()

    def live() -> tuple[FeatureTables, DataFrame, DataFrame]:
        log = stage_microbatches(inputs.stream(), movies, "batch_day")
        counts = log.where("entity = 'movie'").selectExpr("batch_day", "id AS movieId", "cnt")
        popular = popular_bounded(counts, "batch_day").select("pos", "movieId")
        hot = genre_hot_last_batch(counts, movies, "batch_day").select("genreId", "pos", "movieId")
        lists = concurrently(
            inputs.spark, lambda: stage(popular, "popular"), lambda: stage(hot, "genre-hot")
        )
        return streaming_feature_tables(log, "batch_day"), *lists

    def history() -> FeatureTables | None:
        return batch_feature_tables(inputs.history(), movies) if with_batch else None

    (streaming, popular, hot), batch = concurrently(inputs.spark, live, history)
    return Serving(movies, streaming, popular, hot, batch)


@query("favorite_genre", sql("fav", "SELECT userId, genreId FROM fav"))
def favorite(inputs: Inputs) -> DataFrame:
    return build(inputs, with_batch=False).favorites()


@query(
    "favorite_genre_candidates",
    sql("fav hot", "SELECT userId, genreId, pos - 1 AS pos, movieId FROM fav JOIN hot USING (genreId)"),
)
def favorite_candidates(inputs: Inputs) -> DataFrame:
    tables = build(inputs, with_batch=False)
    return serving.favorite_candidates(tables.favorites(), tables.hot)


@query("recall_candidates", sql("recalled", "SELECT userId, movieId FROM recalled"))
def recall_candidates(inputs: Inputs) -> DataFrame:
    return build(inputs, with_batch=False).recalled()


@query(
    "candidates_titles",
    sql("recalled movies", "SELECT userId, movieId, title FROM recalled LEFT JOIN movies USING (movieId)"),
)
def candidates_titles(inputs: Inputs) -> DataFrame:
    tables = build(inputs, with_batch=False)
    return serving.with_titles(tables.recalled(), tables.movies).select(
        "userId", "movieId", "title"
    )


@query(
    "candidates_cross_params",
    sql(
        "recalled",
        "SELECT userId, movieId, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS c{i}" for i, c in enumerate(COEFFICIENTS))
        + f", CAST({INTERCEPT} AS DOUBLE) AS intercept FROM recalled",
    ),
)
def candidates_params(inputs: Inputs) -> DataFrame:
    rows = [*enumerate(COEFFICIENTS), (INTERCEPT_IDX, INTERCEPT)]
    params = params_table(inputs.spark, rows)
    return serving.with_params(build(inputs, with_batch=False).recalled(), params)


@query(
    "serving_join_features",
    sql(
        "joined",
        """SELECT userId, movieId, CAST(bup AS DOUBLE) AS b_user_pos, CAST(bun AS DOUBLE) AS b_user_neg,
  CAST(bmp AS DOUBLE) AS b_movie_pos, CAST(bmn AS DOUBLE) AS b_movie_neg,
  CAST(sup AS DOUBLE) AS s_user_pos, CAST(sun AS DOUBLE) AS s_user_neg,
  CAST(smp AS DOUBLE) AS s_movie_pos, CAST(smn AS DOUBLE) AS s_movie_neg FROM joined""",
    ),
)
def join_features(inputs: Inputs) -> DataFrame:
    return build(inputs).joined().select(
        "userId", "movieId", *serving.USER_FEATURES, *serving.MOVIE_FEATURES
    )


@query(
    "user_movie_affinity",
    sql(
        "affinity",
        """SELECT userId, movieId, round(b_aff, 6) AS batch_affinity,
  round(s_aff, 6) AS streaming_affinity FROM affinity""",
    ),
)
def user_movie_affinity(inputs: Inputs) -> DataFrame:
    return build(inputs).joined().select(
        "userId",
        "movieId",
        F.round(serving.batch_affinity(), 6).alias("batch_affinity"),
        F.round(serving.streaming_affinity(), 6).alias("streaming_affinity"),
    )


def _vector_sql(view: str) -> str:
    columns = ", ".join(f"round(CAST({f} AS DOUBLE), 6) AS {f}" for f in FEATURE_COLUMNS)
    return sql(view, f"SELECT userId, movieId, {columns} FROM {view}")


@query("serving_feature_vector", _vector_sql("vectors"))
def vector(inputs: Inputs) -> DataFrame:
    return build(inputs).vectors().select("userId", "movieId", *map(rounded, FEATURE_COLUMNS))


@query("serving_feature_vector_as_written", _vector_sql("vectors_as_written"))
def vector_as_written(inputs: Inputs) -> DataFrame:
    vectors = build(inputs).vectors(as_written=True)
    return vectors.select("userId", "movieId", *map(rounded, FEATURE_COLUMNS))


def _score_sql(view: str) -> str:
    products = " + ".join(f"{f} * {c}" for f, c in zip(FEATURE_COLUMNS, COEFFICIENTS))
    x = f"CAST({products} AS DOUBLE) + {INTERCEPT}"
    return f"SELECT userId, movieId, 1 / (1 + exp(-({x}))) AS score FROM {view}"


def _ranked_sql(view: str) -> str:
    return f"""SELECT *, row_number() OVER (
  PARTITION BY userId ORDER BY round(score, 9) DESC, movieId) AS "rank"
FROM ({_score_sql(view)}) QUALIFY "rank" <= 10"""


@query(
    "score_candidates",
    sql(
        "vectors",
        f"SELECT userId, movieId, round(score, 6) AS score FROM ({_score_sql('vectors')})",
    ),
)
def scored(inputs: Inputs) -> DataFrame:
    return build(inputs).scored().select("userId", "movieId", rounded("score"))


@query(
    "ranked_top10",
    sql("vectors", f'SELECT userId, movieId, "rank" FROM ({_ranked_sql("vectors")})'),
)
def ranked(inputs: Inputs) -> DataFrame:
    return serving.rank(build(inputs).scored()).select("userId", "movieId", "rank")


def _recommend_sql(view: str, **instead: str) -> str:
    return sql(
        f"{view} movies",
        f"""SELECT userId, "rank", movieId, title, round(score, 6) AS score
FROM ({_ranked_sql(view)}) LEFT JOIN movies USING (movieId)""",
        **instead,
    )


@query("recommend_top10", _recommend_sql("vectors"))
def recommend_top10(inputs: Inputs) -> DataFrame:
    return build(inputs).recommended().withColumn("score", rounded("score"))


@query("recommend_top10_as_written", _recommend_sql("vectors_as_written"))
def recommend_as_written(inputs: Inputs) -> DataFrame:
    return build(inputs).recommended(as_written=True).withColumn("score", rounded("score"))


_REQUESTED_SQL = """
  SELECT userId, coalesce(genreId, 0) AS genreId
  FROM (SELECT DISTINCT CAST(o_custkey AS INT) AS userId FROM orders) LEFT JOIN
  (SELECT * FROM sr QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ratio DESC, genreId) = 1)
  USING (userId)"""


@query("recommend_for_users", _recommend_sql("vectors", fav=_REQUESTED_SQL))
def recommend_for_users(inputs: Inputs) -> DataFrame:
    """Every order asks for its customer: users come again and again, and most were never seen live."""
    built = build(inputs)
    tables = LiveTables(inputs.spark, new_path(inputs.spark, "serving"))
    scopes = {"batch": built.batch, "streaming": built.streaming}
    stored.store_features(tables, "features", 0, scopes)
    params = params_table(inputs.spark, [*enumerate(COEFFICIENTS), (INTERCEPT_IDX, INTERCEPT)])
    stored.publish_model(tables, "release", 1, params)
    requests = table(inputs.spark, inputs.sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("userId")
    )
    found = stored.recommend_for(tables, requests, built.movies, built.popular, built.hot)
    return found.withColumn("score", rounded("score"))
