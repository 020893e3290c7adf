"""Recommendations for all users in one plan.

The popular list (30 entries) and the 19 hot lists (10 entries each) are bounded
by construction, so at most 220 distinct movies are ever scored. The plan
therefore keeps users where they are: their candidates are unfolded from
arrays, movie features arrive by broadcast, and ranking works per user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.genres import genre_mask, masked_sum
from reelrank.functions.scoring import linear_score, logistic
from reelrank.operators.lookup import IdSet, bounded_lookup, default_zero
from reelrank.operators.topk import top_per_group
from reelrank.plans.feature_tables import FeatureTables
from reelrank.schemas import FEATURE_COLUMNS, GENRE_FLAGS, INTERCEPT_IDX, TOP_K

USER_FEATURES = ["b_user_pos", "b_user_neg", "s_user_pos", "s_user_neg"]
MOVIE_FEATURES = ["b_movie_pos", "b_movie_neg", "s_movie_pos", "s_movie_neg"]
BATCH_RATIOS = [f"b_{g}" for g in GENRE_FLAGS]
STREAM_RATIOS = [f"s_{g}" for g in GENRE_FLAGS]


def _prefixed(table: DataFrame, key: str, prefix: str, entity: str) -> DataFrame:
    names = {"pos_cnt": f"{prefix}_{entity}_pos", "neg_cnt": f"{prefix}_{entity}_neg"}
    return table.selectExpr(
        key, *(f"{c} AS {names.get(c, f'{prefix}_{c}')}" for c in table.columns if c != key)
    )


def user_profiles(
    batch: FeatureTables, streaming: FeatureTables, users: DataFrame | None = None
) -> DataFrame:
    """One row per requested user: counts and genre ratios of both scopes and
    the favorite genre. All sides are unique per user, so no key is hot.

    Without ``users`` everyone with streaming features is served.
    """
    live = _prefixed(streaming.users, "userId", "s", "user")
    if users is not None:
        live = users.select("userId").join(live, "userId", "left")
    joined = live.join(_prefixed(batch.users, "userId", "b", "user"), "userId", "left")
    return default_zero(joined, *USER_FEATURES).withColumn(
        "genreId", favorite_of(STREAM_RATIOS)
    )


def favorite_of(ratios: Sequence[str]) -> Column:
    """Position of the highest ratio; ties and no ratio go to the lowest."""
    values = F.array(*ratios)
    position = F.array_position(values, F.array_max(values)).cast("int")
    return F.coalesce(position - 1, F.lit(0))


def list_in_order(entries: DataFrame, *keys: str) -> DataFrame:
    """Bounded list rows -> one array of movie ids per key, in ``pos`` order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "movieId")))
    return entries.groupBy(*keys).agg(F.transform(ordered, lambda e: e["movieId"]).alias("list"))


def favorite_candidates(favorites: DataFrame, hot: DataFrame) -> DataFrame:
    """(userId, genreId) with the movies of that genre's hot list."""
    lists = list_in_order(hot, "genreId")
    return favorites.join(F.broadcast(lists), "genreId").select(
        "userId", "genreId", F.posexplode("list").alias("pos", "movieId")
    )


def recall(users: DataFrame, popular: DataFrame, hot: DataFrame) -> DataFrame:
    """Popular list and favorite genre's list per user, without repeats.

    ``users`` carries ``genreId``. The popular list is one array value and the
    hot lists are at most 19 rows, so the users are not shuffled and the
    de-duplication is a per-row array union.
    """
    nothing = F.array().cast("array<int>")
    hot_lists = list_in_order(hot, "genreId").withColumnRenamed("list", "hot_list")
    popular_list = F.coalesce(list_in_order(popular).select("list").scalar(), nothing)
    candidates = F.array_union(popular_list, F.coalesce("hot_list", nothing))
    rest = [c for c in users.columns if c != "genreId"]
    return users.join(F.broadcast(hot_lists), "genreId", "left").select(
        *rest, F.explode(candidates).alias("movieId")
    )


def candidate_movies(
    popular: DataFrame,
    hot: DataFrame,
    movies: DataFrame,
    batch: FeatureTables,
    streaming: FeatureTables,
) -> DataFrame:
    """The at most 220 movies that can be recommended, with all they need."""
    ids = IdSet.of(popular.select("movieId").union(hot.select("movieId")), "movieId")
    dim = movies.select("movieId", "title", genre_mask(F.col("genres")).alias("mask"))
    rows = bounded_lookup(ids.frame, dim, ids)
    for prefix, table in (("b", batch.movies), ("s", streaming.movies)):
        rows = bounded_lookup(rows, _prefixed(table, "movieId", prefix, "movie"), ids)
    pool = default_zero(rows, *MOVIE_FEATURES).withColumn("mask", F.coalesce("mask", F.lit(0)))
    return ids.hint(pool)


def join_candidates(recalled: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates with the features of their movie."""
    return recalled.join(pool, "movieId", "left")


def batch_affinity() -> Column:
    """Sum over the movie's genres of the user's batch ratio."""
    return masked_sum(BATCH_RATIOS)


def streaming_affinity() -> Column:
    return masked_sum(STREAM_RATIOS)


def feature_vector(joined: DataFrame, *keep: str, as_written: bool = False) -> DataFrame:
    """``f0..f9`` per (user, candidate).

    ``as_written`` repeats the user's positive count in place of the negative
    one and reads the batch ratios for both affinities.
    """
    values = [
        F.col("b_user_pos"),
        F.col("b_user_neg"),
        F.col("b_movie_pos"),
        F.col("b_movie_neg"),
        batch_affinity(),
        F.col("s_user_pos"),
        F.col("s_user_pos" if as_written else "s_user_neg"),
        F.col("s_movie_pos"),
        F.col("s_movie_neg"),
        batch_affinity() if as_written else streaming_affinity(),
    ]
    return joined.select(
        "userId",
        "movieId",
        *keep,
        *(v.alias(f) for v, f in zip(values, FEATURE_COLUMNS, strict=True)),
    )


def param_columns(params: DataFrame) -> tuple[list[Column], Column]:
    """Model parameter table -> coefficient columns and intercept, as scalars."""
    entries = F.map_from_entries(F.collect_list(F.struct("idx", "coefficient")))
    wanted = F.array_sort(F.collect_list("idx")) == F.array(
        *[F.lit(i) for i in range(INTERCEPT_IDX, len(FEATURE_COLUMNS))]
    )
    message = F.lit("model parameters need each idx from -1 to 9 once")
    checked = F.when(wanted, entries).otherwise(F.raise_error(message))
    by_idx = params.agg(checked.alias("params")).scalar()
    weights = [F.element_at(by_idx, F.lit(i)) for i in range(len(FEATURE_COLUMNS))]
    return weights, F.element_at(by_idx, F.lit(INTERCEPT_IDX))


def with_params(candidates: DataFrame, params: DataFrame) -> DataFrame:
    """Every candidate with the one set of model parameters, ``c0..c9`` and
    ``intercept``; the parameters are scalar values, not a join side."""
    weights, intercept = param_columns(params)
    named = {f"c{i}": w for i, w in enumerate(weights)}
    return candidates.withColumns({**named, "intercept": intercept})


def score(
    vectors: DataFrame, coefficients: Sequence[Column | float], intercept: Column | float
) -> DataFrame:
    features = [F.col(f) for f in FEATURE_COLUMNS]
    return vectors.withColumn(
        "score", logistic(linear_score(features, coefficients, intercept))
    )


def rank(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best ``k`` per user. Scores are compared at nine digits, then by movie
    id, so float noise cannot reorder equal candidates."""
    order = [F.desc(F.round("score", 9)), F.asc("movieId")]
    return top_per_group(scored, ["userId"], order, k, pos="rank")


def with_titles(ranked: DataFrame, movies: DataFrame) -> DataFrame:
    return ranked.join(movies.select("movieId", "title"), "movieId", "left")


def recommend(
    popular: DataFrame,
    hot: DataFrame,
    movies: DataFrame,
    batch: FeatureTables,
    streaming: FeatureTables,
    coefficients: Sequence[Column | float],
    intercept: Column | float,
    users: DataFrame | None = None,
    k: int = TOP_K,
    as_written: bool = False,
) -> DataFrame:
    """Recall, featurise, score and rank for every user; titles included."""
    recalled = recall(user_profiles(batch, streaming, users), popular, hot)
    pool = candidate_movies(popular, hot, movies, batch, streaming)
    vectors = feature_vector(join_candidates(recalled, pool), "title", as_written=as_written)
    ranked = rank(score(vectors, coefficients, intercept), k)
    return ranked.select("userId", "rank", "movieId", "title", "score")
