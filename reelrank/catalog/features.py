"""Counts, ratios and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.catalog.registry import CUTOFF, Inputs, query, rounded, sql, text
from reelrank.operators.counts import (
    features_single_pass,
    negative_counts,
    polarity_counts,
    positive_counts,
    rating_counts,
)
from reelrank.operators.genres import (
    explode_genres,
    genre_movie_counts,
    genre_names,
    genre_record_counts,
    genres_dim,
    user_affinity_total,
    user_genre_ratio,
    user_genre_share,
)
from reelrank.plans.feature_tables import (
    batch_feature_tables,
    cumulative_metrics,
    last_batch_metrics,
    metrics_long,
    microbatch_metrics,
)
from reelrank.plans.stored import metrics_change
from reelrank.schemas import GENRE_NAMES
from reelrank.session import new_path
from reelrank.sources.driver_tables import table
from reelrank.sources.features import read_default_zero
from reelrank.streaming.live import LiveTables

GENRE_VALUES = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(GENRE_NAMES)) + ")"


@query(
    "user_positive_counts",
    sql(
        "history",
        "SELECT userId, count(*) AS pos_cnt FROM history WHERE rating = 1 GROUP BY userId",
    ),
)
def user_positive_counts(inputs: Inputs) -> DataFrame:
    return positive_counts(inputs.history(), "userId")


@query(
    "user_negative_counts",
    sql(
        "history",
        "SELECT userId, count(*) AS neg_cnt FROM history WHERE rating = 0 GROUP BY userId",
    ),
)
def user_negative_counts(inputs: Inputs) -> DataFrame:
    return negative_counts(inputs.history(), "userId")


@query(
    "movie_positive_counts",
    sql(
        "history",
        "SELECT movieId, count(*) AS pos_cnt FROM history WHERE rating = 1 GROUP BY movieId",
    ),
)
def movie_positive_counts(inputs: Inputs) -> DataFrame:
    return positive_counts(inputs.history(), "movieId")


@query(
    "movie_negative_counts",
    sql(
        "history",
        "SELECT movieId, count(*) AS neg_cnt FROM history WHERE rating = 0 GROUP BY movieId",
    ),
)
def movie_negative_counts(inputs: Inputs) -> DataFrame:
    return negative_counts(inputs.history(), "movieId")


def _polarity_sql(view: str, key: str, pos: str, neg: str) -> str:
    return sql(
        view,
        f"""SELECT {key}, nullif(count(*) FILTER ({pos}), 0) AS pos_cnt,
  nullif(count(*) FILTER ({neg}), 0) AS neg_cnt
FROM {view} GROUP BY {key} HAVING count(*) FILTER ({pos} OR {neg}) > 0""",
    )


@query("polarity_exact", _polarity_sql("off_domain", "userId", "rating = 1", "rating = 0"))
def polarity_exact(inputs: Inputs) -> DataFrame:
    return polarity_counts(inputs.off_domain(), "userId", rule="exact")


@query("polarity_else", _polarity_sql("off_domain", "userId", "rating = 1", "rating <> 1"))
def polarity_else(inputs: Inputs) -> DataFrame:
    return polarity_counts(inputs.off_domain(), "userId", rule="else")


@query(
    "polarity_truncating",
    _polarity_sql("off_domain", "userId", "trunc(rating) = 1", "trunc(rating) <> 1"),
)
def polarity_truncating(inputs: Inputs) -> DataFrame:
    return polarity_counts(inputs.off_domain(), "userId", rule="truncating")


@query("user_counts_else", _polarity_sql("history", "userId", "rating = 1", "rating <> 1"))
def user_counts_else(inputs: Inputs) -> DataFrame:
    return polarity_counts(inputs.history(), "userId", rule="else")


@query("movie_counts_else", _polarity_sql("history", "movieId", "rating = 1", "rating <> 1"))
def movie_counts_else(inputs: Inputs) -> DataFrame:
    return polarity_counts(inputs.history(), "movieId", rule="else")


@query(
    "movie_rating_counts",
    sql("stream", "SELECT movieId, count(*) AS cnt FROM stream GROUP BY movieId"),
)
def movie_rating_counts(inputs: Inputs) -> DataFrame:
    return rating_counts(inputs.stream(), "movieId")


@query(
    "ratings_explode_genres",
    sql(
        "history movie_genres",
        """SELECT "key", userId, movieId, rating, genreId
FROM history JOIN movie_genres USING (movieId)""",
    ),
)
def ratings_explode_genres(inputs: Inputs) -> DataFrame:
    ratings = inputs.history().select("key", "userId", "movieId", F.col("rating").cast("double"))
    return explode_genres(ratings, inputs.movies())


@query(
    "user_genre_ratio",
    sql("br", "SELECT userId, genreId, round(ratio, 6) AS ratio FROM br"),
)
def ratio(inputs: Inputs) -> DataFrame:
    return user_genre_ratio(inputs.history(), inputs.movies()).select(
        "userId", "genreId", rounded("ratio")
    )


@query(
    "user_genre_share",
    sql(
        "history movie_genres",
        """SELECT userId, genreId,
  round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY userId), 6) AS ratio
FROM (SELECT userId, genreId, count(*) AS n FROM history JOIN movie_genres USING (movieId)
      GROUP BY userId, genreId)""",
    ),
)
def share(inputs: Inputs) -> DataFrame:
    return user_genre_share(inputs.history(), inputs.movies()).select(
        "userId", "genreId", rounded("ratio")
    )


@query(
    "genre_movie_counts",
    sql(
        "stream movie_genres",
        """SELECT genreId, movieId, count(*) AS cnt FROM stream JOIN movie_genres USING (movieId)
GROUP BY genreId, movieId""",
    ),
)
def genre_movies(inputs: Inputs) -> DataFrame:
    return genre_movie_counts(inputs.stream(), inputs.movies())


def _names_sql(view: str, counts: str) -> str:
    return sql(
        view,
        f"""SELECT g.genreId, g.name, coalesce(c.cnt, 0) AS cnt
FROM {GENRE_VALUES} AS g(genreId, name) LEFT JOIN ({counts}) AS c USING (genreId)""",
    )


@query(
    "genre_record_counts",
    _names_sql(
        "history movie_genres",
        """SELECT genreId, count(*) AS cnt FROM history JOIN movie_genres USING (movieId)
GROUP BY genreId""",
    ),
)
def genre_records(inputs: Inputs) -> DataFrame:
    return genre_record_counts(inputs.history(), inputs.movies())


@query(
    "genre_names_left",
    _names_sql(
        "stream movie_genres",
        """SELECT genreId, count(*) AS cnt FROM stream JOIN movie_genres USING (movieId)
WHERE rating = 1 GROUP BY genreId""",
    ),
)
def genre_names_left(inputs: Inputs) -> DataFrame:
    positive = inputs.stream().where("rating = 1")
    counts = genre_movie_counts(positive, inputs.movies()).groupBy("genreId").agg(
        F.sum("cnt").alias("cnt")
    )
    return genre_names(counts, genres_dim(inputs.spark))


@query(
    "genres_dim",
    _names_sql("movie_genres", "SELECT genreId, count(*) AS cnt FROM movie_genres GROUP BY genreId"),
)
def genres(inputs: Inputs) -> DataFrame:
    """The fixed genre dimension with the number of movies of each genre."""
    links = inputs.movies().select(F.explode("genres").alias("genreId"))
    return genre_names(rating_counts(links, "genreId"), genres_dim(inputs.spark))


@query(
    "user_affinity_total",
    sql("br", "SELECT userId, round(sum(ratio), 6) AS affinity FROM br GROUP BY userId"),
)
def affinity_total(inputs: Inputs) -> DataFrame:
    ratios = user_genre_ratio(inputs.history(), inputs.movies())
    return user_affinity_total(ratios).select("userId", rounded("affinity"))


@query(
    "rating_features_single_pass",
    sql(
        "history stream",
        """SELECT * FROM (
  SELECT scope, 'user' AS entity, userId AS id, nullif(count(*) FILTER (rating = 1), 0) AS pos_cnt,
         nullif(count(*) FILTER (rating = 0), 0) AS neg_cnt
  FROM (SELECT 'batch' AS scope, userId, rating FROM history
        UNION ALL SELECT 'streaming', userId, rating FROM stream) GROUP BY scope, userId
  UNION ALL
  SELECT scope, 'movie', movieId, nullif(count(*) FILTER (rating = 1), 0),
         nullif(count(*) FILTER (rating = 0), 0)
  FROM (SELECT 'batch' AS scope, movieId, rating FROM history
        UNION ALL SELECT 'streaming', movieId, rating FROM stream) GROUP BY scope, movieId)""",
    ),
)
def single_pass(inputs: Inputs) -> DataFrame:
    columns = ["userId", "movieId", "rating"]
    ratings = (
        inputs.history()
        .select(*columns, F.lit("batch").alias("scope"))
        .unionByName(inputs.stream().select(*columns, F.lit("streaming").alias("scope")))
    )
    return features_single_pass(ratings, "scope").drop("cnt")


@query(
    "read_features_default_zero",
    sql(
        "bu",
        """SELECT CAST(c_custkey AS INT) AS userId, CAST(coalesce(pos, 0) AS DOUBLE) AS pos_cnt,
  CAST(coalesce(neg, 0) AS DOUBLE) AS neg_cnt
FROM customer LEFT JOIN bu ON c_custkey = userId""",
    ),
)
def default_zero_reads(inputs: Inputs) -> DataFrame:
    users = table(inputs.spark, inputs.sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("userId")
    )
    return read_default_zero(users, polarity_counts(inputs.history(), "userId"), "userId")


def _upsert_sql(old: str, new: str) -> str:
    return f"""SELECT userId, nullif(coalesce(n.pos, o.pos), 0) AS pos_cnt,
  nullif(coalesce(n.neg, o.neg), 0) AS neg_cnt
FROM ({old}) o FULL JOIN ({new}) n USING (userId)"""


def _counts_sql(source: str, neg: str = "rating = 0") -> str:
    return f"""SELECT userId, nullif(count(*) FILTER (rating = 1), 0) AS pos,
  nullif(count(*) FILTER ({neg}), 0) AS neg FROM {source} GROUP BY userId"""


@query(
    "upsert_feature_metrics",
    sql(
        "stream",
        _upsert_sql(
            _counts_sql("stream WHERE batch_day <= DATE '2024-01-15'"),
            _counts_sql("stream WHERE batch_day > DATE '2024-01-15'"),
        ),
    ),
)
def upsert_features(inputs: Inputs) -> DataFrame:
    """Stored counts by user; each metric that comes again replaces the old one."""
    early, late = (polarity_counts(part, "userId") for part in (inputs.early(), inputs.late()))
    return _upserted(inputs, early, late)


def _upserted(inputs: Inputs, *versions: DataFrame) -> DataFrame:
    tables = LiveTables(inputs.spark, new_path(inputs.spark, "features"))
    for version, counts in enumerate(versions):
        tables.commit("counts", version, {"users": metrics_change(counts, "userId")})
    return tables.read("users")


@query(
    "replace_feature_metrics",
    sql(
        "history off_domain",
        _upsert_sql(_counts_sql("history"), _counts_sql("off_domain", "rating <> 1")),
    ),
)
def replace_features(inputs: Inputs) -> DataFrame:
    """Loader counts replace the stored batch counts they share a key with."""
    stored = polarity_counts(inputs.history(), "userId")
    return _upserted(inputs, stored, polarity_counts(inputs.off_domain(), "userId", rule="else"))


@query(
    "feature_kv",
    sql(
        "bu bm br",
        """SELECT concat('batch2feature_userId_rating1_', userId) AS "key",
  CAST(pos AS DOUBLE) AS value FROM bu WHERE pos > 0
UNION ALL SELECT concat('batch2feature_userId_rating0_', userId), neg FROM bu WHERE neg > 0
UNION ALL SELECT concat('batch2feature_movieId_rating1_', movieId), pos FROM bm WHERE pos > 0
UNION ALL SELECT concat('batch2feature_movieId_rating0_', movieId), neg FROM bm WHERE neg > 0
UNION ALL SELECT concat('batch2feature_userId_to_genresId_', userId, '_', genreId),
  round(ratio, 6) FROM br""",
    ),
)
def kv(inputs: Inputs) -> DataFrame:
    tables = batch_feature_tables(inputs.history(), inputs.movies())
    return tables.kv("batch").select("key", rounded("value"))


def long_metrics(source: str, batch: str) -> str:
    """SELECT of (batch, entity, id, metric, value) per batch of ``source``."""
    parts = []
    for entity, key in (("user", "userId"), ("movie", "movieId")):
        for metric, wanted in (("pos_cnt", 1), ("neg_cnt", 0)):
            parts.append(
                f"""SELECT {batch} AS batch, '{entity}' AS entity, {key} AS id,
  '{metric}' AS metric, CAST(count(*) AS DOUBLE) AS value
FROM {source} WHERE rating = {wanted} GROUP BY {batch}, {key}"""
            )
    parts.append(
        f"""SELECT a.batch, 'user', a.userId, concat('g', genreId), CAST(n AS DOUBLE) / total
FROM (SELECT {batch} AS batch, userId, genreId, count(*) AS n
      FROM {source} JOIN movie_genres USING (movieId) WHERE rating = 1
      GROUP BY {batch}, userId, genreId) a
JOIN (SELECT {batch} AS batch, userId, count(*) AS total FROM {source} WHERE rating = 1
      GROUP BY {batch}, userId) b ON a.batch = b.batch AND a.userId = b.userId"""
    )
    return "\nUNION ALL ".join(parts)


def latest_metrics_sql(source: str, batch: str) -> str:
    return f"""SELECT entity, id, metric, round(value, 6) AS value
FROM ({long_metrics(source, batch)})
QUALIFY row_number() OVER (PARTITION BY entity, id, metric ORDER BY batch DESC) = 1"""


LAST_BATCH_SQL = sql("stream movie_genres", latest_metrics_sql("stream", "batch_day"))
REPLAY_SQL = sql(
    "stream movie_genres",
    latest_metrics_sql("stream", "greatest(batch_day, DATE '2024-01-15')"),
)
CUMULATIVE_SQL = sql("stream movie_genres", latest_metrics_sql("stream", "1"))
HISTORY_METRICS_SQL = sql("history movie_genres", latest_metrics_sql("history", "1"))
PER_DAY_SQL = sql(
    "stream movie_genres",
    f"""SELECT CAST(batch AS VARCHAR) AS batch, entity, id, metric, round(value, 6) AS value
FROM ({long_metrics("stream", "batch_day")})""",
)


def long_rounded(metrics: DataFrame, *keys: str) -> DataFrame:
    return metrics_long(metrics, *keys).select(
        "entity", "id", "metric", rounded("value"), *(text(k) for k in keys)
    )


@query("streaming_features_last_batch", LAST_BATCH_SQL)
def last_batch(inputs: Inputs) -> DataFrame:
    """The batch twin of the stream job: a day stands for a micro-batch."""
    metrics = microbatch_metrics(inputs.stream(), inputs.movies(), "batch_day")
    return long_rounded(last_batch_metrics(metrics, "batch_day"))


@query("batch_features_replay_as_written", REPLAY_SQL)
def replay_as_written(inputs: Inputs) -> DataFrame:
    """Replay where the first batch is the backlog and later batches overwrite
    the features it left."""
    day = F.greatest("batch_day", F.lit("2024-01-15").cast("date"))
    ratings = inputs.stream().withColumn("batch", day)
    return long_rounded(
        last_batch_metrics(microbatch_metrics(ratings, inputs.movies(), "batch"), "batch")
    )


@query("batch_features_history", HISTORY_METRICS_SQL)
def history_features(inputs: Inputs) -> DataFrame:
    """Batch-scope features recomputed over the whole keyed history."""
    return long_rounded(cumulative_metrics(inputs.history(), inputs.movies()))
