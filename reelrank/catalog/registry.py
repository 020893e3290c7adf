"""Query registry, inputs and shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.sources import driver_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The last day of the earlier part of the live ratings, where a query needs
# an old and a new state.
CUTOFF = "2024-01-15"

# Model parameters used wherever scores are compared.
COEFFICIENTS = [0.02, -0.02, 0.01, -0.01, 0.3, 0.1, -0.1, 0.05, -0.05, 0.4]
INTERCEPT = -0.25


class Inputs:
    """Driver tables of one scale factor as engine inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def movies(self) -> DataFrame:
        return driver_tables.movies(self.spark, self.sf_dir)

    def stream(self) -> DataFrame:
        return driver_tables.ratings_stream(self.spark, self.sf_dir)

    def off_domain(self) -> DataFrame:
        return driver_tables.ratings_off_domain(self.spark, self.sf_dir)

    def raw(self) -> DataFrame:
        return driver_tables.ratings_raw(self.spark, self.sf_dir)

    def history(self) -> DataFrame:
        return driver_tables.ratings_history(self.spark, self.sf_dir)

    def early(self) -> DataFrame:
        day = F.coalesce("batch_day", F.lit(CUTOFF).cast("date"))
        return self.stream().where(day <= F.lit(CUTOFF).cast("date"))

    def late(self) -> DataFrame:
        return self.stream().where(F.col("batch_day") > F.lit(CUTOFF).cast("date"))


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under ``name`` with its checking SQL."""

    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name).cast("double"), digits).alias(name)


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


VIEWS = {
    "movies": """
  SELECT CAST(p_partkey AS INT) AS movieId, p_name AS title,
         CASE WHEN p_partkey % 17 = 0 THEN CAST([] AS INT[])
              WHEN g1 = g2 THEN [g1] ELSE list_sort([g1, g2]) END AS genres
  FROM (SELECT *, CAST(substr(p_brand, 7) AS INT) % 19 AS g1, p_size % 19 AS g2 FROM part)""",
    "movie_genres": "SELECT movieId, genreId FROM movies, UNNEST(genres) t(genreId)",
    "stream": """
  SELECT CAST(event_id AS VARCHAR) AS "key", CAST(user_id AS INT) AS userId,
         CAST(json_extract_string(props, '$.k') AS INT) AS movieId,
         CASE WHEN event_type IN ('click','purchase') THEN 1.0 ELSE 0.0 END AS rating,
         CAST(ts AS VARCHAR) AS "timestamp", ts, event_id AS seq, CAST(ts AS DATE) AS batch_day
  FROM events""",
    "off_domain": """
  SELECT CAST(user_id AS INT) AS userId, CAST(json_extract_string(props, '$.k') AS INT) AS movieId,
         CASE WHEN event_type IN ('click','purchase') THEN 1.0 WHEN event_type = 'signup' THEN 0.5
              WHEN event_type = 'error' THEN 1.5 ELSE 0.0 END AS rating
  FROM events""",
    "raw": """
  SELECT concat(l_orderkey, '-', l_linenumber) AS "key", CAST(o_custkey AS INT) AS userId,
         CAST(l_partkey AS INT) AS movieId,
         CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE 1.0 END AS rating, l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "history": """
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY ts DESC, movieId DESC, rating DESC) = 1""",
    # Batch scope features.
    "bu": """
  SELECT userId, count(*) FILTER (rating = 1) AS pos, count(*) FILTER (rating = 0) AS neg
  FROM history GROUP BY userId""",
    "bm": """
  SELECT movieId, count(*) FILTER (rating = 1) AS pos, count(*) FILTER (rating = 0) AS neg
  FROM history GROUP BY movieId""",
    "br": """
  SELECT userId, genreId, CAST(count(*) AS DOUBLE) / any_value(pos) AS ratio
  FROM history JOIN movie_genres USING (movieId) JOIN bu USING (userId)
  WHERE rating = 1 GROUP BY userId, genreId""",
    # Streaming scope: per metric, the last day that has it.
    "su_day": """
  SELECT userId, batch_day, count(*) FILTER (rating = 1) AS pos, count(*) FILTER (rating = 0) AS neg
  FROM stream GROUP BY userId, batch_day""",
    "su": """
  SELECT userId, max_by(pos, batch_day) FILTER (pos > 0) AS pos,
         max_by(neg, batch_day) FILTER (neg > 0) AS neg FROM su_day GROUP BY userId""",
    "sm": """
  SELECT movieId, max_by(pos, batch_day) FILTER (pos > 0) AS pos,
         max_by(neg, batch_day) FILTER (neg > 0) AS neg
  FROM (SELECT movieId, batch_day, count(*) FILTER (rating = 1) AS pos,
               count(*) FILTER (rating = 0) AS neg FROM stream GROUP BY movieId, batch_day)
  GROUP BY movieId""",
    "sr": """
  SELECT userId, genreId, CAST(n AS DOUBLE) / pos AS ratio
  FROM (SELECT userId, genreId, batch_day, count(*) AS n
        FROM stream JOIN movie_genres USING (movieId) WHERE rating = 1
        GROUP BY userId, genreId, batch_day)
  JOIN su_day USING (userId, batch_day)
  QUALIFY row_number() OVER (PARTITION BY userId, genreId ORDER BY batch_day DESC) = 1""",
    # Lists.
    "day_movie": "SELECT batch_day, movieId, count(*) AS cnt FROM stream GROUP BY batch_day, movieId",
    "day_top": """
  SELECT *, row_number() OVER (PARTITION BY batch_day ORDER BY cnt DESC, movieId) AS pos
  FROM day_movie QUALIFY pos <= 10""",
    "popular": """
  SELECT row_number() OVER (ORDER BY batch_day, pos) - 1 AS pos, movieId
  FROM (SELECT * FROM day_top ORDER BY batch_day DESC, pos DESC LIMIT 30)""",
    "hot": """
  SELECT genreId, movieId, batch_day, cnt,
         row_number() OVER (PARTITION BY genreId ORDER BY cnt DESC, movieId) AS pos
  FROM day_movie JOIN movie_genres USING (movieId)
  JOIN (SELECT genreId, max(batch_day) AS batch_day
        FROM day_movie JOIN movie_genres USING (movieId) GROUP BY genreId)
  USING (genreId, batch_day) QUALIFY pos <= 10""",
    "fav": """
  SELECT userId, coalesce(genreId, 0) AS genreId FROM su LEFT JOIN
  (SELECT * FROM sr QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ratio DESC, genreId) = 1)
  USING (userId)""",
    "recalled": """
  SELECT userId, movieId FROM fav, popular
  UNION SELECT userId, movieId FROM fav JOIN hot USING (genreId)""",
    "affinity": """
  SELECT userId, movieId, coalesce(sum(br.ratio), 0) AS b_aff, coalesce(sum(sr.ratio), 0) AS s_aff
  FROM recalled LEFT JOIN movie_genres USING (movieId)
  LEFT JOIN br USING (userId, genreId) LEFT JOIN sr USING (userId, genreId)
  GROUP BY userId, movieId""",
    "joined": """
  SELECT userId, movieId, b_aff, s_aff,
         coalesce(bu.pos, 0) AS bup, coalesce(bu.neg, 0) AS bun,
         coalesce(bm.pos, 0) AS bmp, coalesce(bm.neg, 0) AS bmn,
         coalesce(su.pos, 0) AS sup, coalesce(su.neg, 0) AS sun,
         coalesce(sm.pos, 0) AS smp, coalesce(sm.neg, 0) AS smn
  FROM affinity LEFT JOIN bu USING (userId) LEFT JOIN bm USING (movieId)
  LEFT JOIN su USING (userId) LEFT JOIN sm USING (movieId)""",
    "vectors": """
  SELECT userId, movieId, bup AS f0, bun AS f1, bmp AS f2, bmn AS f3, b_aff AS f4,
         sup AS f5, sun AS f6, smp AS f7, smn AS f8, s_aff AS f9 FROM joined""",
    "vectors_as_written": """
  SELECT userId, movieId, bup AS f0, bun AS f1, bmp AS f2, bmn AS f3, b_aff AS f4,
         sup AS f5, sup AS f6, smp AS f7, smn AS f8, b_aff AS f9 FROM joined""",
    # Training.
    "buffer": """
  SELECT row_number() OVER (ORDER BY ts, seq) - 1 AS i, *
  FROM (SELECT * FROM stream ORDER BY ts DESC, seq DESC LIMIT 200)""",
    "buf": """
  SELECT b.i, b.userId, b.movieId, b.rating, (SELECT count(*) FROM buffer) // 2 AS h,
         CASE WHEN trunc(rating) = 1 THEN 1 ELSE 0 END AS p,
         CASE WHEN trunc(rating) = 1 THEN coalesce(len(genres), 0) ELSE 0 END AS hits
  FROM buffer b LEFT JOIN movies USING (movieId)""",
}

# A view and the views it reads, in order.
NEEDS = {
    "movie_genres": ["movies"],
    "history": ["raw"],
    "bu": ["history"],
    "bm": ["history"],
    "br": ["history", "movie_genres", "bu"],
    "su_day": ["stream"],
    "su": ["su_day"],
    "sm": ["stream"],
    "sr": ["stream", "movie_genres", "su_day"],
    "day_movie": ["stream"],
    "day_top": ["day_movie"],
    "popular": ["day_top"],
    "hot": ["day_movie", "movie_genres"],
    "fav": ["su", "sr"],
    "recalled": ["fav", "popular", "hot"],
    "affinity": ["recalled", "movie_genres", "br", "sr"],
    "joined": ["affinity", "bu", "bm", "su", "sm"],
    "vectors": ["joined"],
    "vectors_as_written": ["joined"],
    "buffer": ["stream"],
    "buf": ["buffer", "movies"],
}


def sql(views: str, body: str, **instead: str) -> str:
    """``body`` below the named views and all views they need, some with another text."""
    order: list[str] = []

    def add(view: str) -> None:
        for needed in NEEDS.get(view, []):
            add(needed)
        if view not in order:
            order.append(view)

    for view in views.split():
        add(view)
    heads = ",\n".join(f"{v} AS ({instead.get(v, VIEWS[v])})" for v in order)
    return f"WITH {heads}\n{body}"
