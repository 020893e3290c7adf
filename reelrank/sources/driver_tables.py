"""The star-schema test tables read as movies, live ratings and history.

Timestamps stay zone-free (TIMESTAMP_NTZ, or text), so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators.upsert import latest_by_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as movies with one or two genres; every 17th has none."""
    g1 = F.substring("p_brand", 7, 10).cast("int") % 19
    g2 = F.col("p_size") % 19
    genres = (
        F.when(F.col("p_partkey") % 17 == 0, F.array().cast("array<int>"))
        .when(g1 == g2, F.array(g1))
        .otherwise(F.array(F.least(g1, g2), F.greatest(g1, g2)))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        genres.alias("genres"),
    )


def ratings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as live ratings; ``(ts, seq)`` is the arrival order."""
    positive = F.col("event_type").isin("click", "purchase")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("movieId"),
        F.when(positive, 1.0).otherwise(0.0).cast("float").alias("rating"),
        F.col("ts").cast("string").alias("timestamp"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("date").alias("batch_day"),
    )


def ratings_off_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live ratings with values outside {0, 1}, for the polarity rules."""
    rating = (
        F.when(F.col("event_type").isin("click", "purchase"), 1.0)
        .when(F.col("event_type") == "signup", 0.5)
        .when(F.col("event_type") == "error", 1.5)
        .otherwise(0.0)
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("movieId"),
        rating.cast("float").alias("rating"),
    )


def _line_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("int").alias("movieId"),
        F.when(F.col("l_returnflag") == "R", 0.0).otherwise(1.0).cast("float").alias("rating"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
    )


def _order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("int").alias("userId")
    )


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
        "userId",
        "movieId",
        "rating",
        "ts",
    )


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ratings; keys repeat."""
    return _keyed(
        _line_ratings(spark, sf_dir).join(_order_users(spark, sf_dir), "l_orderkey")
    )


def ratings_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines after the keyed upsert.

    The key is (order, line), so the ranking finds its rows where the join by
    order has put them, and the history is shuffled once.
    """
    lines = _line_ratings(spark, sf_dir).join(_order_users(spark, sf_dir), "l_orderkey")
    latest = latest_by_key(
        lines,
        ["l_orderkey", "l_linenumber"],
        [F.desc("ts"), F.desc("movieId"), F.desc("rating")],
    )
    return _keyed(latest)
