"""Shapes of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import rows
from reelrank.operators.counts import features_single_pass, rating_counts
from reelrank.operators.genres import explode_genres, user_genre_ratio, with_mask
from reelrank.operators.upsert import latest_by_key
from reelrank.plans.feature_tables import cumulative_metrics
from reelrank.schemas import MOVIES, RATINGS
from reelrank.session import new_path, shared_dir
from reelrank.sources import driver_tables
from reelrank.sources.files import scan_keyed_ratings
from reelrank.sinks.tables import write_keyed_ratings
from reelrank.streaming import outputs

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [n for n in sorted(driver.queries()) if "stream_" not in n and "model" not in n],
)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert node not in plan


def test_small_dimension_is_broadcast(spark):
    plan = plan_of(driver.queries()["ratings_explode_genres"](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan


def test_large_dimension_is_not_broadcast(spark, ratings, movies):
    """Beyond the size bound the lookup sort-merges, with the same result."""
    frame = ratings([(i % 3, i % 5, 1) for i in range(50)])
    want = sorted(map(tuple, user_genre_ratio(frame, movies).collect()))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = user_genre_ratio(frame, movies)
        plan = plan_of(got)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_hot_movie_is_split_by_the_skew_join(spark):
    """A movie with most of the ratings, and a dimension too big to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    movie = F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id") % 50).cast("int")
    path = new_path(spark, "test-skew")
    spark.range(400_000).select(
        F.hash("id").cast("int").alias("userId"),
        movie.alias("movieId"),
        F.lit(1.0).cast("float").alias("rating"),
    ).write.parquet(path)
    frame = spark.read.parquet(path)
    movies = spark.createDataFrame([(i, str(i), [i % 19]) for i in range(50)], MOVIES)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        total = user_genre_ratio(frame, movies).agg(F.round(F.sum("ratio")))
        users = frame.select("userId").distinct().count()
        assert total.collect()[0][0] == users
        plan = total._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and re.search(r"skew(ed)?=true", plan)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_features_take_one_shuffle(spark):
    stream = driver_tables.ratings_stream(spark, SF_DIR)
    plan = plan_of(cumulative_metrics(stream, driver_tables.movies(spark, SF_DIR)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Expand") == 1


@pytest.mark.parametrize("ids", [5, 10_001])
def test_micro_batches_never_broadcast_all_movies(spark, ids):
    """the movie file is below the broadcast threshold, but not few rows. Few movies of a
    batch cut it first, for many both sides are shuffled; some come twice, some have no id."""
    path = new_path(spark, "test-movies")
    spark.range(30_000).selectExpr(
        "CAST(nullif(id % 20000, 7) AS INT) AS movieId",
        "CAST(id AS STRING) AS title",
        "array(CAST(id % 19 AS INT)) AS genres",
    ).write.parquet(path)
    movies = spark.read.schema(MOVIES).parquet(path)
    batch = spark.range(ids + 20).selectExpr(
        "CAST(id % 3 AS INT) AS userId",
        f"CAST(IF(id < {ids}, id, NULL) AS INT) AS movieId",
        "CAST(id % 2 AS FLOAT) AS rating",
        "DATE '2024-01-01' AS day",
    )
    per_movie = rating_counts(batch, "day", "movieId")
    columns = ["genreId", "day", "movieId", "cnt"]
    for got, want in (
        (
            outputs.day_counts(batch, movies),
            features_single_pass(with_mask(batch, movies), "day", genres=True),
        ),
        (
            outputs.genre_hot(movies)(batch).rows,
            explode_genres(per_movie, movies).select(*columns),
        ),
    ):
        plan = plan_of(got)
        if ids > 10_000:
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
        else:
            assert plan.count("LeftSemi") == 1 and plan.count("BroadcastExchange") == 2
        assert rows(got) == rows(want)


def test_keyed_upsert_prunes_before_the_shuffle(spark, ratings):
    plan = plan_of(latest_by_key(ratings([(1, 1, 1)]), ["key"], [F.desc("timestamp")]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_ranking_reuses_the_users_partitioning(spark):
    """After the feature aggregation users stay where they are: the only
    window, over userId, sits on no exchange of its own."""
    plan = plan_of(driver.queries()["recommend_top10"](spark, SF_DIR))
    users = [line for line in plan.splitlines() if "Exchange hashpartitioning(userId" in line]
    assert users == []


def test_recommend_beyond_the_broadcast_bound(spark):
    """With nothing small enough to broadcast by size, results stay the same and
    the ranking still runs on the partitioning of the user join."""
    query = driver.queries()["recommend_top10"]
    want = sorted(map(tuple, query(spark, SF_DIR).collect()))
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in settings}
    for k in settings:
        spark.conf.set(k, "-1")
    try:
        got = query(spark, SF_DIR)
        plan = plan_of(got)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        ranking = plan[plan.index("Window") : plan.index("SortMergeJoin")]
        assert "Exchange hashpartitioning" not in ranking.split("Generate")[0]
        assert sorted(map(tuple, got.collect())) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_is_combined_before_the_shuffle(spark, movies):
    """One user with a third of all rows reaches the reducers as one row per
    map task, and the totals are whole."""
    user = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int")
    frame = spark.range(0, 90_000, 1, 6).select(
        user.alias("userId"),
        (F.col("id") % 4 + 1).cast("int").alias("movieId"),
        F.lit(1.0).cast("float").alias("rating"),
    )
    result = cumulative_metrics(frame, movies)
    hot = result.where("entity = 'user' AND id = 1").first()
    assert hot["cnt"] == hot["pos_cnt"] == 30_001
    assert plan_of(result).count("HashAggregate") == 2


def test_scan_reads_only_what_is_used(spark, ratings):
    path = new_path(spark, "test-scan")
    write_keyed_ratings(ratings([(1, 1, 1)]), path)
    plan = plan_of(scan_keyed_ratings(spark, path).groupBy("movieId").count())
    assert "ReadSchema: struct<movieId:string>" in plan


def test_each_message_is_parsed_once(spark):
    """Filters on decoded fields must not repeat the JSON parsing below them."""
    plan = plan_of(driver.queries()["read_envelope_string_body"](spark, SF_DIR))
    assert plan.count("from_json") == 2


def test_filters_reach_the_scan(spark):
    late = driver_tables.ratings_stream(spark, SF_DIR).where("seq > 500")
    assert "GreaterThan(event_id,500)" in plan_of(late)


def test_shared_dir_is_one_folder_per_session(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert new_path(spark, "a") != new_path(spark, "a")
    assert spark.createDataFrame([], RATINGS).count() == 0
