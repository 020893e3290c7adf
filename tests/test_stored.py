"""Keyed tables, stored features and models, positions without a single task."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reelrank.operators.numbering import numbered
from reelrank.operators.topk import genre_first
from reelrank.operators.training_window import record_index
from reelrank.plans import stored
from reelrank.plans.feature_tables import batch_feature_tables
from reelrank.plans.training import fit_click_model, fitted_moments
from reelrank.schemas import FEATURE_COLUMNS
from reelrank.session import new_path
from reelrank.sinks.tables import model_params, params_table
from reelrank.streaming.live import LiveTables, Upsert, bucket_of


def plan_of(df):
    return df._jdf.queryExecution().toString()


def last_wins(old, new):
    return old.join(new, "key", "left_anti").unionByName(new)


def test_an_upsert_leaves_the_files_of_other_buckets_alone(spark):
    tables = LiveTables(spark, new_path(spark, "test-keyed"), keep=1)
    first = spark.range(200).selectExpr("id AS key", "id AS value")
    tables.commit("a", 0, {"t": Upsert(first, "key", last_wins, 16)})
    before = {f: open(f, "rb").read() for f in glob.glob(f"{tables.root}/data/t/*/*/*.parquet")}
    second = spark.createDataFrame([(3, -3), (500, 5)], "key long, value long")
    touched = {r["b"] for r in second.select(bucket_of("key", 16).alias("b")).collect()}
    tables.commit("a", 1, {"t": Upsert(second, "key", last_wins)})
    want = {**{k: k for k in range(200)}, 3: -3, 500: 5}
    assert {r["key"]: r["value"] for r in tables.read("t").collect()} == want
    after = set(glob.glob(f"{tables.root}/data/t/*/*/*.parquet"))
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept <= after and len(kept) == len({f for f in after if f in before})
    assert all(open(f, "rb").read() == before[f] for f in kept)


def test_reads_of_some_keys_open_their_buckets_only(spark):
    tables = LiveTables(spark, new_path(spark, "test-point"))
    many = spark.range(1000).selectExpr("id AS key", "id * 2 AS value")
    tables.commit("a", 0, {"t": Upsert(many, "key", last_wins, 64)})
    asked = spark.createDataFrame([(5,), (7,), (5,), (None,), (10**12,)], "key long")
    found = tables.read_keys("t", asked)
    assert rows(found) == [(5, 10), (7, 14)]
    read = [f for f in found.inputFiles() if "bucket=" in f]
    assert 0 < len({f.split("bucket=")[1].split("/")[0] for f in read}) <= 3
    assert tables.read_keys("absent", asked) is None


def test_features_are_stored_and_served_for_requests(spark, ratings, movies):
    tables = LiveTables(spark, new_path(spark, "test-serving"))
    history = batch_feature_tables(ratings([(1, 1, 1), (1, 2, 1), (2, 2, 0)]), movies)
    stored.store_features(tables, "f", 0, {"batch": history, "streaming": history})
    again = batch_feature_tables(ratings([(1, 4, 0), (3, 4, 1)]), movies)
    stored.store_features(tables, "f", 1, {"batch": again})
    users = stored.features_of(tables, "batch").users
    # Metrics that did not come again stay.
    assert rows(users, "userId", "pos_cnt", "neg_cnt") == [(1, 2, 1), (2, None, 1), (3, 1, None)]
    popular = spark.createDataFrame([(0, 4), (1, 2)], "pos int, movieId int")
    hot = spark.createDataFrame([(0, 1, 1), (3, 1, 2)], "genreId int, pos int, movieId int")
    with pytest.raises(ValueError, match="no model"):
        stored.params_of(tables)
    for version, weight in ((1, 0.0), (2, 1.0)):
        params = [(i, weight if i in (2, 3) else 0.0) for i in range(-1, 10)]
        stored.publish_model(tables, "release", version, params_table(spark, params))
    requests = spark.createDataFrame([(1,), (99,), (1,), (None,)], "userId int")

    def served(version=None):
        got = stored.recommend_for(tables, requests, movies, popular, hot, version)
        return rows(got, "userId", "rank", "movieId")

    # User 1 likes genre 3; user 99 was never seen and gets the first genre's list.
    # All scores are equal under version 1, so movies go by id.
    assert served(1) == [(1, 1, 2), (1, 2, 4), (99, 1, 1), (99, 2, 2), (99, 3, 4)]
    assert served() == served(2) == [(1, 1, 2), (1, 2, 4), (99, 1, 2), (99, 2, 4), (99, 3, 1)]
    stored.use_model(tables, "rollback", 0, 1)
    assert served() == served(1)
    with pytest.raises(ValueError, match="version 7"):
        stored.use_model(tables, "rollback", 1, 7)


def test_moments_certify_a_fit(spark):
    rnd = random.Random(8)
    data = []
    for _ in range(300):
        x = [rnd.gauss(0, 1) for _ in range(10)]
        data.append((float(x[0] + rnd.gauss(0, 2) > 0), *x))
    frame = spark.createDataFrame(data, ["label", *FEATURE_COLUMNS])
    wanted = {-1: sum(r[0] for r in data) / 300}
    wanted |= {i: sum(r[0] * r[i + 1] for r in data) / 300 for i in range(10)}

    def apart(model):
        got = fitted_moments(frame, model_params(spark, model)).collect()
        return max(abs(r["moment"] - wanted[r["idx"]]) for r in got)

    assert apart(fit_click_model(frame, 500, 1e-12)) < 1e-5 < apart(fit_click_model(frame, 1))


@pytest.mark.parametrize("n", [0, 1, 200, 5000])
def test_positions_equal_a_row_number(spark, n):
    rnd = random.Random(n)
    data = [(rnd.randrange(50), k, f"r{k}") for k in range(n)]
    frame = spark.createDataFrame(data, "ts int, seq int, key string").repartition(7)
    got = numbered(frame, "ts", "seq")
    assert rows(got, "i", "key") == rows(record_index(frame, "ts", "seq"), "i", "key")
    assert "SinglePartition" not in plan_of(got)


def test_first_of_a_genre_prunes_movies_before_their_genres(spark, ratings, movies):
    frame = ratings([(1, 1, 1)] * 30 + [(1, 2, 1)] * 5)
    timed = frame.withColumns({"seq": F.col("key").cast("bigint"), "ts": F.col("key").cast("int")})
    got = genre_first(timed, movies)
    assert [r["movieId"] for r in got.where("genreId = 3").orderBy("pos").collect()] == [1] * 10
    plan = plan_of(got).split("== Physical Plan ==")[1]
    assert "WindowGroupLimit" in plan[plan.index("Generate") :]
