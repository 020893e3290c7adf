from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from reelrank.operators.counts import features_single_pass, polarity_counts
from reelrank.operators.genres import (
    explode_genres,
    genre_movie_counts,
    genre_record_counts,
    user_affinity_total,
    user_genre_ratio,
    user_genre_share,
)
from reelrank.operators.lookup import IdSet
from reelrank.operators.upsert import (
    append_bounded,
    latest_by_key,
    replace_lists,
    upsert_metrics,
)
from reelrank.plans.feature_tables import (
    batch_feature_tables,
    cumulative_metrics,
    feature_tables_for,
    metrics_long,
    split,
)
from reelrank.schemas import GENRE_NAMES, RATINGS
from reelrank.sources.features import read_default_zero

GENRES = {1: [0, 3], 2: [3], 3: [], 4: [18]}
SLOW = dict(
    deadline=None,
    max_examples=4,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
RATING_ROWS = st.lists(
    st.tuples(
        st.integers(1, 3),
        st.integers(1, 5),
        st.sampled_from([0.0, 0.5, 1.0, 1.5]),
    ),
    min_size=1,
    max_size=25,
)


def expected_metrics(data):
    """Plain-Python feature tables."""
    out = Counter()
    totals = Counter(u for u, _, r in data if r == 1.0)
    for user, movie, rating in data:
        metric = {1.0: "pos_cnt", 0.0: "neg_cnt"}.get(rating)
        if metric:
            out["user", user, metric] += 1
            out["movie", movie, metric] += 1
        if rating == 1.0:
            for genre in GENRES.get(movie, []):
                out["user", user, f"g{genre}"] += 1
    return {
        k: v / totals[k[1]] if k[2].startswith("g") else float(v) for k, v in out.items()
    }


@settings(**SLOW)
@given(data=RATING_ROWS)
def test_single_pass_equals_plain_python(spark, ratings, movies, data):
    frame = ratings(data)
    got = metrics_long(cumulative_metrics(frame, movies))
    assert {tuple(r)[:3]: r["value"] for r in got.collect()} == expected_metrics(data)


@settings(**SLOW)
@given(data=RATING_ROWS)
def test_shares_sum_to_one(ratings, movies, data):
    shares = user_genre_share(ratings(data), movies).groupBy("userId").agg(F.sum("ratio"))
    assert all(total == pytest.approx(1.0) for _, total in shares.collect())


def test_ratio_counts_genreless_movies_in_the_denominator(ratings, movies):
    data = [(1, 1, 1), (1, 3, 1), (1, 99, 1), (1, 2, 1), (1, 4, 0), (2, 3, 1)]
    got = user_genre_ratio(ratings(data), movies)
    assert rows(got, "userId", "genreId", "ratio") == [(1, 0, 0.25), (1, 3, 0.5)]
    assert rows(user_affinity_total(got)) == [(1, 0.75)]


def test_ratio_and_tables_agree(ratings, movies):
    frame = ratings([(1, 1, 1), (1, 2, 1), (2, 4, 1), (2, 4, 0), (3, 1, 0)])
    tables = batch_feature_tables(frame, movies)
    assert rows(tables.ratio(), "userId", "genreId", "ratio") == rows(
        user_genre_ratio(frame, movies), "userId", "genreId", "ratio"
    )
    keys = {r["key"]: r["value"] for r in tables.kv("batch").collect()}
    assert keys["batch2feature_userId_rating1_1"] == 2.0
    assert keys["batch2feature_movieId_rating0_4"] == 1.0
    assert keys["batch2feature_userId_to_genresId_1_3"] == 1.0
    assert "batch2feature_userId_rating0_1" not in keys


def test_off_domain_only_user_has_no_row(ratings, movies):
    frame = ratings([(1, 1, 0.5), (2, 1, 1.0)])
    assert [r["userId"] for r in split(cumulative_metrics(frame, movies)).users.collect()] == [2]
    assert rows(polarity_counts(frame, "userId")) == [(2, 1, None)]


@pytest.mark.parametrize("bound", [10, 0])
def test_features_for_some_ids_equal_the_full_tables(spark, ratings, movies, bound):
    """With and without the broadcast hint.""" 
    data = [(u, m, (u * m) % 2) for u in range(1, 7) for m in range(1, 5) for _ in range(u)]
    frame = ratings(data)
    users = spark.createDataFrame([(2,), (5,), (2,)], "userId int")
    ids = spark.createDataFrame([(4,)], "movieId int")
    some = feature_tables_for(
        frame, movies, IdSet.of(users, "userId", bound), IdSet.of(ids, "movieId", bound)
    )
    full = batch_feature_tables(frame, movies)
    assert rows(some.users) == rows(full.users.where("userId IN (2, 5)"))
    assert rows(some.movies) == rows(full.movies.where("movieId = 4"))


def test_empty_input(spark, movies):
    empty = spark.createDataFrame([], RATINGS)
    assert user_genre_ratio(empty, movies).count() == 0
    assert features_single_pass(empty).count() == 0
    counts = genre_record_counts(empty, movies)
    assert {r["cnt"] for r in counts.collect()} == {0} and counts.count() == len(GENRE_NAMES)


def test_explode_and_counts(ratings, movies):
    frame = ratings([(1, 1, 1), (2, 1, 0), (1, 3, 1), (1, 99, 1)])
    assert rows(explode_genres(frame, movies), "userId", "genreId") == [
        (1, 0),
        (1, 3),
        (2, 0),
        (2, 3),
    ]
    assert rows(genre_movie_counts(frame, movies)) == [(0, 1, 2), (3, 1, 2)]


def test_results_ignore_row_order_and_partitioning(spark, ratings, movies):
    data = [(i % 3 + 1, i % 5 + 1, i % 2) for i in range(60)]
    base = rows(cumulative_metrics(ratings(data), movies))
    shuffled = ratings(list(reversed(data))).repartition(7)
    assert rows(cumulative_metrics(shuffled, movies)) == base


def test_latest_by_key_with_one_hot_key(spark):
    hot = [("hot", i, i % 7) for i in range(2000)]
    cold = [(f"k{i}", i, 1) for i in range(20)]
    frame = spark.createDataFrame(hot + cold, "key string, ts int, value int").repartition(8)
    got = {r["key"]: r["ts"] for r in latest_by_key(frame, ["key"], [F.desc("ts")]).collect()}
    assert got == {"hot": 1999, **{f"k{i}": i for i in range(20)}}


def test_upsert_is_per_metric_and_idempotent(spark):
    schema = "userId int, pos_cnt bigint, neg_cnt bigint"
    old = spark.createDataFrame([(1, 5, 3), (2, None, 4)], schema)
    new = spark.createDataFrame([(1, 2, None), (3, None, 1)], schema)
    metrics = ["pos_cnt", "neg_cnt"]
    once = upsert_metrics(old, new, ["userId"], metrics)
    assert rows(once) == [(1, 2, 3), (2, None, 4), (3, None, 1)]
    assert rows(upsert_metrics(once, new, ["userId"], metrics)) == rows(once)


def test_replace_lists_keeps_unseen_keys(spark):
    old = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "genreId int, movieId int")
    new = spark.createDataFrame([(0, 9)], "genreId int, movieId int")
    assert rows(replace_lists(old, new, "genreId")) == [(0, 9), (1, 3)]


def test_append_bounded(spark):
    old = spark.createDataFrame([(i,) for i in range(4)], "seq int")
    new = spark.createDataFrame([(i,) for i in range(4, 7)], "seq int")
    got = append_bounded(old, new, ["seq"], 5)
    assert rows(got, "pos", "seq") == [(i, i + 2) for i in range(5)]


def test_default_zero(spark):
    ids = spark.createDataFrame([(1,), (2,)], "userId int")
    features = spark.createDataFrame([(1, 3, None)], "userId int, pos_cnt bigint, neg_cnt bigint")
    assert rows(read_default_zero(ids, features, "userId")) == [(1, 3.0, 0.0), (2, 0.0, 0.0)]


def test_genre_totals_equal_exploded_counts(ratings, movies):
    data = [(1, i % 6, 1) for i in range(50)]
    want = defaultdict(int)
    for _, movie, _ in data:
        for genre in GENRES.get(movie, []):
            want[GENRE_NAMES[genre]] += 1
    got = {r["name"]: r["cnt"] for r in genre_record_counts(ratings(data), movies).collect()}
    assert got == {name: want[name] for name in GENRE_NAMES}


def test_single_pass_counts_only_after_the_shuffle_by_group(spark):
    """No task keeps a map of every user and movie its input touches (F2..F13):
    ratings reach one shuffle by (entity, id) before any aggregation."""
    ratings = spark.createDataFrame(
        [(1, 10, 1.0, 3), (1, 11, 0.0, 1), (None, 10, 1.0, 0)],
        "userId int, movieId int, rating float, mask int",
    )
    plan = features_single_pass(ratings, genres=True)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    below = text[text.index("Exchange hashpartitioning(") :]
    assert "entity" in below.splitlines()[0] and "id" in below.splitlines()[0]
    assert "HashAggregate" not in below and "Expand" not in text
    got = {(r["entity"], r["id"]): (r["cnt"], r["pos_cnt"], r["g0"]) for r in
           features_single_pass(ratings, genres=True).collect()}
    assert got == {("user", 1): (2, 1, 1), ("user", None): (1, 1, 0),
                   ("movie", 10): (2, 2, None), ("movie", 11): (1, None, None)}
