import math
import random

import pytest

from conftest import rows
from reelrank.operators.topk import genre_hot_topk
from reelrank.plans import serving
from reelrank.plans.feature_tables import batch_feature_tables
from reelrank.sinks.tables import params_table
from test_features import GENRES, expected_metrics

WEIGHTS = [0.1, -0.2, 0.3, -0.1, 0.5, 0.2, -0.3, 0.1, -0.1, 0.4]
TITLES = {1: "one", 2: "two", 3: "three", 4: "four"}


def loop_recommend(users, popular, hot, batch, live, as_written):
    """Recommendations user by user."""
    out = []
    for user in users:
        ratios = [live.get(("user", user, f"g{g}"), 0.0) for g in range(19)]
        favorite = max(range(19), key=lambda g: (ratios[g], -g)) if any(ratios) else 0
        scored = []
        for movie in set(popular) | set(hot.get(favorite, [])):

            def of(table, entity, key, metric):
                return table.get((entity, key, metric), 0.0)

            def affinity(table):
                return sum(of(table, "user", user, f"g{g}") for g in GENRES.get(movie, []))

            s_neg = of(live, "user", user, "pos_cnt" if as_written else "neg_cnt")
            f = [
                of(batch, "user", user, "pos_cnt"),
                of(batch, "user", user, "neg_cnt"),
                of(batch, "movie", movie, "pos_cnt"),
                of(batch, "movie", movie, "neg_cnt"),
                affinity(batch),
                of(live, "user", user, "pos_cnt"),
                s_neg,
                of(live, "movie", movie, "pos_cnt"),
                of(live, "movie", movie, "neg_cnt"),
                affinity(batch if as_written else live),
            ]
            x = sum(a * b for a, b in zip(f, WEIGHTS)) + 0.1
            scored.append((-round(1 / (1 + math.exp(-x)), 9), movie))
        for rank, (_, movie) in enumerate(sorted(scored)[:10], 1):
            out.append((user, rank, movie, TITLES.get(movie)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("as_written", [False, True])
def test_recommend_equals_loop(spark, ratings, movies, as_written):
    rnd = random.Random(5)
    history = [(rnd.randint(1, 6), rnd.randint(1, 6), rnd.randint(0, 1)) for _ in range(60)]
    live = [(rnd.randint(3, 8), rnd.randint(1, 6), rnd.randint(0, 1)) for _ in range(30)]
    batch_tables = batch_feature_tables(ratings(history), movies)
    live_tables = batch_feature_tables(ratings(live), movies)
    popular = [1, 3, 99, 1]
    popular_table = spark.createDataFrame(list(enumerate(popular)), "pos int, movieId int")
    hot_table = genre_hot_topk(ratings(live), movies).select("genreId", "pos", "movieId")
    hot = {}
    for r in hot_table.orderBy("pos").collect():
        hot.setdefault(r["genreId"], []).append(r["movieId"])
    users = spark.createDataFrame([(u,) for u in range(1, 12)], "userId int")
    got = serving.recommend(
        popular_table,
        hot_table,
        movies,
        batch_tables,
        live_tables,
        WEIGHTS,
        0.1,
        users=users,
        as_written=as_written,
    )
    want = loop_recommend(
        range(1, 12),
        popular,
        hot,
        expected_metrics([(u, m, float(r)) for u, m, r in history]),
        expected_metrics([(u, m, float(r)) for u, m, r in live]),
        as_written,
    )
    assert rows(got, "userId", "rank", "movieId", "title") == want


def test_unknown_user_gets_popular_and_genre_zero(spark):
    users = spark.createDataFrame([(7, 0)], "userId int, genreId int")
    popular = spark.createDataFrame([(1, 20), (0, 10)], "pos int, movieId int")
    hot = spark.createDataFrame([(0, 1, 10), (0, 2, 30), (5, 1, 40)], "genreId int, pos int, movieId int")
    got = [r["movieId"] for r in serving.recall(users, popular, hot).collect()]
    assert got == [10, 20, 30]
    empty = popular.limit(0)
    assert [r["movieId"] for r in serving.recall(users, empty, hot).collect()] == [10, 30]


def test_favorite_tie_and_missing(spark):
    frame = spark.createDataFrame(
        [(1, None, 0.5, 0.5), (2, None, None, None), (3, 0.1, None, 0.2)],
        "userId int, a double, b double, c double",
    )
    got = frame.select("userId", serving.favorite_of(["a", "b", "c"]))
    assert rows(got) == [(1, 1), (2, 0), (3, 2)]


def test_equal_scores_rank_by_movie_id(spark):
    frame = spark.createDataFrame(
        [(1, 5, 0.5), (1, 3, 0.5 + 1e-12), (1, 9, 0.7)], "userId int, movieId int, score double"
    )
    assert rows(serving.rank(frame), "rank", "movieId") == [(1, 9), (2, 3), (3, 5)]


def test_params_attach_without_a_join(spark):
    params = params_table(spark, [*enumerate(WEIGHTS), (-1, 0.1)])
    got = serving.with_params(spark.createDataFrame([(1,), (2,)], "userId int"), params)
    assert [r["c3"] for r in got.collect()] == [-0.1, -0.1]
    assert got.first()["intercept"] == 0.1
