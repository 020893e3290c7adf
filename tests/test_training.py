import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from reelrank.operators.training_window import COUNTS, TrainingBuffer, window_counts
from reelrank.plans.feature_tables import batch_feature_tables
from reelrank.plans.training import assemble, fit_click_model, training_set
from reelrank.schemas import FEATURE_COLUMNS
from reelrank.sinks.tables import model_params
from test_features import GENRES, SLOW

SCHEMA = "i int, userId int, movieId int, rating float"


def loop_counts(records, as_written):
    """Window counts record by record."""
    n, out = len(records), []
    half = n // 2
    for i in range(half + 1, n):
        if as_written:
            window = [0, *range(i - half + 1, i + 1)]
        else:
            window = list(range(i - half, i))
        user, movie, _ = records[i]
        c = Counter()
        for j in window:
            u, m, r = records[j]
            sign = "pos" if int(r) == 1 else "neg"
            c["user_" + sign] += u == user
            c["movie_" + sign] += m == movie
            if u == user and sign == "pos":
                c["hits"] += len(GENRES.get(m, []))
        names = ["user_pos", "user_neg", "movie_pos", "movie_neg", "hits"]
        out.append((i, *(c[name] for name in names)))
    return out


def buffer_of(spark, records):
    data = [(i, u, m, float(r)) for i, (u, m, r) in enumerate(records)]
    return TrainingBuffer.of(spark.createDataFrame(data, SCHEMA))


@pytest.mark.parametrize("as_written", [False, True])
@settings(**SLOW)
@given(
    size=st.sampled_from([0, 1, 2, 3, 7, 50, 199, 200]),
    seed=st.integers(0, 1000),
)
def test_window_equals_loop(spark, movies, size, seed, as_written):
    rnd = random.Random(seed)
    records = [
        (rnd.randint(1, 3), rnd.randint(1, 6), rnd.choice([0.0, 0.5, 1.0, 1.5, 2.0]))
        for _ in range(size)
    ]
    got = window_counts(buffer_of(spark, records), movies, as_written)
    assert sorted(map(tuple, got.select("i", *COUNTS).collect())) == loop_counts(
        records, as_written
    )


def test_training_set_features(spark, ratings, movies):
    history = ratings([(1, 1, 1), (1, 2, 1), (1, 4, 0), (2, 2, 0)])
    features = batch_feature_tables(history, movies)
    records = [(1, 1, 1), (2, 2, 0), (1, 2, 1), (1, 1, 0), (9, 99, 1)]
    buffer = buffer_of(spark, records)
    got = {r["i"]: tuple(r)[2:] for r in training_set(buffer, movies, features).collect()}
    # User 1: two positives, one negative; movie 1: genres 0 and 3, ratios 0.5 and 1.0.
    assert got[3] == (2.0, 1.0, 1.0, 0.0, 1.5, 1.0, 0.0, 0.0, 0.0, 1.0)
    assert got[4] == (0.0,) * 10
    written = training_set(buffer, movies, features, as_written=True)
    got = {r["i"]: tuple(r)[2:] for r in written.collect()}
    # Window {0, 2, 3}: user 1 has two positives with three genre hits, one negative.
    assert got[3] == (2.0, 1.0, 1.0, 0.0, 1.5, 2.0, 1.0, 1.0, 1.0, 1.0)


def training_frame(spark, labels, seed=1):
    rng = np.random.default_rng(seed)
    data = [(float(y), *map(float, rng.normal(size=10) + y)) for y in labels]
    return spark.createDataFrame(data, ["label", *FEATURE_COLUMNS])


def test_fit_is_deterministic_and_exports_in_order(spark):
    frame = training_frame(spark, [0, 1] * 40)
    first, second = fit_click_model(frame), fit_click_model(frame)
    assert list(first.coefficients) == list(second.coefficients)
    params = rows(model_params(spark, first))
    assert dict(params)[-1] == first.intercept
    assert [dict(params)[i] for i in range(10)] == list(first.coefficients)
    assert assemble(frame).first()["features"].size == 10


def test_converged_fit_has_no_gradient(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 10))
    y = (rng.random(300) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    data = [(float(t), *map(float, row)) for t, row in zip(y, x)]
    frame = spark.createDataFrame(data, ["label", *FEATURE_COLUMNS])
    model = fit_click_model(frame, max_iter=200)
    p = 1 / (1 + np.exp(-(x @ np.array(model.coefficients) + model.intercept)))
    assert np.abs(x.T @ (p - y) / len(y)).max() < 1e-3
    assert model.coefficients[0] > 0


@pytest.mark.parametrize("labels", [[], [1, 1], [0, 0], [0, 1, 2], [0, 1, 0.5]])
def test_fit_refuses_bad_labels(spark, labels):
    frame = training_frame(spark, labels) if labels else training_frame(spark, [1]).limit(0)
    with pytest.raises(ValueError):
        fit_click_model(frame.withColumn("label", F.col("label").cast("double")))
