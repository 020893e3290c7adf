from pyspark.sql import functions as F

from conftest import rows
from reelrank.operators.counts import rating_counts
from reelrank.operators.topk import (
    genre_first,
    genre_hot_last_batch,
    genre_hot_topk,
    popular_bounded,
    popular_topk,
    recent_ratings,
)
from reelrank.sources.features import read_ordered


def timed(frame):
    return frame.withColumns({"seq": F.col("key").cast("bigint"), "ts": F.col("key").cast("int")})


def test_popular_ties_go_to_the_lower_id(ratings):
    frame = ratings([(1, 5, 1), (2, 5, 0), (1, 9, 1), (1, 2, 1), (1, 7, 0)])
    assert rows(popular_topk(frame, k=3), "pos", "movieId", "cnt") == [
        (1, 5, 2),
        (2, 2, 1),
        (3, 7, 1),
    ]


def test_popular_keeps_last_entries_and_repeats(spark):
    data = [(b, m, 20 - m) for b in range(5) for m in range(10)]
    counts = spark.createDataFrame(data, "batch int, movieId int, cnt int")
    got = popular_bounded(counts, "batch", 30)
    assert [r["movieId"] for r in got.orderBy("pos").collect()] == list(range(10)) * 3
    assert [r["pos"] for r in read_ordered(got, 28).collect()] == [28, 29]


def test_recent_shorter_than_its_bound(ratings):
    frame = timed(ratings([(1, i, 1) for i in range(5)]))
    assert [r["pos"] for r in recent_ratings(frame).orderBy("pos").collect()] == [0, 1, 2, 3, 4]
    newest = recent_ratings(frame, size=2)
    assert rows(newest, "pos", "movieId") == [(0, 3), (1, 4)]


def test_hot_lists(ratings, movies):
    frame = ratings([(1, 2, 1)] + [(u, 1, 0) for u in range(3)])
    assert rows(genre_hot_topk(frame, movies), "genreId", "pos", "movieId", "cnt") == [
        (0, 1, 1, 3),
        (3, 1, 1, 3),
        (3, 2, 2, 1),
    ]


def test_first_ignores_counts(ratings, movies):
    frame = timed(ratings([(1, 2, 1)] + [(u, 1, 0) for u in range(20)]))
    got = genre_first(frame, movies).where("genreId = 3").orderBy("pos")
    assert [r["movieId"] for r in got.collect()] == [2] + [1] * 9


def test_last_batch_list_keeps_genres_it_did_not_touch(ratings, movies):
    early = ratings([(1, 4, 1), (1, 1, 1)]).withColumn("batch", F.lit(1))
    late = ratings([(1, 2, 1), (1, 3, 1)]).withColumn("batch", F.lit(2))
    counts = rating_counts(early.union(late), "batch", "movieId")
    got = genre_hot_last_batch(counts, movies, "batch")
    assert rows(got, "genreId", "pos", "movieId") == [(0, 1, 1), (18, 1, 4), (3, 1, 2)]
