"""Sliding window over the recent-ratings buffer.

The buffer is bounded (200 records), so numbering it and holding it in few
tasks is fine. With n records and h = n div 2, a row is produced for each
record i in h+1 .. n-1:

* default: counts over the h records before it, so a record's own label is
  never among its features;
* ``as_written``: counts over the h records ending with it, plus record 0,
  which is never evicted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelrank.functions.polarity import is_positive
from reelrank.operators.lookup import IdSet, bounded_lookup
from reelrank.operators.topk import number_rows

@dataclass(frozen=True)
class TrainingBuffer:
    """Buffered records (``i`` from 0, userId, movieId, rating), their number
    and the ids among them."""

    records: DataFrame
    length: int
    users: IdSet
    movies: IdSet

    @classmethod
    def of(cls, records: DataFrame) -> TrainingBuffer:
        """One counting job; ``records`` should be a stored frame."""
        counts = records.agg(
            F.count(F.lit(1)).alias("length"),
            F.count_distinct("userId").alias("users"),
            F.count_distinct("movieId").alias("movies"),
        ).first()
        return cls(
            records,
            counts["length"],
            IdSet.counted(records, "userId", counts["users"]),
            IdSet.counted(records, "movieId", counts["movies"]),
        )


COUNTS = ["w_user_pos", "w_user_neg", "w_movie_pos", "w_movie_neg", "w_user_hits"]


def record_index(buffer: DataFrame, *order: str) -> DataFrame:
    """0-based position of each record of the bounded buffer."""
    return number_rows(buffer, *(F.asc(c) for c in order or ("pos",)), pos="i")


def window_counts(
    buffer: TrainingBuffer, movies: DataFrame, as_written: bool = False
) -> DataFrame:
    """Window counts for the newer half of the buffer."""
    half = max(buffer.length // 2, 1)
    pos = is_positive(F.col("rating"), "truncating")
    genres = movies.select("movieId", "genres")
    records = bounded_lookup(buffer.records, genres, buffer.movies).select(
        "i",
        "userId",
        "movieId",
        "rating",
        pos.cast("bigint").alias("pos"),
        (~pos).cast("bigint").alias("neg"),
        F.when(pos, F.coalesce(F.size("genres"), F.lit(0))).otherwise(0).alias("hits"),
    )
    frame = (-(half - 1), 0) if as_written else (-half, -1)
    by_user = W.partitionBy("userId").orderBy("i").rangeBetween(*frame)
    by_movie = W.partitionBy("movieId").orderBy("i").rangeBetween(*frame)

    def counted(name: str, window: W, key: str) -> Column:
        total = F.coalesce(F.sum(name).over(window), F.lit(0))
        if as_written:
            first = F.col("first")
            total = total + F.when(first[key] == F.col(key), first[name]).otherwise(0)
        return total.cast("bigint")

    if as_written:
        first = records.where("i = 0").select(
            F.struct("userId", "movieId", "pos", "neg", "hits").alias("first")
        )
        records = records.withColumn("first", first.scalar())
    return records.select(
        "i",
        "userId",
        "movieId",
        "rating",
        counted("pos", by_user, "userId").alias("w_user_pos"),
        counted("neg", by_user, "userId").alias("w_user_neg"),
        counted("pos", by_movie, "movieId").alias("w_movie_pos"),
        counted("neg", by_movie, "movieId").alias("w_movie_neg"),
        counted("hits", by_user, "userId").alias("w_user_hits"),
    ).where(F.col("i") > half)


def window_affinity() -> Column:
    """Genre hits per windowed record of the user, 0 for an empty window."""
    seen = F.col("w_user_pos") + F.col("w_user_neg")
    return F.coalesce(F.col("w_user_hits").cast("double") / F.nullif(seen, F.lit(0)), F.lit(0.0))
