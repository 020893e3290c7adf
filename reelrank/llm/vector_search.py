"""Approximate nearest neighbours by largest inner product, with randomly rotated one-bit codes.

A unit vector is padded, rotated at random and kept as the signs of its coordinates. With x the
sign vector (of unit length), o the vector and q a rotated query, <x, q> / <x, o> estimates
<o, q>; the scalar <x, o> is kept with the bits. The error is below
BOUND * sqrt((1 - <x, o>^2) / (<x, o>^2 (D - 1))) with overwhelming probability, so a candidate
whose upper bound lies below the k-th largest lower bound can't be among the k nearest; all
others are scored again exactly, in double precision.

Equal vectors are one vector with the smallest of its ids (at most k + 1 can be in a result), so a
third of all rows may be equal. Queries and vectors meet in blocks: each block of queries
sees each shard of vectors once, vectors stream through in batches, and only the k best of a
query and shard leave a task. The work is that of a stated query set against all rows.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, and
so do rows without an id. Vectors meet only those of equal length. Ties go to the smaller id;
rows of equal id and vector count once. A query with fewer candidates returns all. Empty tables give
an empty result; further columns, of any name, are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import stage

#: Bits of a code for each component, the width of the error bound, and the seed of the rotation.
BITS_PER_COMPONENT, BOUND, SEED = 4, 2.5, 11

#: Queries in a block, vectors in a shard, and vectors that are compared at a time.
QUERY_BLOCK, SHARD, STEP = 4096, 16_384, 512


def rotation(size: int) -> np.ndarray:
    """The first ``size`` rows of a random orthogonal matrix of the padded size."""
    padded = max(64, size * BITS_PER_COMPONENT)
    full = np.random.default_rng(SEED).normal(size=(padded, padded))
    return np.linalg.qr(full)[0][:size].astype(np.float32)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the correction scalars <x, o>."""
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rotated = units.astype(np.float32) @ turn
    scalars = np.abs(rotated).sum(axis=1) / math.sqrt(turn.shape[1])
    return np.packbits(rotated > 0, axis=1), scalars.astype(np.float32)


def estimate(
    codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries by codes) of rotated unit queries, and error bounds."""
    size = queries.shape[1]
    signs = np.unpackbits(codes, axis=1)[:, :size].astype(np.float32)
    signs = (signs * 2 - 1) / math.sqrt(size)
    error = BOUND * np.sqrt(np.maximum(0.0, 1 - scalars**2) / (scalars**2 * (size - 1)))
    return (queries @ signs.T) / scalars, error


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    parts = F.col(vector)
    finite = F.forall(
        parts,
        lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(parts, lambda v: v != 0), F.lit(False))


def numbered(rows: DataFrame) -> DataFrame:
    """(id, vector, key) of the rows that take part; equal vectors have equal keys."""
    # Adding 0 turns negative zeros, which are equal in every product, into zeros.
    doubles = F.transform(F.col("vector").cast("array<double>"), lambda v: v + F.lit(0.0))
    text = F.array_join(F.transform("vector", lambda v: v.cast("string")), ",")
    return (
        rows.where(F.col("id").isNotNull() & usable("vector"))
        .select("id", doubles.alias("vector"))
        .withColumn("key", F.md5(text))
    )


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(key, ids, vector): one row per vector with its k + 1 smallest ids."""
    # Equal rows are one; row numbers up to k + 1 are pruned before the shuffle.
    order = Window.partitionBy("key").orderBy("id")
    smallest = (
        rows.dropDuplicates(["key", "id"])
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= k + 1)
    )
    return smallest.groupBy("key").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector")
    )


def encoded(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``bits`` and ``scalar``: the index, a row for every vector."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch["vector"].map(len)
            for size, part in batch.groupby(sizes):
                if size not in turns:
                    turns[size] = rotation(size)
                bits, scalars = encode(np.stack(part["vector"].to_list()), turns[size])
                yield part.assign(bits=[b.tobytes() for b in bits], scalar=scalars)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInPandas(build, f"{fields}, bits binary, scalar float")


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Blocks one after the other, in each the queries first; keeps the k best ids of a query."""
    state: _Block | None = None
    for batch in batches:
        marks = batch[["size", "block", "shard"]].to_numpy()
        edges = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
        for lo, hi in zip(edges, [*edges[1:], len(batch)], strict=True):
            part, mark = batch.iloc[lo:hi], tuple(marks[lo])
            if state is None or state.mark != mark:
                if state is not None:
                    yield state.result()
                state = _Block(mark, k)
            asked = part["is_query"].to_numpy(bool)
            state.add_queries(part[asked])
            state.compare(part[~asked])
    if state is not None:
        yield state.result()


class _Block:
    """One block of queries against one shard, the vectors in batches."""

    def __init__(self, mark: tuple, k: int):
        self.mark, self.k = mark, k
        self.turn = rotation(int(mark[0]))
        self.keys: list[str] = []
        self.parts: list[np.ndarray] = []
        self.queries = None

    def add_queries(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.keys += rows["key"].to_list()
            self.parts.append(np.stack(rows["vector"].to_list()))

    def _start(self) -> None:
        self.queries = np.concatenate(self.parts)
        self.norms = np.linalg.norm(self.queries, axis=1)
        units = (self.queries / self.norms[:, None]).astype(np.float32)
        self.rotated = units @ self.turn
        n = len(self.queries)
        # A query leaves itself out later, so one more is kept.
        self.scores = np.full((n, self.k + 1), -np.inf)
        self.ids = np.full((n, self.k + 1), np.iinfo(np.int64).max)

    def compare(self, rows: pd.DataFrame) -> None:
        if not len(rows) or not self.parts:
            return
        if self.queries is None:
            self._start()
        for lo in range(0, len(rows), STEP):
            self._compare(rows.iloc[lo : lo + STEP])

    def _compare(self, rows: pd.DataFrame) -> None:
        vectors = np.stack(rows["vector"].to_list())
        lengths = np.linalg.norm(vectors, axis=1)
        codes = np.stack([np.frombuffer(b, np.uint8) for b in rows["bits"]])
        near, error = estimate(codes, rows["scalar"].to_numpy(), self.rotated)
        scale = self.norms[:, None] * lengths[None, :]
        upper, lower = (near + error) * scale, (near - error) * scale
        counts = rows["ids"].map(len).to_numpy()
        # The k + 1-th largest of what is known exactly and of the lower bounds here.
        floor = self.scores[:, -1]
        if len(rows) > self.k:
            floor = np.maximum(floor, np.partition(lower, -self.k - 1, axis=1)[:, -self.k - 1])
        at, of = np.nonzero(upper >= floor[:, None] - 1e-6 * np.abs(scale))
        ids = rows["ids"].to_list()
        exact = np.einsum("ij,ij->i", self.queries[at], vectors[of])
        copies = counts[of]
        found = pd.DataFrame({
            "q": np.repeat(at, copies),
            "score": np.repeat(exact, copies),
            "id": np.concatenate([ids[j] for j in of]) if len(of) else np.empty(0, np.int64),
        })
        self._merge(found)

    def _merge(self, found: pd.DataFrame) -> None:
        touched = np.unique(found["q"].to_numpy())
        old_q = np.repeat(touched, self.k + 1)
        q = np.r_[old_q, found["q"].to_numpy()]
        score = np.r_[self.scores[touched].ravel(), found["score"].to_numpy()]
        ids = np.r_[self.ids[touched].ravel(), found["id"].to_numpy()]
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        keep = rank <= self.k
        self.scores[q[keep], rank[keep]] = score[keep]
        self.ids[q[keep], rank[keep]] = ids[keep]

    def result(self) -> pd.DataFrame:
        columns = ["key", "id", "score"]
        if self.queries is None:
            return pd.DataFrame({"key": [], "id": [], "score": []}, columns=columns)
        row, place = np.nonzero(self.scores > -np.inf)
        return pd.DataFrame(
            {
                "key": np.array(self.keys, object)[row],
                "id": self.ids[row, place],
                "score": self.scores[row, place],
            }
        )


def nearest(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose id ``every`` divides."""
    rows = numbered(
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    )
    index = stage(encoded(distinct_vectors(rows, k)), "vector-index")
    asked = rows.where(F.col("id") % every == 0)
    queries = stage(
        asked.select(F.col("id").alias("query_id"), "key").distinct(), "vector-queries"
    )

    wanted = queries.select("key").distinct()
    # One row of counts; the numbers of blocks and shards follow the input.
    shards = max(1, -(-index.count() // SHARD))
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    nothing = [
        F.lit(None).cast(kind).alias(name)
        for name, kind in (("ids", "array<long>"), ("bits", "binary"), ("scalar", "float"))
    ]
    place = F.xxhash64("key")
    as_queries = index.join(wanted, "key", "left_semi").select(
        F.size("vector").alias("size"),
        F.pmod(place, F.lit(blocks)).cast("int").alias("block"),
        every_shard.alias("shard"),
        F.lit(True).alias("is_query"),
        "key",
        "vector",
        *nothing,
    )
    as_vectors = index.select(
        F.size("vector").alias("size"),
        every_block.alias("block"),
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.lit(False).alias("is_query"),
        "key",
        "vector",
        "ids",
        "bits",
        "scalar",
    )
    keys = ["size", "block", "shard"]
    dealt = (
        as_queries.union(as_vectors)
        .repartition(*keys)
        .sortWithinPartitions(*keys, F.col("is_query").desc())
    )
    found = dealt.mapInPandas(
        lambda batches: _search(batches, k), "key string, id long, score double"
    )
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    few = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        queries.join(few, "key")
        .where("query_id != id")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
