"""Centroid clustering in exact integers, with a vantage-point tree over the centroids.

Components become integers, floor(scale * x). Each round builds a vantage-point tree over the present
centroids and broadcasts it; every vector searches it best first: the open node with the smallest lower
bound is next, and a node is left out only if its bound lies beyond the best distance so far. The
radius is inclusive, so a centroid at exactly the best distance is still met and the smaller
number wins a tie. Bounds are doubles with a margin; distances are exact integers.

Vectors of an Arrow batch search together, each with bounds and a best of its own. A round sends
one row of sums per task, centroid and component to the shuffle; what comes back to the driver is one row per
centroid and component, ``MOST_NUMBERS`` at most. Vectors are written once as integers, and every
round reads that table, so a lost executor costs a re-read.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no part. Neither
do vectors with a component of 2**17 or more in size, whose distances need not fit 64 bits. Repeated rows
count as often as they are there; a null id counts as the empty text when the first centroids are
chosen, and equal ids are taken in order of their vectors. With fewer vectors than centroids there are as
many centroids as vectors; an empty table gives an empty result. A sum
of distances beyond 64 bits is null. Further columns, of any name, are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.session import stage

#: Numbers in all centroids together: the bound of what is broadcast and collected each round.
MOST_NUMBERS = 1 << 20

#: Components of this size or more have no exact distance in 64 bits.
TOO_LARGE = 1 << 17

#: Centroids in a leaf of the tree, and bounds (vectors by nodes) that are held at a time.
LEAF, BOUNDS = 2, 1 << 20


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of 64-bit integer ``vectors`` from ``point``."""
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


@dataclass
class Node:
    """A leaf holds centroids; an inner node a vantage point and its two children.

    ``inside`` and ``outside`` are the least and largest distances of the children's centroids
    from the vantage point.
    """

    numbers: list[int]
    near: int = -1
    far: int = -1
    inside: tuple[float, float] = (0.0, 0.0)
    outside: tuple[float, float] = (0.0, 0.0)


class VantageTree:
    """Nearest of ``centroids`` by exact squared distance; the smaller number wins ties."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[Node] = []
        self._build(list(range(len(centroids))))

    def _build(self, numbers: list[int]) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(numbers))
        if len(numbers) <= LEAF:
            return at
        points = self.centroids[numbers]
        # The vantage point is the one that spreads the others most.
        spread = [np.ptp(np.sqrt(squared(points, p).astype(float))) for p in points]
        top = int(np.argmax(spread))
        others = [n for k, n in enumerate(numbers) if k != top]
        apart = np.sqrt(squared(self.centroids[others], points[top]).astype(float))
        order = np.argsort(apart, kind="stable")
        half = len(others) // 2
        children = [order[:half], order[half:]]
        node = self.nodes[at]
        node.numbers = [numbers[top]]
        node.inside, node.outside = [(apart[c].min(), apart[c].max()) for c in children]
        node.near, node.far = [self._build([others[k] for k in c]) for c in children]
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the centroid nearest to each of ``vectors``."""
        step = max(1, BOUNDS // len(self.nodes))
        parts = [self._search(vectors[k : k + step]) for k in range(0, len(vectors), step)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids))
        radius = np.full(n, np.inf)
        # Lower bounds of the nodes that a vector may still open; the others are infinite.
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0
        live = np.arange(n)
        while len(live):
            chosen = bounds[live].argmin(axis=1)
            least = bounds[live, chosen]
            going = (least <= radius[live]) & (least < np.inf)
            live, chosen = live[going], chosen[going]
            bounds[live, chosen] = np.inf
            for k in np.unique(chosen):
                rows, node = live[chosen == k], self.nodes[k]
                for c in node.numbers:
                    apart = squared(vectors[rows], self.centroids[c])
                    closer = (apart < best[rows]) | ((apart == best[rows]) & (c < number[rows]))
                    best[rows[closer]], number[rows[closer]] = apart[closer], c
                # A margin for rounding keeps the pruning radius inclusive.
                radius[rows] = np.sqrt(best[rows].astype(float)) * (1 + 1e-9) + 1e-6
                if node.near < 0:
                    continue
                away = np.sqrt(apart.astype(float))
                for child, (lo, hi) in ((node.near, node.inside), (node.far, node.outside)):
                    bounds[rows, child] = np.maximum(np.maximum(away - hi, lo - away), 0.0) * (
                        1 - 1e-9
                    )
        return number, best


def integers(vector: str, size: int, scale: int) -> Column:
    """The integer components of a vector that takes part, else null."""
    parts = F.transform(vector, lambda v: v.cast("double"))
    fit = F.forall(
        parts, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float(TOO_LARGE)))
    )
    whole = F.transform(parts, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return F.when((F.size(vector) == size) & fit, whole)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hashes of ``seed`` and their ids."""
    text = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = (
        vectors.select(F.sha2(text, 256).alias("hash"), "parts")
        .orderBy("hash", "parts")
        .limit(k)
        .collect()
    )
    return np.array([r["parts"] for r in rows], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray, tree) -> np.ndarray:
    """Centroids after a round: floor of the exact means; those without vectors stay."""
    size = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), size), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("parts"), size)
                number, _ = tree.value.nearest(rows)
                np.add.at(total, number, rows)
                n += np.bincount(number, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "number": np.repeat(used, size).astype(np.int32),
                "place": np.tile(np.arange(size, dtype=np.int32), len(used)),
                "n": np.repeat(n[used], size),
                "total": total[used].ravel(),
            }
        )

    found = (
        vectors.select("parts")
        .mapInArrow(sums, "number int, place int, n long, total long")
        .groupBy("number", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    after = centroids.copy()
    for r in found:
        after[r["number"], r["place"]] = int(r["total"]) // r["n"]
    return after


def cluster(
    table: DataFrame,
    k: int = 8,
    rounds: int = 10,
    size: int = 64,
    scale: int = 1024,
    seed: str = "3:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector, and the final centroids."""
    if k * size > MOST_NUMBERS:
        raise ValueError(f"{k} centroids of {size} components are over {MOST_NUMBERS} numbers")
    spark = table.sparkSession
    vectors = stage(
        table.select(
            F.col(id_col).alias("id"), integers(vector_col, size, scale).alias("parts")
        ).where("parts IS NOT NULL"),
        "cluster-vectors",
    )
    centroids = first_centroids(vectors, k, seed).reshape(-1, size)
    for _ in range(rounds if len(centroids) else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        centroids = moved(vectors, centroids, tree)
        tree.unpersist()
    last = spark.sparkContext.broadcast(VantageTree(centroids) if len(centroids) else None)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, apart = last.value.nearest(_matrix(batch.column("parts"), size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(number.astype(np.int32)), pa.array(apart)],
                    names=["id", "cluster", "distance"],
                )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(assign, f"id {kind}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the summed distances of its cluster and of all, and its centroid's digest."""
    spark = assigned.sparkSession
    assigned = stage(assigned, "cluster-members")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = assigned.groupBy("cluster").agg(exact.alias("inertia")).collect()
    per_cluster = {r["cluster"]: int(r["inertia"]) for r in sums}
    fitting = [*per_cluster.values(), sum(per_cluster.values())]
    *each, whole = [total if total < 1 << 63 else None for total in fitting]
    about = [
        (k, total, whole, centroid_digest(centroids[k]))
        for k, total in zip(per_cluster, each, strict=True)
    ]
    # One row per centroid.
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(spark.createDataFrame(about, schema)), "cluster")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
