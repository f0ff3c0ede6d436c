"""Centroid clustering of integer vectors; the nearest centroid is found by the threshold algorithm.

For each dimension the centroids stand in a list sorted by their value there. From a vector's own value the lists are
walked outward, all dimensions one step at a time. A centroid met for the first time has its exact distance taken; one
not met yet is at least as far away in every dimension as that dimension's last step. Once the sum of these frontier
distances strictly exceeds the best exact distance no other centroid can win or draw, and the walk stops.

Vectors are written once; each round is one pass over them, in which a task sums its vectors for each centroid. What
reaches the driver is one row for each centroid and dimension.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import written

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors that walk the lists side by side.
WALKERS = 2048
#: Components of this size or more could make a distance exceed 63 bits.
TOO_LARGE = 1 << 27

_FAR = np.int64(TOO_LARGE * 4)


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of the vectors of exactly ``dimensions`` components, all finite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = rows.where((F.size(x) == dimensions) & finite)
    return good.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale))).alias("vector")
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of the smallest hashes of seed and id, in their order; those of one id by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "vector").select("vector").limit(clusters).collect()
    return np.array([row["vector"] for row in rows], np.int64)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dimensions)
    if len(values) and (values.max() >= TOO_LARGE or values.min() <= -TOO_LARGE):
        raise ArithmeticError("a vector's component is too large for distances of 63 bits")
    return values


class SortedLists:
    """The centroids in one list for each dimension, sorted by their value in it."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (the smaller of equals), squared distance, and distances taken in all."""
        parts = [self._walk(vectors[k : k + WALKERS]) for k in range(0, len(vectors), WALKERS)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        k, d = self.centroids.shape
        column = np.arange(d)
        who = np.full(len(vectors), k)
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        above = np.stack([np.searchsorted(self.values[:, j], vectors[:, j]) for j in range(d)], axis=1)
        below = above - 1
        seen = np.zeros((len(vectors), k), bool)
        left, taken = np.arange(len(vectors)), 0
        while len(left):
            own = vectors[left]
            down = np.where(below >= 0, own - self.values[np.maximum(below, 0), column], _FAR)
            up = np.where(above < k, self.values[np.minimum(above, k - 1), column] - own, _FAR)
            lower = down <= up
            met = self.order[np.where(lower, below, above), column]
            below, above = below - lower, above + ~lower
            frontier = (np.where(lower, down, up) ** 2).sum(axis=1)

            fresh = np.zeros((len(left), k), bool)
            fresh[np.arange(len(left))[:, None], met] = True
            fresh &= ~seen
            seen |= fresh
            row, number = np.nonzero(fresh)
            exact = ((own[row] - self.centroids[number]) ** 2).sum(axis=1)
            taken += len(row)
            order = np.lexsort((number, exact, row))
            row, number, exact = row[order], number[order], exact[order]
            first = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
            row, number, exact = left[row[first]], number[first], exact[first]
            wins = (exact < best[row]) | ((exact == best[row]) & (number < who[row]))
            best[row[wins]], who[row[wins]] = exact[wins], number[wins]

            on = (frontier <= best[left]) & ~seen.all(axis=1)
            left, below, above, seen = left[on], below[on], above[on], seen[on]
        return who, best, taken


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, dimension, total, n``: one row for each centroid and dimension."""
    k, d = centroids.shape

    def run(batches):
        lists = SortedLists(centroids)
        total, n = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            values = _matrix(batch.column(0), d)
            who, _, _ = lists.nearest(values)
            np.add.at(total, who, values)
            n += np.bincount(who, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, d).astype(np.int32)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(some))),
                pa.array(total[some].ravel()), pa.array(np.repeat(n[some], d)),
            ],
            ["cluster", "dimension", "total", "n"],
        )

    sums = vectors.select("vector").mapInArrow(run, "cluster int, dimension int, total long, n long")
    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    return sums.groupBy("cluster", "dimension").agg(exact("total"), exact("n"))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of each cluster's mean; an empty cluster's stays."""
    out = centroids.copy()
    for row in _sums(vectors, centroids).collect():  # clusters x dimensions rows at most
        out[row["cluster"], row["dimension"]] = int(row["total"]) // int(row["n"])
    return out


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after ``rounds`` rounds, or after fewer if a round moves none: later ones would not either."""
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(vectors, centroids)
        if (after == centroids).all():
            break
        centroids = after
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    d = centroids.shape[1]

    def run(batches):
        lists = SortedLists(centroids)
        for batch in batches:
            who, best, _ = lists.nearest(_matrix(batch.column(1), d))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(who.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"]
            )

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(
    rows: DataFrame,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    number: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that is kept.

    Reads ``vec_id, embedding`` only. Vectors of another length, null ones and those with a null or non-finite
    component are left out. Fewer vectors than ``number`` give as many centroids; without any the result is empty.
    Rows without a vec_id are clustered, but seed a centroid only after all others; repeated rows count each, and a
    centroid equal to one of a smaller number stays empty. Sums that leave 63 bits fail the job.
    """
    spark = rows.sparkSession
    vectors = written(integer_vectors(rows, dimensions, scale), "vectors")
    centroids = fit(vectors, number, rounds, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    found = written(assigned(vectors, centroids), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    total = sum(int(row["inertia"]) for row in sums)
    held = [(row["cluster"], int(row["inertia"]), total, centroids[row["cluster"]].tolist()) for row in sums]
    told = spark.createDataFrame(held, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = found.join(F.broadcast(told), "cluster")  # a row for each centroid
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
