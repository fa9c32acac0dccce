"""Centroid clustering with an n-simplex projection in front of exact distances.

Vectors become whole numbers once and are stored with their squared distances to a few pivots.
The pivots span a simplex; from its distances to them every vector, and every centroid, gets the
coordinates of an apex over that simplex. The distance of two apexes is a lower bound of the
true distance, and the distance with one of them mirrored an upper bound. A centroid whose lower
bound exceeds the least upper bound of a vector is never compared with it; what is left is
compared in exact whole numbers, so bounds save work and decide nothing.

Pivots are taken from the starting centroids, each the farthest from the flat of those before,
and only while the simplex stays well shaped. The bounds are widened by more than rounding can
move them.

A round is one pass: tasks assign their rows and send counts and exact sums per centroid, never
vectors. Starting vectors, centroids and sums are bounded by the number of centroids.

Defined results: vectors of another length, with a null, infinite or not-a-number entry, and null
ones are left out; every other row is one vector, repeated ones too. Rows without identifier
start no centroid unless others run out. Rows of one identifier start in the order of their
entries. With fewer vectors than centroids there are as many centroids as vectors. Entries beyond
the range of a long are its ends, and so are distances and sums of distances in the result;
comparisons are exact all the same. An empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import map_batches, stored
from wirecount.llm.vectors import LONG, Sums, finite, floored, matrix, squares, together

WIDTH, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Most pivots, and the least height of a pivot over the others, as a share of the widest edge.
PIVOTS, HEIGHT = 8, 0.05
#: What bounds are widened by, as a share of the squared distances they come from.
SLACK = 1e-4


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, one by one."""
    if max(np.abs(x.astype(float)).max(initial=0), np.abs(y.astype(float)).max(initial=0)) > 2 ** 61:
        x, y = x.astype(object), y.astype(object)
    return squares(x - y)


class Simplex:
    """Coordinates over a simplex of pivots from squared distances to them."""

    def __init__(self, starts: np.ndarray):
        points = starts.astype(np.float64)
        chosen, axes = [0], np.empty((0, points.shape[1]))
        edges = points - points[0]
        widest = np.linalg.norm(edges, axis=1).max()
        while len(chosen) < PIVOTS:
            rest = edges - edges @ axes.T @ axes
            heights = np.linalg.norm(rest, axis=1)
            far = int(heights.argmax())
            if heights[far] <= HEIGHT * widest or far in chosen:
                break
            chosen.append(far)
            axes = np.vstack([axes, rest[far] / heights[far]])
        self.pivots = starts[chosen]
        edges = edges[chosen[1:]]
        gram = edges @ edges.T
        self.solve = np.linalg.inv(np.linalg.cholesky(gram))
        self.edges = np.diag(gram)

    def cached(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of rows to every pivot."""
        return np.column_stack([distances(x, p[None]).astype(np.float64) for p in self.pivots])

    def apexes(self, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the flat of the simplex, and heights over it."""
        inner = (cached[:, :1] - cached[:, 1:] + self.edges) / 2
        flat = inner @ self.solve.T
        return flat, np.sqrt(np.maximum(cached[:, 0] - (flat ** 2).sum(axis=1), 0))

    def bounds(self, cached: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances of rows to the other rows."""
        (flat, up), (flat2, up2) = self.apexes(cached), self.apexes(others)
        along = ((flat[:, None] - flat2[None]) ** 2).sum(axis=2)
        slack = SLACK * (cached[:, :1] + others[:, 0] + self.edges.max(initial=0))
        return (along + (up[:, None] - up2) ** 2 - slack,
                along + (up[:, None] + up2) ** 2 + slack)


def nearest(x: np.ndarray, cached: np.ndarray, centers: np.ndarray, simplex: Simplex) \
        -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest center of every row (in a tie the first),
    and how many distances were taken."""
    lower, upper = simplex.bounds(cached, simplex.cached(centers))
    row, center = np.nonzero(lower <= upper.min(axis=1, keepdims=True))
    exact = distances(x[row], centers[center])
    starts = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(exact, starts)
    first = np.flatnonzero(exact == least[row])
    first = first[np.unique(row[first], return_index=True)[1]]
    return center[first], least, len(row)


def _starts(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest hashes of their identifiers."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "x").limit(count).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


def _with_distances(vectors: DataFrame, simplex: Simplex, width: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in together(batches):
            cached = simplex.cached(matrix(batch.column(1), width))
            k = cached.shape[1]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, cached.size + 1, k), pa.int32()), pa.array(cached.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "x", "cached"])

    return map_batches(vectors, run, f"id {kind}, x array<long>, cached array<double>")


def clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             width: int = WIDTH, count: int = CENTROIDS, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    whole = vectors.where((F.size(vector) == width) & finite(vector)).select(
        F.col(key).alias("id"), floored(vector, scale).alias("x"))
    centers = _starts(whole, count)
    out = (f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
           "centroid_sha256 string")
    if not len(centers):
        return spark.createDataFrame([], out).withColumnRenamed("id", key)
    simplex = Simplex(centers)
    rows = stored(_with_distances(whole, simplex, width, kind))

    def found(batch: pa.RecordBatch, at: int, centers: np.ndarray):
        x = matrix(batch.column(at), width)
        cached = matrix(batch.column(at + 1), len(simplex.pivots), np.float64)
        return x, *nearest(x, cached, centers, simplex)[:2]

    for _ in range(rounds):
        def sums(batches: Iterator[pa.RecordBatch], centers=centers) -> Iterator[pa.RecordBatch]:
            total = Sums()
            for batch in together(batches):
                x, cluster, _ = found(batch, 0, centers)
                for c in np.unique(cluster).tolist():
                    total.add(c, x[cluster == c])
            yield from total.rows()

        moved = centers.copy()
        for c, (n, total) in Sums.collect(
                map_batches(rows.select("x", "cached"), sums, Sums.SCHEMA)).items():
            moved[c] = [t // n for t in total]
        centers = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in together(batches):
            _, cluster, least = found(batch, 1, centers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()),
                 pa.array([min(d, LONG) for d in least.tolist()], pa.int64())],
                names=["id", "cluster", "distance"])

    placed = stored(map_batches(rows, assign, f"id {kind}, cluster int, distance long"))
    spent = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    every = min(sum(spent.values()), LONG)
    named = spark.createDataFrame(
        [(c, min(d, LONG), every, hashlib.sha256(
            ",".join(map(str, centers[c].tolist())).encode()).hexdigest())
         for c, d in spent.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return placed.join(F.broadcast(named), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
