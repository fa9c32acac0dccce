"""Centroid clustering against plain whole-number k-means."""

import hashlib
import math

import numpy as np
import pytest

from tests.conftest import SMALL
from wirecount.llm import centroids


def by_hand(rows, width, count, rounds, scale=64):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v):
            kept.append((vec_id, [math.floor(scale * float(c)) for c in v]))

    def rank(r):
        named = r[0] is not None
        return (not named, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if named else "", r[1])

    centers = [x for _, x in sorted(kept, key=rank)[:count]]

    def placed():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centers))
                for _, x in kept]

    for _ in range(rounds):
        at = placed()
        for k in range(len(centers)):
            own = [x for (_, x), (_, c) in zip(kept, at) if c == k]
            if own:
                centers[k] = [sum(col) // len(own) for col in zip(*own)]
    at = placed()
    sums = [sum(d for d, c in at if c == k) for k in range(len(centers))]
    return sorted(((i, c, d, sums[c], sum(sums), hashlib.sha256(
        ",".join(map(str, centers[c])).encode()).hexdigest())
        for (i, _), (d, c) in zip(kept, at)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = centroids.clusters(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                           "centroid_sha256"]
    assert rows_of(got) == by_hand(rows, 64, 16, 3)


def test_odd_vectors_ties_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (1, [-0.5, 0.25]), (None, [3.0, -3.0]),
            (2, None), (3, []), (4, [1.0]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [0.0, -0.0]), (9, [1.0, 1.0]), (10, [-1.0, -1.0])] + [
            (i, [i % 3 / 4, i % 5 / 4]) for i in range(20, 60)]
    df = spark.createDataFrame([(*r, 1, "x", [2.0]) for r in rows],
                               "vec_id long, embedding array<double>, id int, cluster string, "
                               "cached array<double>")
    for count in (1, 4, 100):
        got = centroids.clusters(df.repartition(5), width=2, count=count)
        assert rows_of(got) == by_hand(rows, 2, count, 3)
    assert centroids.clusters(df.where("false"), width=2).count() == 0
    few = df.where("vec_id < 2")
    assert rows_of(centroids.clusters(few, width=2)) == by_hand(rows[:3], 2, 16, 3)


def test_entries_that_overflow_products_stay_exact(spark):
    rows = [(i, [(-1) ** i * 1e15 * (i + 1), 7.0 * i]) for i in range(30)] + [(99, [1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = centroids.clusters(df, width=2, count=3)
    top = (1 << 63) - 1
    assert len(rows_of(got)) == 31
    assert all(0 <= r["distance"] <= top and r["inertia"] == top for r in got.collect())


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_the_true_distance_and_skip_some(seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(-500, 500, (12, 20)) * (seed != 3)
    if seed == 4:
        centers[:] = centers[0]
    x = centers[rng.integers(0, 12, 400)] + rng.integers(-20, 20, (400, 20)) + 10 ** seed
    simplex = centroids.Simplex(centers)
    cached = simplex.cached(x)
    lower, upper = simplex.bounds(cached, simplex.cached(centers))
    true = np.column_stack([centroids.distances(x, c[None]) for c in centers])
    assert (lower <= true).all() and (true <= upper).all()
    cluster, least, taken = centroids.nearest(x, cached, centers, simplex)
    assert (cluster == true.argmin(axis=1)).all() and (least == true.min(axis=1)).all()
    if seed not in (3, 4):
        assert len(simplex.pivots) > 4 and taken < 0.6 * true.size
