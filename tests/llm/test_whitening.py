"""Whitening against a full eigenvalue decomposition."""

import math

import numpy as np
import pytest

from tests.conftest import SMALL
from wirecount.llm import whitening


def by_hand(rows, width, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept if len(x) == width})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array([[n * a - s for a, s in zip(v, sums)] for v in fit], object).astype(float) / n
    values, axes = np.linalg.eigh(x.T @ x / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for k, (i, v) in enumerate(kept):
        if len(v) == width:
            far = [n * a - s for a, s in zip(v, sums)]
            out[k] = (i, sum(f * f for f in far),
                      np.array([f / n for f in far]) @ axes / np.sqrt(values))
    return n, values, (x * x).sum() / n, out


def compare(df, rows, width, components=4):
    n, values, trace, want = by_hand(rows, width, components)
    got = {}
    for r in df.collect():
        got.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    signs = {}
    for i, far, white in want.values():
        mine = got[(i, far)]
        assert {r["component"] for r in mine} == set(range(1, len(values) + 1))
        for r in mine:
            assert r["n"] == n and r["identity_error"] <= 1e-9
            k = r["component"] - 1
            assert abs(r["explained"] * trace / values[k] - 1) < 1e-9
            if abs(white[k]) > 1e-3:
                signs.setdefault(k, r["whitened"] / white[k] > 0)
            assert abs(r["whitened"] - white[k] * (1 if signs.get(k) else -1)) < 1e-7
    assert sum(map(len, got.values())) == len(values) * len(want)


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = whitening.whitened(df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    compare(got, rows, 64)


def test_odd_vectors_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate((rng.standard_normal((60, 5)) * [9, 5, 3, 2, 1]).tolist())]
    rows += [(3, rows[3][1])] * 40 + [(None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    odd = [(100, None), (101, [1.0, nan, 1.0, 1.0, 1.0]), (102, [inf] * 5),
           (103, [None, 1.0, 1.0, 1.0, 1.0])]
    other = [(104, [1.0, 2.0]), (105, [])]

    def table(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                     "vec_id long, embedding array<double>, x string, at int")

    compare(whitening.whitened(table(rows + odd).repartition(7)), rows + odd, 5)
    got = whitening.whitened(table(rows + odd + other))
    short = got.where("vec_id IN (104, 105)").collect()
    assert len(short) == 8 and all(r["deviation"] is None and r["whitened"] is None for r in short)
    compare(got.where("vec_id IS NULL OR vec_id < 104"), rows + odd, 5)
    assert whitening.whitened(table(odd)).count() == 0
    assert whitening.whitened(table(rows).where("false")).count() == 0
    assert whitening.whitened(table([rows[0]] * 3)).count() == 0
    assert whitening.whitened(table([(1, []), (2, [])])).count() == 0


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(6)
    two = rng.integers(-50, 50, (40, 2)) / 4
    rows = list(enumerate(np.column_stack([two, two.sum(axis=1), two[:, 0] * 2]).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    compare(whitening.whitened(df), rows, 4, 2)


def test_deviation_is_exact_far_from_zero(spark):
    rows = [(i, [1e9 + i / 256, 3.0 - i]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(whitening.whitened(df, components=1), rows, 2, 1)
    rows = [(i, [4e15 * (-1) ** i, float(i)]) for i in range(9)]
    far = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert all(r["deviation"] is None and r["whitened"] is not None for r in far.collect())


@pytest.mark.parametrize("scales", [
    np.ones(80), np.logspace(0, -6, 80), np.r_[np.ones(40), np.zeros(40)],
    np.r_[5, 5, 5, 1 + np.zeros(77)], np.ones(3), np.ones(1)])
def test_jacobi_davidson(scales):
    width = len(scales)
    x = np.random.default_rng(width).standard_normal((500, width)) * scales
    if width == 80 and scales[0] == 5:
        x = np.linalg.qr(x)[0] * scales  # three equal eigenvalues
    cov, passes = x.T @ x / len(x), []

    def product(block):
        assert block.shape[1] <= 16
        passes.append(block.shape[1])
        return cov @ block

    values, axes = whitening.leading(product, width, 4)
    true = np.linalg.eigvalsh(cov)[::-1][:4]
    assert np.allclose(values, true, rtol=0, atol=1e-13 * true[0])
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
    assert np.linalg.norm(cov @ axes - axes * values, axis=0).max() < 1e-13 * true[0]
    assert len(passes) < 100
