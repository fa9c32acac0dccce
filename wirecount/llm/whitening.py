"""Whitening of embeddings with leading components found by a Jacobi-Davidson iteration.

The covariance is never formed. Its product with a few vectors is one pass over the fit list:
every task centres its rows, ``(n * x - S) / n`` from exact whole numbers, multiplies them with
the vectors and their transpose with the result, and sends one small matrix, which is added up
in a shuffle.

On the driver stand only blocks of a few columns as long as a vector:

1. Rayleigh-Ritz: the search space is rotated to its best approximations of the leading
   components. Each has a residual.
2. Locking: leading components whose residual has reached double precision are taken out of the
   search space, in order.
3. Correction: for the other ones, and as many after them, ``(1 - uu')(V - e)(1 - uu') t = -r``
   is solved roughly by a few steps of MINRES, all of them in step, so that one pass serves all.
   What comes out widens the search space. A space that has grown too wide is cut back to its
   best directions.

Defined results: rows whose vector is null, or holds a null, infinite or not-a-number entry, are
dropped; all others stay, repeated ones and those without identifier too. The dimension is the
length that most of them have (the longer one in a tie). Rows of another length are not in the fit
list; their ``deviation`` and ``whitened`` are null. Components whose eigenvalue is zero to
double precision have no unit variance and are left out, so identical vectors alone give no
rows, as do an empty table and vectors of length 0. Among equal eigenvalues any basis may come
out. A deviation beyond the range of a long is null. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wirecount.llm.common import map_batches, stored
from wirecount.llm.vectors import LONG, column_sums, finite, floored, largest, matrix, narrowest, \
    packed, squares, together, unpacked

COMPONENTS, SCALE = 4, 256
#: Steps of the inner solver, and the share of a residual at which it may stop earlier.
INNER, ENOUGH = 4, 0.05
#: A residual counts as zero below this many units of the last place of the largest eigenvalue.
PLACES = 64
EPS = np.finfo(float).eps
Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns that span what ``new`` adds to the given orthonormal ones."""
    out = np.empty((len(new), 0))
    old = np.column_stack([*against]) if against else out
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for basis in (old, out):
                column = column - basis @ (basis.T @ column)
            rest = np.linalg.norm(column)
            if rest < 1e-10:
                break
            column = column / rest
        else:
            out = np.column_stack([out, column])
    return out


def _corrections(product: Product, values: np.ndarray, ritz: np.ndarray, residuals: np.ndarray,
                 locked: np.ndarray) -> np.ndarray:
    """A few MINRES steps on the projected correction equation of every Ritz pair, in step."""
    inside = np.column_stack([locked, ritz])

    def outside(x):
        x = x - inside @ (inside.T @ x)
        return x - inside @ (inside.T @ x)

    start = outside(-residuals)
    sizes = np.linalg.norm(start, axis=0)
    some = np.flatnonzero(sizes > 0)
    start, sizes, values = start[:, some], sizes[some], values[some]
    if not len(some):
        return start
    spans = [start / sizes]
    tri = np.zeros((len(some), INNER + 1, INNER))
    answers = np.zeros_like(start)
    for step in range(INNER):
        now = spans[-1]
        image = outside(product(now) - values * now)
        for back, old in enumerate(spans):
            dots = (old * image).sum(axis=0)
            if back >= step - 1:
                tri[:, back, step] = dots
            image = image - old * dots
        for old in spans:
            image = image - old * (old * image).sum(axis=0)
        width = np.linalg.norm(image, axis=0)
        tri[:, step + 1, step] = width
        left = np.zeros(len(some))
        for i, size in enumerate(sizes):
            small = tri[i, :step + 2, :step + 1]
            wish = np.zeros(step + 2)
            wish[0] = size
            y = np.linalg.lstsq(small, wish, rcond=None)[0]
            answers[:, i] = sum(y[k] * spans[k][:, i] for k in range(step + 1))
            left[i] = np.linalg.norm(small @ y - wish) / size
        if (left < ENOUGH).all():
            break
        spans.append(np.divide(image, width, out=np.zeros_like(image), where=width > 0))
    return answers


def leading(product: Product, width: int, wanted: int, seed: int = 1) \
        -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric product and their unit vectors, in columns."""
    wanted = min(wanted, width)
    aim = min(2 * wanted, width)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((width, min(2 * aim, width))))
    image = product(basis)
    locked = np.empty((width, 0))
    most, best, stale, top = 6 * aim, np.inf, 0, 0.0
    while True:
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        full = basis.shape[1] + locked.shape[1] == width
        rest = image - basis * values
        rest -= locked @ (locked.T @ rest)
        sizes = np.linalg.norm(rest, axis=0)
        top = max(top, values[0])
        need = wanted - locked.shape[1]
        goal = PLACES * EPS * top
        # Rounding in the products can stand above the goal: no better for long is as good.
        worst = sizes[:need].max()
        best, stale = (worst, 0) if worst < best / 2 else (best, stale + 1)
        if full or (stale >= 3 and worst <= 1e4 * goal):
            goal = np.inf
        done = 0
        while done < need and sizes[done] <= goal:
            done += 1
        if done:
            locked = np.column_stack([locked, basis[:, :done]])
            basis, image = basis[:, done:], image[:, done:]
            values, rest = values[done:], rest[:, done:]
            best, stale = np.inf, 0
        if locked.shape[1] == wanted:
            break
        aimed = min(aim, basis.shape[1])
        if basis.shape[1] + aimed > max(most, 2 * aim) and not full:
            basis, image = basis[:, :most // 2], image[:, :most // 2]
        new = _corrections(product, values[:aimed], basis[:, :aimed], rest[:, :aimed], locked)
        new = _orthonormal(new, locked, basis)
        if not new.shape[1]:
            # Nothing to add in the directions asked for: any other one.
            new = _orthonormal(np.random.default_rng(seed + basis.shape[1]).standard_normal(
                (width, aim)), locked, basis)
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    # One true product decides on order and values.
    locked = np.linalg.qr(locked)[0]
    small = locked.T @ product(locked)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], locked @ turn[:, ::-1]


class Centre:
    """Number and sums of the fit list; centres whole-number rows exactly before rounding once."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def spread(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``: longs where they fit, numbers of any length elsewhere."""
        if largest(x) * self.n + max(map(abs, self.sums)) <= LONG:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n


def covariance_product(fit: DataFrame, centre: Centre, kind: np.dtype) -> Product:
    """The covariance of the packed fit list times a block of columns, one pass each."""
    width = len(centre.sums)

    def product(block: np.ndarray) -> np.ndarray:
        columns = [f"c{i}" for i in range(block.shape[1])]
        block = np.ascontiguousarray(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(block)
            for batch in together(batches):
                x = centre.centred(unpacked(batch.column(0), width, kind))
                total += x.T @ (x @ block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), *(pa.array(c) for c in total.T)],
                names=["at", *columns])

        schema = ", ".join(["at int", *(f"{c} double" for c in columns)])
        parts = map_batches(fit, run, schema).groupBy("at").agg(
            *(F.sum(c).alias(c) for c in columns))
        out = np.zeros_like(block)
        for row in parts.collect():
            out[row["at"]] = [row[c] for c in columns]
        return out / centre.n

    return product


def traced(fit: DataFrame, centre: Centre, kind: np.dtype) -> float:
    """The trace of the covariance: mean squared distance from the centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in together(batches):
            x = centre.centred(unpacked(batch.column(0), len(centre.sums), kind))
            yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum())])], names=["v"])

    return (map_batches(fit, run, "v double").agg(F.sum("v")).first()[0] or 0.0) / centre.n


def whitened(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row per remaining row and component: ``key, component, n, deviation, whitened,
    explained, identity_error``."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    out = (f"id {kind}, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    rows = stored(vectors.where(finite(vector)).select(
        F.col(key).alias("id"), floored(vector, scale).alias("x")))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = lengths.first()
    width = first["d"] if first else 0
    fit = stored(rows.where(F.size("x") == width).select("x").distinct())
    n, sums, most = column_sums(fit, "x", width) if width else (0, [], 0)
    centre = Centre(n, sums)
    values = np.empty(0)
    if n:
        kind = narrowest(most)
        fit = stored(packed(fit, "x", width, kind))
        product = covariance_product(fit, centre, kind)
        trace = traced(fit, centre, kind)
        if trace > 0:
            values, axes = leading(product, width, components)
            keep = values > width * EPS * max(values[0], 0.0) * 8
            values, axes = values[keep], axes[:, keep]
    if not len(values):
        return spark.createDataFrame([], out).withColumnRenamed("id", key)
    axes = np.ascontiguousarray(axes / np.sqrt(values))
    # The covariance of what comes out, by one more pass.
    inner = axes.T @ product(axes)
    error = float(np.abs(inner - np.eye(len(values))).max())
    explained = values / trace
    m = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in together(batches):
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            fits = np.flatnonzero(sizes == width)
            x = matrix(batch.column(1).take(pa.array(fits)), width)
            spread = centre.spread(x)
            deviation = [None] * len(sizes)
            white = np.full((len(sizes), m), np.nan)
            for i, v in zip(fits.tolist(), squares(spread).tolist()):
                deviation[i] = v if v <= LONG else None
            white[fits] = (spread.astype(np.float64) / n) @ axes
            flat = white.ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), m))),
                 pa.array(np.tile(np.arange(1, m + 1), len(sizes)), pa.int32()),
                 pa.array(np.full(len(flat), n), pa.int64()),
                 pa.array([d for d in deviation for _ in range(m)], pa.int64()),
                 pa.array(flat, mask=np.isnan(flat)),
                 pa.array(np.tile(explained, len(sizes))),
                 pa.array(np.full(len(flat), error))],
                names=["id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return map_batches(rows, run, out).withColumnRenamed("id", key)
