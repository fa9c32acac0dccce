"""What the operators on embeddings share: whole-number vectors and exact sums of them."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wirecount.llm.common import map_batches

#: Largest long; sums of products below half of it are taken in 64-bit integers.
LONG = (1 << 63) - 1
#: Rows that a worker works on at a time, whatever the size of the Arrow batches it gets.
ROWS = 4096


def finite(vector: str | Column) -> Column:
    """Whether a vector is there and none of its entries is null, infinite or no number."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    inf = float("inf")

    def good(c):
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (c != inf) & (c != -inf)

    return F.coalesce(F.forall(vector, good), F.lit(False))


def floored(vector: str | Column, scale: int) -> Column:
    """``floor(scale * c)`` of every entry as a double; beyond the range of a long its end."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long"))


def matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def narrowest(most: int) -> np.dtype:
    """The smallest kind of whole numbers that holds entries of this size."""
    return next(np.dtype(f"<i{size}") for size in (1, 2, 4, 8) if most < 1 << 8 * size - 1
                or size == 8)


def packed(rows: DataFrame, vector: str, width: int, kind: np.dtype) -> DataFrame:
    """Vectors of ``width`` entries as bytes in a column ``x``: read again many times, they take a
    fraction of the time that arrays take."""
    size = width * kind.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = np.ascontiguousarray(matrix(batch.column(0), width).astype(kind))
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * size
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer(offsets), pa.py_buffer(data)])], names=["x"])

    return map_batches(rows.select(vector), run, "x binary")


def unpacked(column: pa.Array, width: int, kind: np.dtype) -> np.ndarray:
    """Vectors back from their bytes, as longs."""
    bytes_ = b"".join(column.to_pylist())
    return np.frombuffer(bytes_, kind).reshape(-1, width).astype(np.int64)


def together(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def largest(x: np.ndarray) -> int:
    """The largest size of an entry, as a number of any length."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def added(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as numbers of any length."""
    if largest(x) * len(x) <= LONG:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def squares(x: np.ndarray) -> np.ndarray:
    """Exact sums of squares of the rows: longs, or numbers of any length where they may not fit."""
    if largest(x) ** 2 * x.shape[1] > LONG:
        x = x.astype(object)
    return (x * x).sum(axis=1)


class Sums:
    """Counts and exact sums of vectors by group, a bounded number of groups in one task."""

    SCHEMA = "part int, at int, n long, total decimal(38,0)"

    def __init__(self):
        self.n, self.total = {}, {}

    def add(self, group: int, x: np.ndarray) -> None:
        if not len(x):
            return
        self.n[group] = self.n.get(group, 0) + len(x)
        self.total[group] = self.total.get(group, 0) + added(x)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for g, total in self.total.items():
            k = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * k, pa.int32()), pa.array(range(k), pa.int32()),
                 pa.array([self.n[g]] * k, pa.int64()),
                 pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))],
                names=["part", "at", "n", "total"])

    @staticmethod
    def collect(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
        """Per group the count and the sums by dimension; groups and dimensions are few."""
        found: dict[int, tuple[int, list[int]]] = {}
        summed = rows.groupBy("part", "at").agg(F.sum("n").alias("n"),
                                                F.sum("total").alias("total"))
        for r in sorted(summed.collect(), key=lambda r: (r["part"], r["at"])):
            found.setdefault(r["part"], (r["n"], []))[1].append(int(r["total"]))
        return found


def column_sums(rows: DataFrame, vector: str, width: int) -> tuple[int, list[int], int]:
    """How many vectors of ``width`` entries there are, the sums of their dimensions, and the
    size of the largest entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = Sums(), 0
        for batch in together(batches):
            x = matrix(batch.column(0), width)
            sums.add(0, x)
            most = max(most, largest(x))
        for part in sums.rows():
            yield part.append_column("most", pa.array([min(most, LONG)] * width, pa.int64()))

    found = map_batches(rows.select(vector), run, Sums.SCHEMA + ", most long").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")).collect()
    found.sort(key=lambda r: r["at"])
    if not found:
        return 0, [], 0
    return found[0]["n"], [int(r["total"]) for r in found], max(r["most"] for r in found)
