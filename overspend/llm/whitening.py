"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Counts, sums and the scatter are partial sums of each task, one row per dimension, added up by Spark; only matrices of dimension x dimension reach
the driver. There the scatter V, with its rows and columns in pivot order, becomes L times L transposed. Rotations of pairs of columns of L make the columns
orthogonal without changing that product: their squared norms are the eigenvalues, the normalised columns the components.
The factor has as many columns as the scatter has rank, so directions without variance get no component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import written
from overspend.llm.vectors import map_arrow, matrix, slices

ROWS = 4096
#: A pivot below this share of the largest variance is rounding.
RANK_TOLERANCE = 1e-12
SWEEPS = 60
LIMIT = 1 << 62


def pivoted_cholesky(v: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(L, pivots): ``v[pivots][:, pivots] = L @ L.T``, L lower trapezoidal with one column per unit of rank, largest pivots first."""
    work, size = np.array(v, np.float64), len(v)
    pivots, factor = np.arange(size), np.zeros((size, size))
    floor = tolerance * max(np.diag(work).max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(np.argmax(np.diag(work)[k:]))
        if work[p, p] <= floor:
            return factor[:, :k], pivots
        for a in (work, factor):
            a[[k, p]] = a[[p, k]]
        work[:, [k, p]] = work[:, [p, k]]
        pivots[[k, p]] = pivots[[p, k]]
        factor[k, k] = np.sqrt(work[k, k])
        factor[k + 1:, k] = work[k + 1:, k] / factor[k, k]
        work[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, pivots


def jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """The factor with its columns rotated, pair by pair, until all are orthogonal to working precision.

    A sweep meets every pair once, in rounds of disjoint pairs (the circle method), and each round is one array operation.
    """
    a = np.array(factor, np.float64)
    size = a.shape[1] + a.shape[1] % 2
    if size > a.shape[1]:
        a = np.hstack([a, np.zeros((len(a), 1))])
    circle, limit = np.arange(size), 4 * np.finfo(float).eps
    for _ in range(sweeps if size else 0):
        worst = 0.0
        for _ in range(size - 1):
            left, right = circle[:size // 2], circle[size // 2:][::-1]
            x, y = a[:, left], a[:, right]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(xx * yy)
            off = np.divide(np.abs(xy), scale, out=np.zeros_like(xy), where=scale > 0)
            worst, turn = max(worst, off.max()), off > limit
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            a[:, left], a[:, right] = c * x - s * y, s * x + c * y
            circle = np.r_[circle[0], circle[-1], circle[1:-1]]
        if worst <= limit:
            break
    return a[:, :factor.shape[1]]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns; as many as the rank of ``v``."""
    factor, pivots = pivoted_cholesky(v)
    rotated = jacobi(factor)
    values = (rotated * rotated).sum(0)
    order = np.argsort(-values, kind="stable")
    vectors = np.zeros_like(rotated)
    vectors[pivots] = rotated
    return values[order], vectors[:, order] / np.sqrt(values[order])


@dataclass
class Whitening:
    """Count, exact sums, eigenvalues, components and total variance of the distinct vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    fill: int

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: in 64-bit numbers, or in numbers of any length where those could overflow."""
        top = max([int(np.abs(x).max(initial=0)) * self.n, *(abs(s) for s in self.sums)], default=0)
        kind = np.int64 if top < LIMIT // 2 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])


def _batches(batches: Iterator[pa.RecordBatch], width: int, fill: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, ROWS):
            yield part, matrix(part.column(part.schema.names.index("x")), width, fill)


def _scatter(rows: DataFrame, width: int, fill: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the products of each row's ``size`` numbers with each other, one partial matrix per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((size, size))
        for _, x in _batches(batches, width, fill):
            y = of(x)
            total += y.T @ y
        i, j = np.triu_indices(size)
        yield {"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]}

    out = np.zeros((size, size))
    for row in map_arrow(rows.select("x"), run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row.i, row.j] = out[row.j, row.i] = row.v
    return out


def fit(distinct: DataFrame, fill: int = 0) -> Whitening | None:
    """Fit to rows ``x`` (whole numbers), each counted once; None without rows. Two passes: sums, then the centred scatter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            column = batch.column(0)
            width = int(np.max(np.asarray(column.value_lengths()), initial=0))
            # What is summed is the difference from the fill number, which a shorter vector's missing components do not change.
            y = matrix(column, width, fill) - fill
            wide = int(np.abs(y).max(initial=0)) * max(len(y), 1) >= LIMIT
            yield {"d": [-1, *range(width)], "s": [len(y), *(int(s) for s in (y.astype(object) if wide else y).sum(0))]}

    found = map_arrow(distinct.select("x"), run, "d int, s decimal(38,0)").groupBy("d").agg(F.sum("s").alias("s")).orderBy("d").collect()
    if not found or not int(found[0].s):
        return None
    n = int(found[0].s)
    plain = Whitening(n, [int(row.s) + n * fill for row in found[1:]], np.zeros(0), np.zeros((0, 0)), 0.0, fill)
    v = _scatter(distinct, plain.width, fill, plain.centred, plain.width) / n
    values, vectors = eigen(v)
    return Whitening(n, plain.sums, values, vectors, float(np.trace(v)), fill)


def identity_error(distinct: DataFrame, fitted: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured over all rows."""
    width, fill = fitted.width, fitted.fill

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(k)
        for _, x in _batches(batches, width, fill):
            total += fitted.whiten(x, k).sum(0)
        yield {"d": np.arange(k, dtype=np.int32), "s": total}

    means = np.zeros(k)
    for row in map_arrow(distinct.select("x"), run, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).collect():
        means[row.d] = row.s / fitted.n
    covariance = _scatter(distinct, width, fill, lambda x: fitted.whiten(x, k) - means, k) / fitted.n
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each vector once, written. Equal rows are dropped in their tasks first, so a frequent vector is one row per task."""
    return written(rows.select("x").where("x is not null").distinct(), "whitening-fit")


RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = 16, fill: int = 0) -> DataFrame:
    """The first ``components`` whitened numbers of each row (``id``, ``x``), fitted on the distinct vectors among them.

    One row per row and component. ``deviation`` is the sum over dimensions of (n * x - sum)^2, exact; null where it does not fit 64 bits.
    There are fewer components where the vectors have a smaller rank, so none at all for one vector or for equal ones.
    Missing components of shorter vectors count as ``fill``. Rows with a null vector are left out; null ids and repeated rows are kept, each
    with its rows. Other columns are ignored. An empty table gives no rows.
    """
    stored = written(rows.where("x is not null").select("id", "x"), "whitening-rows")
    distinct = distinct_vectors(stored)
    fitted = fit(distinct, fill)
    k = 0 if fitted is None else min(components, len(fitted.values))
    if not k:
        return stored.sparkSession.createDataFrame([], RESULT)
    error = identity_error(distinct, fitted, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shares = fitted.values[:k] / fitted.trace
        for part, x in _batches(batches, fitted.width, fill):
            y = fitted.deviations(x)
            if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * fitted.width >= LIMIT:
                y = y.astype(object)
            squares = [int(s) if s < 1 << 63 else None for s in (y * y).sum(1).tolist()]
            many = len(x) * k
            yield {"id": part.column(part.schema.names.index("id")).take(pa.array(np.repeat(np.arange(len(x)), k))),
                   "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), "n": np.full(many, fitted.n),
                   "deviation": pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                   "whitened": fitted.whiten(x, k).ravel(), "explained": np.tile(shares, len(x)), "identity_error": np.full(many, error)}

    return map_arrow(stored, run, RESULT)
