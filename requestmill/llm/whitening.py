"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, so that equal vectors are equal and sums exact. Spark sums the scatter
of the distinct vectors, centred before it multiplies; a d x d matrix is all that reaches the driver.
There pivoted Cholesky splits it, and Jacobi rotations make the triangular factor's columns
orthogonal: their squared norms are the eigenvalues and, at length one, they are the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import written

SCALE = 256
LARGEST = 2**62  # entries of a greater size are no longer whole numbers of 64 bits
ROWS = 2_048  # of a batch that is multiplied at once
LONGEST = 2**63 - 1


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * c) of each entry c of ``embedding``.

    Vectors that are null, empty or hold a null, a NaN or an infinity go, as do those with entries
    beyond 64 bits and those of another length than most (of equally many, the longer).
    """
    numbers = F.col("embedding").cast("array<double>")
    fits = F.forall(numbers, lambda c: c.isNotNull() & (F.abs(c * scale) < float(LARGEST)) & ~F.isnan(c))
    rows = embeddings.where(numbers.isNotNull() & (F.size(numbers) > 0) & fits).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(numbers, lambda c: F.floor(c * scale).cast("long")).alias("x"),
    )
    rows = written(rows, "quantised")
    # one row for each length that occurs; the two most frequent are asked for
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows if usual is None else rows.where(F.size("x") == usual["d"])


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column as a matrix of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


@dataclass(frozen=True)
class Centre:
    """n vectors with sums S: S / n as whole parts and rests, so that large means lose nothing."""

    n: int
    sums: tuple[int, ...]

    def of(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return _exact(x, whole, 1).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; null beyond 64 bits."""
        off = _exact(x, list(self.sums), self.n)
        top = int(np.abs(off).max(initial=0))
        if top * top * off.shape[1] > LONGEST:
            off = off.astype(object)
        found = [int(v) for v in (off * off).sum(axis=1)]
        return [v if v <= LONGEST else None for v in found]


def _exact(x: np.ndarray, off: list[int], times: int) -> np.ndarray:
    """times * x - off in 64 bits where that is certain to fit, else in Python's numbers."""
    top = int(np.abs(x).max(initial=0)) * times + max(map(abs, off), default=0)
    if top <= LONGEST:
        return x * times - np.array(off, np.int64)
    return x.astype(object) * times - np.array(off, object)


def centre(fit: DataFrame) -> Centre | None:
    """Exact sums of each dimension; None without a vector. One row for each dimension."""
    each = fit.select(F.posexplode("x").alias("k", "v")).groupBy("k")
    rows = each.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["k"])
    return Centre(rows[0]["n"], tuple(int(r["s"]) for r in rows))


def _products(rows: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Lower triangle of the sum of r r' over all rows, a row for each pair of dimensions."""
    total = None
    for r in rows:
        part = r.T @ r
        total = part if total is None else total + part
    if total is not None:
        i, j = np.tril_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
            ["i", "j", "v"],
        )


def _summed(products: DataFrame, size: int) -> np.ndarray:
    """size x size numbers, summed by Spark."""
    found = np.zeros((size, size))
    for i, j, v in products.groupBy("i", "j").agg(F.sum("v")).collect():
        found[i, j] = found[j, i] = v
    return found


def covariance(fit: DataFrame, mid: Centre) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _products(mid.of(_matrix(b.column(0))) for b in _pieces(batches))

    return _summed(fit.select("x").mapInArrow(run, "i int, j int, v double"), len(mid.sums)) / mid.n


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): a[order][:, order] = L L', the largest remaining diagonal entry first.

    Ends where what remains is rounding, so L has as many columns as ``a`` has rank.
    """
    a = a.copy()
    size = len(a)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = 16 * size * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return factor[:, :k], order
        for swapped in (a, a.T, factor):
            swapped[[k, p]] = swapped[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = math.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times rotations, so that its columns are orthogonal to double precision."""
    columns = factor.T.copy()  # rows of memory
    count = len(columns)
    limit = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for p in range(count - 1):
            for q in range(p + 1, count):
                x, y = columns[p], columns[q]
                a, b, c = float(x @ x), float(y @ y), float(x @ y)
                if abs(c) <= limit * math.sqrt(a) * math.sqrt(b):
                    continue
                rotated = True
                zeta = (b - a) / (2 * c)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.hypot(1.0, zeta))
                cos = 1 / math.hypot(1.0, t)
                columns[p], columns[q] = cos * x - cos * t * y, cos * t * x + cos * y
        if not rotated:
            break
    return columns.T


@dataclass(frozen=True)
class Whitening:
    """Components as columns, by falling eigenvalue, and the covariance's trace."""

    mid: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def of(self, x: np.ndarray, most: int) -> np.ndarray:
        """Whitened rows, a column for each component."""
        return self.mid.of(x) @ self.components[:, :most] / np.sqrt(self.eigenvalues[:most])


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, those beyond its rank left out.

    Each component's largest entry is positive.
    """
    factor, order = pivoted_cholesky(v)
    columns = jacobi(factor)
    norms = np.linalg.norm(columns, axis=0)
    falling = np.argsort(-norms, kind="stable")
    found = np.empty_like(columns)
    found[order] = columns / norms
    found = found[:, falling]
    if found.size:
        top = np.abs(found).argmax(axis=0)
        found *= np.sign(found[top, np.arange(found.shape[1])])
    return norms[falling] ** 2, found


def fitted(fit: DataFrame) -> Whitening | None:
    """The whitening of distinct vectors; None without any, no components if all are equal."""
    mid = centre(fit)
    if mid is None:
        return None
    v = covariance(fit, mid)
    values, components = eigen(v)
    return Whitening(mid, components, values, float(np.trace(v)))


def identity_error(fit: DataFrame, model: Whitening, most: int) -> float:
    """Largest entry of the whitened vectors' covariance less the identity; centred before multiplying."""
    count = min(most, len(model.eigenvalues))

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for b in _pieces(batches):
            total += model.of(_matrix(b.column(0)), most).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(count), pa.int32()), pa.array(total)], ["k", "s"])

    sums = np.zeros(count)
    for k, s in fit.select("x").mapInArrow(means, "k int, s double").groupBy("k").agg(F.sum("s")).collect():
        sums[k] = s
    mean = sums / model.mid.n

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _products(model.of(_matrix(b.column(0)), most) - mean for b in _pieces(batches))

    found = _summed(fit.select("x").mapInArrow(centred, "i int, j int, v double"), count) / model.mid.n
    return float(np.abs(found - np.eye(count)).max(initial=0.0))


def _whiten_batches(model: Whitening, most: int, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = min(most, len(model.eigenvalues))
        explained = model.eigenvalues[:count] / model.trace
        for b in _pieces(batches):
            x = _matrix(b.column(1))
            rows = len(x)
            again = np.repeat(np.arange(rows), count)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(again)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.mid.n)),
                    pa.array(model.mid.deviations(x), pa.int64()).take(pa.array(again)),
                    pa.array(model.of(x, most).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whitened(embeddings: DataFrame, most: int = 4) -> DataFrame:
    """A row for each vector that ``quantised`` keeps and each of the first ``most`` components.

    The fit is over each distinct vector once, so repeated rows get equal results and change none.
    A null vec_id stays null. Components of no variance are left out: no rows where all vectors are
    equal, or where there is none. Other columns are not read. deviation is null beyond 64 bits.
    """
    rows = quantised(embeddings)
    fit = written(rows.select("x").distinct(), "distinct-vectors")
    model = fitted(fit)
    if model is None or not len(model.eigenvalues):
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(fit, model, most)
    return rows.mapInArrow(_whiten_batches(model, most, error), SCHEMA)
