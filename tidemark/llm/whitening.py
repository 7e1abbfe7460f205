"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored

#: Longest vectors whose scatter, a square table of that side, is put together on the driver.
MOST_DIMENSIONS = 2_048
#: Entries of a batch that are multiplied at once.
CELLS_AT_ONCE = 4_000_000
#: Sums of whole numbers up to here are exact in double precision, and in 64-bit integers.
_EXACT_FLOAT, _EXACT_LONG = 1 << 53, 1 << 62


def whole_vectors(rows: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: ``floor(scale * c)`` of the entries of vectors without null or non-finite ones."""
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    sound = rows.select(F.col(id_col).alias("vec_id"), vector.alias("v"), odd.alias("odd")).where("v is not null and not odd")
    return sound.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min()), int(x.max()), 0) if x.size else 0


def _decimals(values) -> pa.Array:
    """Whole numbers as decimals; null beyond 38 digits."""
    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in map(int, values)], pa.decimal128(38, 0))


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension; one row per dimension and task is shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            n += len(x)
            total = [t + (int(hi) << 32) + int(lo) for t, hi, lo in zip(total, (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), _decimals(total)], ["i", "n", "total"])

    found = fit.mapInArrow(add, "i int, n bigint, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    total = {r["i"]: (r["n"], int(r["total"])) for r in found}
    return (total[0][0] if total else 0), [total[i][1] if total else 0 for i in range(d)]


def _products(y: np.ndarray) -> np.ndarray:
    """The exact sum of ``y[r, i] * y[r, j]`` over rows r, as Python's whole numbers."""
    d, top = y.shape[1], _largest(y) if y.dtype != object else max(map(abs, y.ravel().tolist()), default=0)
    out = np.zeros((d, d), object)
    if y.dtype != object and top * top < _EXACT_FLOAT:
        step = max(1, min(len(y) or 1, _EXACT_FLOAT // max(1, top * top)))
        for a in range(0, len(y), step):
            part = y[a : a + step].astype(np.float64)
            out += (part.T @ part).astype(np.int64).astype(object)
        return out
    y = y.astype(object)
    return out + y.T @ y


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    if _largest(x) < _EXACT_LONG and max(map(abs, centre), default=0) < _EXACT_LONG:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def _covariance(fit: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The covariance of the fit list with divisor n, each entry rounded once.

    Rows are centred on the whole numbers next to the means before they are
    multiplied, which keeps the products exact; what is left of the means, at
    most a half, is taken off exactly as well. So neither the order of rows nor
    a repeated task changes a digit.
    """
    d = len(total)
    centre = [(2 * s + n) // (2 * n) for s in total]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((d, d), object)
        for batch in batches:
            x = _matrix(batch, d)
            for a in range(0, len(x), max(1, CELLS_AT_ONCE // d)):
                out += _products(_centred(x[a : a + max(1, CELLS_AT_ONCE // d)], centre))
        i, j = np.triu_indices(d)
        # In two halves, as sums of products of the longest whole numbers exceed 38 digits.
        high, low = [v >> 64 for v in out[i, j]], [v & (1 << 64) - 1 for v in out[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(high), _decimals(low)], ["i", "j", "high", "low"])

    summed = fit.mapInArrow(multiply, "i int, j int, high decimal(38,0), low decimal(38,0)").groupBy("i", "j")
    found = summed.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    rest, out = [s - n * m for s, m in zip(total, centre)], np.zeros((d, d))
    for r in found:
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = (n * ((int(r["high"]) << 64) + int(r["low"])) - rest[i] * rest[j]) / (n * n)
    return out


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with ``L @ L.T == matrix`` for a positive semidefinite matrix: one column per pivot, as many as its rank.

    The largest diagonal entry left is the next pivot, so rows of L in the order of
    pivots form a triangle. It ends where what is left is rounding.
    """
    d = len(matrix)
    left, columns, free = np.diag(matrix).astype(float).copy(), [], np.ones(d, bool)
    least = d * np.finfo(float).eps * max(left.max(), 0.0) if d else 0.0
    for _ in range(d):
        pivot = int(np.argmax(np.where(free, left, -np.inf)))
        if not left[pivot] > least:
            break
        column = matrix[:, pivot].astype(float).copy()
        for earlier in columns:
            column -= earlier * earlier[pivot]
        column[~free] = 0.0
        column /= math.sqrt(left[pivot])
        column[pivot] = math.sqrt(left[pivot])
        free[pivot] = False
        left -= column * column
        columns.append(column)
    return np.array(columns).T if columns else np.zeros((d, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` rotated against each other until all are orthogonal, by falling norm.

    Squared norms are then the eigenvalues of ``factor @ factor.T`` and the columns,
    normalised, its eigenvectors. Pairs are taken in rounds of disjoint ones.
    """
    a = factor.astype(float).copy()
    r = a.shape[1]
    ring = list(range(r + r % 2))
    for _ in range(sweeps if r > 1 else 0):
        turned = False
        for _ in range(len(ring) - 1):
            pairs = [(p, q) for p, q in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1]) if max(p, q) < r]
            p, q = np.array([x[0] for x in pairs]), np.array([x[1] for x in pairs])
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            go = np.abs(gamma) > 4 * np.finfo(float).eps * np.sqrt(alpha * beta)
            if go.any():
                turned = True
                zeta = (beta[go] - alpha[go]) / (2 * gamma[go])
                tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cosine = 1 / np.hypot(1.0, tangent)
                a[:, p[go]] = cosine * x[:, go] - cosine * tangent * y[:, go]
                a[:, q[go]] = cosine * tangent * x[:, go] + cosine * y[:, go]
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if not turned:
            break
    return a[:, np.argsort(-(a * a).sum(axis=0), kind="stable")]


@dataclass
class Whitener:
    """n vectors, their exact sums, and of each component its unit vector (a row), eigenvalue and share of the variance."""

    n: int
    total: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def dimensions(self) -> int:
        return len(self.total)

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n * x - total``, exact."""
        if self.n * _largest(x) < _EXACT_LONG and max(map(abs, self.total), default=0) < _EXACT_LONG:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def deviations(self, u: np.ndarray) -> list[int]:
        """The exact sum of squares of each row of numerators."""
        if u.dtype != object and _largest(u) ** 2 * max(1, u.shape[1]) < _EXACT_LONG:
            return (u * u).sum(axis=1).tolist()
        return (u.astype(object) ** 2).sum(axis=1).tolist()

    def whitened(self, u: np.ndarray) -> np.ndarray:
        """The projections of each row of numerators, the same bit for bit whatever rows stand beside it.

        A matrix product may round a row otherwise in a batch of another size, so
        dimensions are added one by one.
        """
        y = (u if _largest(u) < _EXACT_FLOAT else u.astype(object)) / self.n
        scaled = self.components / np.sqrt(self.eigenvalues)[:, None]
        out = np.zeros((len(u), len(scaled)))
        for column, weights in zip(y.astype(np.float64).T, scaled.T):
            out += column[:, None] * weights
        return out


def fit_whitener(fit: DataFrame, d: int, most: int) -> Whitener:
    """The first ``most`` components of a table of distinct whole-number vectors ``x`` of length ``d``."""
    n, total = _sums(fit, d)
    if n == 0 or d == 0:
        return Whitener(n, total, np.zeros((0, d)), np.zeros(0), np.zeros(0))
    covariance = _covariance(fit, n, total)
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    values = (turned * turned).sum(axis=0)
    units = turned / np.sqrt(values)
    signs = np.where(units[np.abs(units).argmax(axis=0), np.arange(units.shape[1])] < 0, -1.0, 1.0) if units.size else np.ones(0)
    return Whitener(n, total, (units * signs).T[:most], values[:most], values[:most] / np.trace(covariance))


def _units(p: np.ndarray) -> list[int]:
    """The sums of the columns of ``p`` in units of ``2**-60``, to which entries are rounded down."""
    scaled = p * 2.0**20
    high = np.floor(scaled)
    low = np.floor((scaled - high) * 2.0**40)
    return [(int(a) << 40) + int(b) for a, b in zip(high.astype(np.int64).sum(axis=0), low.astype(np.int64).sum(axis=0))]


def _identity_error(fit: DataFrame, whitener: Whitener) -> float | None:
    """The largest entry of the whitened fit list's covariance less the identity; its mean is zero by construction.

    Products are added up as whole numbers, so that the order of rows changes no digit.
    """
    k, d = len(whitener.eigenvalues), whitener.dimensions
    if k == 0:
        return None
    i, j = (v.ravel() for v in np.indices((k, k)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [0] * (k * k)
        for batch in batches:
            w = whitener.whitened(whitener.numerators(_matrix(batch, d)))
            out = [a + b for a, b in zip(out, _units(w[:, i] * w[:, j]))]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(out)], ["i", "j", "total"])

    found = fit.mapInArrow(multiply, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    whole = whitener.n << 60
    return max(abs(int(r["total"]) - (whole if r["i"] == r["j"] else 0)) / whole for r in found)


def whiten(rows: DataFrame, most: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector and component.

    Vectors that are null or hold null or non-finite entries are left out; entries
    become ``floor(scale * c)`` (at the ends of 64 bits, the end). Each distinct
    whole-number vector counts once in the fit: ``n`` of them, their covariance
    with divisor n, its unit eigenvectors by falling eigenvalue, the largest entry
    of each positive. ``deviation`` is the exact sum of ``(n * x - sum)**2`` as a
    decimal, null beyond 38 digits. Repeated rows keep their rows; null ids stay.

    There are as many components as the covariance has rank, ``most`` at most: fewer
    vectors than that, constant ones, empty ones or an empty table give fewer rows
    or none. Vectors of another length than the most frequent one (the longer of
    equally frequent ones) are left out; longer than 2,048 raises a ValueError.
    Other columns are not read. Distinct vectors are found by a grouping with
    partial results, so copies of a hot vector meet as one row per task; only
    sums per pair of dimensions reach the driver.
    """
    x = whole_vectors(rows, scale, id_col, vector_col)
    out = "vec_id {}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double".format(x.schema["vec_id"].dataType.simpleString())
    common = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None or common["d"] == 0:
        return rows.sparkSession.createDataFrame([], out)
    d = common["d"]
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; at most {MOST_DIMENSIONS} are whitened")
    x = x.where(F.size("x") == d)
    fit = stored(x.select("x").distinct(), "whitening-fit")
    whitener = fit_whitener(fit, d, most)
    k, error = len(whitener.eigenvalues), _identity_error(fit, whitener)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        u = whitener.numerators(_matrix(batch, d))
        m = len(u)
        again = pa.array(np.repeat(np.arange(m), k))
        return pa.RecordBatch.from_arrays([
            batch.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, whitener.n, np.int64)),
            _decimals(whitener.deviations(u)).take(again), pa.array(whitener.whitened(u).ravel()), pa.array(np.tile(whitener.explained, m)),
            pa.array(np.full(m * k, error, np.float64))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(x, apply, out)
