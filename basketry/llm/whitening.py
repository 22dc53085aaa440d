"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

The scatter is summed on Spark in whole numbers, so it is exact whatever the number of rows and the order they are
added in: a pass for the sums, a pass for the products of entries less the rounded mean, whose remainder is taken
out of the total exactly. Only the d x d total reaches the driver. Its covariance is V = G G' by Cholesky with
pivoting, which reveals the rank; rotations of G's columns make them orthogonal, and then their squared norms are
the eigenvalues of V and the normalised columns its eigenvectors. Both work in extended precision.

Cases: rows whose vector is null, empty or holds null or non-finite entries are left out; so are those that have
another length than most (at equal numbers the longer length stays). Entries are floor(scale * c) + offset, and stop
at 2^40. A null id stays null; equal rows are all returned. Directions without variance (under 10^-14 of the largest) have no component, so equal
vectors, or a single one, give no rows. A deviation beyond a long is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.rows import batch
from basketry.llm.vectors import DIGITS, LONG, cross, digits, largest, longs, matrices, of_length, squares, whole_vectors
from basketry.workspace import Workspace

SCALE = 64.0
OFFSET = 1_000_000
COMPONENTS = 32
SWEEPS = 60
PRECISE = np.longdouble

SCHEMA = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()),
])


@dataclass(frozen=True)
class Moments:
    """Of the fit list: rows, sums per dimension, and n^2 times the covariance; all exact."""

    n: int
    sums: list[int]
    scatter: np.ndarray


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, by falling eigenvalue, and the share of each in the trace."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fit_list(embeddings: DataFrame, ws: Workspace, scale: float = SCALE, offset: int = OFFSET) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that count as a written table, and their length; 0 if there are none."""
    vectors = ws.save(whole_vectors(embeddings, scale).withColumn("x", F.transform("x", lambda c: c + F.lit(offset).cast("long"))), "vectors")
    lengths = vectors.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    length = most["length"] if most else 0
    return vectors.filter(of_length(vectors, length)), length


def moments(vectors: DataFrame, length: int) -> Moments:
    """Two passes: sums, then products of centred entries; a task sends one row per pair of dimensions."""
    found = vectors.select("x").mapInArrow(_sums(length), f"i int, n long, total {DIGITS}").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = found.orderBy("i").collect()
    n, sums = int(rows[0]["n"]), [int(r["total"]) for r in rows]
    mean = [(2 * s + n) // (2 * n) for s in sums]
    parts = vectors.select("x").mapInArrow(_products(length, mean), f"i int, j int, total {DIGITS}")
    scatter = np.zeros((length, length), object)
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = int(r["total"])
    left = np.array([s - n * m for s, m in zip(sums, mean, strict=True)], object)  # what rounding the mean left over
    return Moments(n, sums, n * scatter - np.outer(left, left))


def _sums(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for b in batches:
            for _, x in matrices(b, length):
                n, total = n + len(x), total + x.sum(axis=0, dtype=object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), digits(list(total))], ["i", "n", "total"])

    return run


def _products(length: int, mean: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, centre, seen = np.zeros((length, length), object), np.array(mean, np.int64), False
        for b in batches:
            for _, x in matrices(b, length):
                total, seen = total + cross(x - centre), True
        if seen:
            i, j = np.triu_indices(length)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), digits(list(total[i, j]))], ["i", "j", "total"])

    return run


def pivoted_factor(matrix: np.ndarray) -> np.ndarray:
    """G with G G' = matrix, lower triangular up to the order of its rows; as many columns as the rank."""
    size = len(matrix)
    rest, factor = matrix.astype(PRECISE), np.zeros((size, size), PRECISE)
    least = size * float(np.finfo(np.float64).eps) * max(float(np.max(np.diag(rest), initial=0)), 0.0)
    free = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(free, np.diag(rest), -1)))
        if not rest[pivot, pivot] > least:
            return factor[:, :k]
        free[pivot] = False
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        column[~free] = 0
        column[pivot] = np.sqrt(rest[pivot, pivot])
        factor[:, k] = column
        rest = rest - np.outer(column, column)
    return factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in n - 1 rounds of disjoint pairs, as in a tournament."""
    order = list(range(n + n % 2))
    for _ in range(len(order) - 1):
        left, right = np.array(order[: len(order) // 2]), np.array(order[: len(order) // 2 - 1 : -1])
        both = (left < n) & (right < n)
        yield left[both], right[both]
        order = [order[0], order[-1], *order[1:-1]]


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal to working precision."""
    g, small = factor.copy(), PRECISE(np.finfo(PRECISE).eps) * len(factor)
    for _ in range(SWEEPS):
        turned = False
        for p, q in _rounds(g.shape[1]):
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(gamma) > small * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned = True
            p, q, a, b = p[turn], q[turn], a[:, turn], b[:, turn]
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return g


def _precise(value: Fraction) -> np.longdouble:
    high = float(value)
    return PRECISE(high) + PRECISE(float(value - Fraction(high)))


def components(found: Moments, most: int = COMPONENTS) -> Components:
    """Up to ``most`` components; the largest entry of each is positive."""
    size, square = len(found.sums), found.n * found.n
    covariance = np.array([[_precise(Fraction(int(v), square)) for v in row] for row in found.scatter], PRECISE).reshape(size, size)
    trace = float(Fraction(sum(int(found.scatter[i, i]) for i in range(size)), square))
    g = orthogonal_columns(pivoted_factor(covariance))
    values = (g * g).sum(0)
    order = np.argsort(-values.astype(np.float64), kind="stable")[:most]
    vectors = g[:, order] / np.sqrt(values[order])
    vectors = vectors * np.where(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))] < 0, -1, 1) if len(order) else vectors
    values = values[order].astype(np.float64)
    return Components(vectors.astype(np.float64), values, values / trace if trace else values)


def _scaled(x: np.ndarray, found: Moments, kept: Components) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S exactly, whitened values) of the rows of a matrix."""
    kind = np.int64 if 2 * max(found.n * largest(x), *map(abs, found.sums)) < LONG else object
    apart = x.astype(kind) * found.n - np.array(found.sums, kind)
    return apart, (apart.astype(np.float64) / found.n) @ (kept.vectors / np.sqrt(kept.values))


def identity_error(vectors: DataFrame, length: int, found: Moments, kept: Components) -> float:
    """Largest entry, in absolute value, of the whitened vectors' covariance minus the identity."""
    k = len(kept.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            for _, x in matrices(b, length):
                w = _scaled(x, found, kept)[1]
                total, sums = total + w.T @ w, sums + w.sum(0)
        i, j = np.triu_indices(k)
        first = np.concatenate([np.full(k, -1), i])  # the sums stand at i = -1
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(np.concatenate([np.arange(k), j]), pa.int32()), pa.array(np.concatenate([sums, total[i, j]]))], ["i", "j", "total"])

    second, mean = np.zeros((k, k)), np.zeros(k)
    for r in vectors.select("x").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if r["i"] < 0:
            mean[r["j"]] = r["total"] / found.n
        else:
            second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["total"] / found.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whitened(embeddings: DataFrame, ws: Workspace, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    deviation is the sum over dimensions of (n x - S)^2; explained the component's share of the variance.
    """
    vectors, length = fit_list(embeddings, ws)
    if not length:
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    found = moments(vectors, length)
    kept = components(found, most)
    k = len(kept.values)
    error = identity_error(vectors, length, found, kept) if k else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, x in matrices(b, length):
                apart, w = _scaled(x, found, kept)
                rows = np.repeat(np.arange(len(x)), k)
                yield batch(SCHEMA, {
                    "vec_id": b.column(0).slice(first, len(x)).take(pa.array(rows)), "component": np.tile(np.arange(1, k + 1), len(x)),
                    "n": np.full(len(rows), found.n), "deviation": longs(squares(apart)).take(pa.array(rows)),
                    "whitened": w.ravel(), "explained": np.tile(kept.explained, len(x)),
                })

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double"
    return vectors.mapInArrow(run, schema).withColumn("identity_error", F.lit(error))
