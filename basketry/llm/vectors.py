"""Vectors as whole numbers: which rows count, their matrices in tasks, and sums without rounding."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.rows import plain

LARGEST = float(1 << 40)  # whole numbers stop here: differences fit a long, sums of their squares 38 digits
LONG = (1 << 63) - 1
EXACT = 1 << 53  # up to here doubles hold every whole number
CHUNK = 1 << 20  # entries of a matrix that a task works on at a time
DIGITS = "decimal(38,0)"


def whole_vectors(embeddings: DataFrame, scale: float, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * entry) of each entry, for the rows whose vector is neither null nor empty nor
    holds null or non-finite entries. Numbers beyond 2^40 stop there. Other columns are left out."""
    entry = lambda c: c.cast("double")
    finite = lambda c: entry(c).isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < float("inf"))
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.filter((F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(finite(c), F.lit(False))))
    whole = lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), entry(c) * scale)))
    return rows.select("vec_id", F.transform("v", whole).alias("x"))


def of_length(vectors: DataFrame, length: int) -> Column:
    return F.size(vectors["x"]) == length


def matrices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix of whole numbers) for slices of the batch's column ``x``, whose vectors have the length."""
    column = plain(batch.column(batch.schema.get_field_index("x")))
    if not len(column):
        return
    flat = plain(column.flatten()).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, length)
    step = max(1, CHUNK // length)
    for first in range(0, len(flat), step):
        yield first, flat[first : first + step]


def largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def squares(x: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exact; Python numbers where longs would not do."""
    most = largest(x)
    if most * most * x.shape[1] > LONG:
        x = x.astype(object)
    return (x * x).sum(axis=1)


def cross(x: np.ndarray) -> np.ndarray:
    """x' x as exact Python numbers: products of doubles as long as every sum fits one."""
    most = largest(x)
    rows = EXACT // max(1, most * most)
    if not rows:
        wide = x.astype(object)
        return wide.T.dot(wide)
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for first in range(0, len(x), rows):
        part = x[first : first + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def digits(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def longs(values: np.ndarray) -> pa.Array:
    """Whole numbers as longs; null beyond them."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if abs(v) <= LONG else None for v in values], pa.int64())


def as_long(total: Column) -> Column:
    """A sum of decimals as a long; null beyond."""
    return total.try_cast("long")
