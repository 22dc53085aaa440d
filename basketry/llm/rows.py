"""What the operators share around rows: identity of a row by its content, Arrow output batches, settings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Two hashes with different seeds: 128 bits that stand for (doc_id, text). Equal rows share them, and
#: every operator gives equal rows equal results, so joining results back on them loses nothing.
ROW_KEY = ["row_a", "row_b"]

#: Rows of an Arrow batch of texts: the JVM and the Python worker each hold such a batch several times.
TEXT_ROWS = 1000


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run meanwhile send at most ``TEXT_ROWS`` rows to Python at once; the setting is put back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, row_a, row_b); other columns are left out, so their names cannot clash."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        *row_key(F.col(doc_id).cast("long"), F.col(text)),
    )


def row_key(doc_id: Column, text: Column) -> list[Column]:
    return [F.xxhash64(doc_id, text).alias("row_a"), F.xxhash64(F.lit(1), text, doc_id).alias("row_b")]


def batch(schema: pa.Schema, columns: dict[str, Any]) -> pa.RecordBatch:
    """A record batch of the schema from arrays or lists."""
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def plain(array: pa.Array) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
