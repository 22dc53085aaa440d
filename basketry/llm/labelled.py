"""Labelled rows that classifiers may learn from: a bounded sample, and its documents."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.workspace import Workspace


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int, per_class: int, ws: Workspace) -> tuple[DataFrame, float]:
    """The sample, and by how much the log odds of label 1 are greater among all those rows than in the sample.

    The sample is (doc_id, label 0 or 1): up to ``per_class`` rows of each class outside the held-out fold, by hash of the id.

    Ids that are labelled both ways, and null ids or labels, are left out.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most")
    rows = ws.save(rows, f"{label}-labels")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    shift = math.log(sizes[1] / sizes[0]) - math.log(min(sizes[1], per_class) / min(sizes[0], per_class)) if len(sizes) == 2 else 0.0
    classes = [rows.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return ws.save(reduce(DataFrame.union, classes), f"{label}-sample"), shift
