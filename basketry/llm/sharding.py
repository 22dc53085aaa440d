"""Sharding by jump consistent hashing: a stable key and the number of shards decide; there is no ring table.

With one shard more, a row stays or goes to the new shard, and only the necessary share of rows goes.
Slots number the rows of a shard from 0 by (key, size, checksum); equal rows have any of their slots.

Cases: a null key is the key -2^63; a null text has no bytes; equal rows get different slots; an empty
table gives no rows; other columns stay with ``write_shards`` and are left out by ``assign_shards``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.order import in_order
from basketry.llm.words import mix
from basketry.workspace import Workspace

NULL_KEY = -(1 << 63)
OVERHEAD = 16  # bytes of a document besides its text


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0, of each 64-bit key (Lamping and Veach, 2014), for all keys at once."""
    state = mix(keys.astype(np.int64).view(np.uint64))
    shard, following = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    while (going := following < shards).any():
        shard = np.where(going, following, shard)
        state = np.where(going, state * np.uint64(2862933555777941757) + np.uint64(1), state)
        step = (shard + 1) * (float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64))
        following = np.where(going, step.astype(np.int64), following)
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key as a column."""

    @F.pandas_udf(T.IntegerType())
    def own(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards), dtype="int32")

    return own(F.coalesce(key.cast("long"), F.lit(NULL_KEY).cast("long")))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of each row; texts go no further."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )


def assign_shards(docs: DataFrame, shards: int, ws: Workspace) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of each row; grown_shard is that of one shard more."""
    rows = sized(docs).withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})
    order = [F.col(c) for c in ("shard", "doc_id", "size", "text_crc32")]
    placed = in_order(rows, order, [], ws, "shards")
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row per shard
    placed = placed.join(first, "shard").withColumn("slot", F.col("position") - F.col("first"))
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, folder: str, shards: int) -> None:
    """All columns of ``docs`` as one Parquet folder per shard (``shard=<number>``)."""
    docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).write.partitionBy("shard").parquet(folder)
