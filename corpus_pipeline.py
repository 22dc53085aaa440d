"""The corpus pipeline: documents → good, distinct, uncontaminated, mixed and sharded ones.

Each stage takes and returns rows with the columns of ``documents``; the last adds ``shard``. Between two
stages the rows are written as Parquet below ``spark.checkpoint.dir`` and read again, so a lost executor
costs a stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontamination, mixing, near_duplicates, rule_ensemble, sharding
from basketry.llm.queries import CERTAIN, read, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

NEAR = near_duplicates.Similarity(words=5, share=80)
SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return rule_ensemble.good_documents(docs, read(spark, sf_dir, "labels"), CERTAIN, workspace(spark))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.without_near_duplicates(docs, workspace(spark), NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"), workspace(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixture(docs, workspace(spark))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard; an input column of that name is replaced."""
    return docs.withColumn("shard", sharding.shard_of(F.col("doc_id"), SHARDS))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can express neither the classifier's fit nor the components; a test compares a run with plain Python, given its scores and mix.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    ws = workspace(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
