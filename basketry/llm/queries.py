"""Queries over the given tables, one per operator, with production parameters."""

from __future__ import annotations

import atexit
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.decontamination import contamination
from basketry.llm import clustering, imatch, pii, rule_ensemble, secrets, spans, toxicity, whitening
from basketry.llm.labelled import fold
from basketry.llm.line_dedup import deduplicated
from basketry.llm.mixing import mixed
from basketry.llm.near_duplicates import Similarity, near_duplicates
from basketry.llm.quality_rules import POLICIES, kept, ledger
from basketry.llm.rows import identified
from basketry.llm.sharding import assign_shards
from basketry.workspace import Workspace

CERTAIN = 0.7  # least score of a predicted 1
Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    """A workspace that outlives the query, since its rows are read later; dropped when Python ends."""
    ws = Workspace(spark)
    atexit.register(_drop, ws)
    return ws


def _drop(ws: Workspace) -> None:
    if ws.spark.sparkContext._jsc is not None:
        ws.drop()


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    base, policy = POLICIES
    rows = ledger(read(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~kept(base)).alias("base_failed"), kept(policy).alias("kept"), "failed", "n_lines", "n_capitals",
    )


def op2_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = assign_shards(read(spark, folder, "documents"), 40, workspace(spark))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixed(read(spark, folder, "documents"), workspace(spark))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "chosen")


def _decided(scores: DataFrame, folds: int, held_out: int) -> DataFrame:
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CERTAIN).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scores = toxicity.toxicity_scores(read(spark, folder, "documents"), read(spark, folder, "labels"), workspace(spark))
    return _decided(scores, toxicity.FOLDS, toxicity.HELD_OUT)


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scores = rule_ensemble.quality_scores(read(spark, folder, "documents"), read(spark, folder, "labels"), workspace(spark))
    return _decided(scores, rule_ensemble.FOLDS, rule_ensemble.HELD_OUT)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"), workspace(spark))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_duplicates(identified(read(spark, folder, "documents")), workspace(spark), Similarity(words=3, share=90))
    return rows.select("doc_id", "n_shingles", "component_id")


def _digests(rows: DataFrame, kinds: tuple[str, ...], base: int) -> DataFrame:
    counts = [spans.count(F.col("base"), k).alias(f"n_{kinds[k]}") for k in range(base)]
    sha = F.sha2(spans.written(F.col("base"), kinds), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, sha, spans.written(F.col("spans"), kinds).alias("spans"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(secrets.secret_spans(read(spark, folder, "documents"), workspace(spark)), secrets.KINDS, 3)


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = deduplicated(read(spark, folder, "documents"), workspace(spark))
    n = F.size("removed").cast("long").alias("n_removed")
    return rows.select("doc_id", "n_lines", n, F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), "text")


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(pii.personal_spans(read(spark, folder, "documents"), workspace(spark)), pii.KINDS, 4)


def op11_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(read(spark, folder, "documents"), workspace(spark))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(read(spark, folder, "embeddings"), workspace(spark))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.clustered(read(spark, folder, "embeddings"), workspace(spark))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_jump_sharding": op2_jump_sharding,
    "op3_source_mixing": op3_source_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secret_scan": op8_secret_scan,
    "op9_line_dedup": op9_line_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_centroid_clustering": op13_centroid_clustering,
}
