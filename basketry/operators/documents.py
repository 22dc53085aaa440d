"""Recommendations as nested documents, and documents as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import number_text
from basketry.operators.rules import pair_best_metric
from basketry.params import METRIC

# Fixed values of the documents and messages.
MBA = "mba"
MBA_TYPE = "antecedent"
RANKING = "ranking"
RANKING_TYPE = "partner_id"
RANKING_METRIC = "rank"
ENVELOPE_KEY = "default"


def mba_documents(pairs: DataFrame, metric: str = METRIC) -> DataFrame:
    """One document per (country, antecedent): its consequents, best value of the metric first.

    A document lists frequent items of one country, so its length has the bound that mining has.
    """
    best = pair_best_metric(pairs, metric)
    return _documents(
        best,
        code="antecedents",
        criteria=MBA,
        kind=MBA_TYPE,
        recommended="consequents",
        metric=metric,
        order=-F.col(metric),
        text=number_text(F.col(metric)),
    )


def ranking_documents(ranking: DataFrame) -> DataFrame:
    """One document per (country, partner): its best sellers by rank."""
    return _documents(
        ranking,
        code="partner_id",
        criteria=RANKING,
        kind=RANKING_TYPE,
        recommended="gtin",
        metric=RANKING_METRIC,
        order=F.col("rank"),
        text=F.col("rank").cast("string"),
    )


def to_messages(documents: DataFrame, event_type: str) -> DataFrame:
    """(message, event_type): the document as JSON text inside a JSON envelope."""
    keep_nulls = {"ignoreNullFields": "false"}
    document = F.to_json(F.struct(*documents.columns), keep_nulls)
    return documents.select(
        F.to_json(F.struct(document.alias(ENVELOPE_KEY)), keep_nulls).alias("message"),
        F.lit(event_type).alias("event_type"),
    )


def _documents(
    rows: DataFrame,
    *,
    code: str,
    criteria: str,
    kind: str,
    recommended: str,
    metric: str,
    order: Column,
    text: Column,
) -> DataFrame:
    entry = F.struct(order.alias("order"), F.col(recommended).alias("code"), text.alias("text"))
    return rows.groupBy("country_id", code).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    ).select(
        F.col("country_id").cast("string").alias("country_id"),
        F.lit(criteria).alias("criteria"),
        F.lit(kind).alias("type"),
        F.col(code).cast("string").alias("code"),
        F.transform(
            "entries",
            lambda e: F.struct(
                e["code"].alias("code"), F.lit(metric).alias("metric"), e["text"].alias("metric_value")
            ),
        ).alias("recommendation"),
    )
