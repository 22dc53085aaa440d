"""Baskets and the numbers support is relative to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.params import MiningParams


def baskets(rows: DataFrame) -> DataFrame:
    """(country_id, order_id, items): the distinct codes of each order, sorted.

    ``collect_set`` drops repeated codes on the map side, so what reaches one task for one order is
    bounded by the catalogue, whatever the number of its rows.
    """
    return (
        rows.dropna(subset=["country_id", "order_id", "gtin"])
        .groupBy("country_id", "order_id")
        .agg(F.sort_array(F.collect_set("gtin")).alias("items"))
    )


def basket_counts(baskets: DataFrame, params: MiningParams) -> DataFrame:
    """(country_id, n_baskets, min_count), single-item baskets included."""
    return with_min_count(
        baskets.groupBy("country_id").agg(F.count("*").alias("n_baskets")), params
    )


def with_min_count(totals: DataFrame, params: MiningParams) -> DataFrame:
    """Add the least number of baskets that makes an itemset frequent."""
    least = F.ceil(F.lit(float(params.min_support)) * F.col("n_baskets"))
    floor = F.lit(params.min_count_floor).cast("long")
    return totals.withColumn("min_count", F.greatest(least, floor))
