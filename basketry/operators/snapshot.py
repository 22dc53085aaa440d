"""Partner snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.dataset import in_window
from basketry.params import RunWindow

SNAPSHOT_KEYS = ("restaurant_id", "date_id", "business_type", "business_name")


def latest_snapshot(snapshots: DataFrame, window: RunWindow) -> DataFrame:
    """The snapshot rows of each partner's last day in the window, one per type and name.

    Rows are aggregated per day first, on the map side too; ``rank() = 1`` then keeps the last day,
    and Spark applies it before its shuffle as well, so a partner's whole history never moves.
    """
    per_day = (
        snapshots.filter(in_window(F.col("yyyymmdd"), window))
        .filter(F.col("restaurant_id").isNotNull() & F.col("date_id").isNotNull())
        .groupBy(*SNAPSHOT_KEYS)
        .agg(
            F.max("is_darkstore").alias("is_darkstore"),
            F.max("business_category_id").alias("business_category_id"),
        )
    )
    newest_first = Window.partitionBy("restaurant_id").orderBy(F.desc("date_id"))
    return per_day.withColumn("age", F.rank().over(newest_first)).filter("age = 1").drop("age")


def partner_copies(snapshots: DataFrame, categories: DataFrame, window: RunWindow) -> DataFrame:
    """(partner_id, partner_copies): the rows one order line becomes when joined to its partner's
    latest snapshot rows and then to their categories, both as left joins."""
    categories = categories.groupBy("business_category_id").agg(F.count("*").alias("entries"))
    return (
        latest_snapshot(snapshots, window)
        .join(categories, "business_category_id", "left")
        .groupBy(F.col("restaurant_id").alias("partner_id"))
        .agg(F.sum(F.coalesce("entries", F.lit(1))).alias("partner_copies"))
    )
