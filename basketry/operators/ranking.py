"""Best sellers per partner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.dataset import units_sold
from basketry.operators.snapshot import partner_copies
from basketry.params import TOP_K, OrderFilter, RunWindow


def ranked_units(
    lines: DataFrame,
    products: DataFrame,
    catalogue: DataFrame,
    snapshots: DataFrame,
    categories: DataFrame,
    window: RunWindow,
    orders: OrderFilter = OrderFilter(),
    dedupe: bool = False,
) -> DataFrame:
    """Units sold, each line counted once per partner snapshot row, type and category it matches.

    All lines of a partner are repeated alike, so the sums are multiplied instead.
    """
    units = units_sold(lines, products, catalogue, window, orders, dedupe)
    if dedupe:
        return units
    copies = partner_copies(snapshots, categories, window)
    return units.join(copies, "partner_id", "left").select(
        "country_id",
        "partner_id",
        "gtin",
        (F.col("items_sold") * F.coalesce("partner_copies", F.lit(1))).alias("items_sold"),
    )


def top_products(units: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k codes with most units per (country, partner); equal units rank by code.

    Spark keeps k rows per partner before the shuffle as well as after it.
    """
    best_first = Window.partitionBy("country_id", "partner_id").orderBy(
        F.desc("items_sold"), F.asc("gtin")
    )
    return (
        units.filter(F.col("items_sold") > 0)
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .drop("items_sold")
    )


def ranking_topk(
    lines: DataFrame,
    products: DataFrame,
    catalogue: DataFrame,
    snapshots: DataFrame,
    categories: DataFrame,
    window: RunWindow,
    orders: OrderFilter = OrderFilter(),
    k: int = TOP_K,
    dedupe: bool = False,
) -> DataFrame:
    """(country_id, partner_id, gtin, rank) of each partner's best sellers."""
    return top_products(
        ranked_units(lines, products, catalogue, snapshots, categories, window, orders, dedupe), k
    )
