"""From order facts and dimensions to basket rows and units sold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import normalize_code, pad_code
from basketry.params import OrderFilter, RunWindow

ROW_COLUMNS = ("order_id", "country_name", "country_id", "partner_id", "gtin")


def in_window(day: Column, window: RunWindow) -> Column:
    """Both ends are literals, so the test reaches the scan and prunes date partitions."""
    return (day >= F.lit(window.start)) & (day < F.lit(window.end))


def order_window(orders: DataFrame, window: RunWindow) -> DataFrame:
    return orders.filter(in_window(F.col("registered_date"), window))


def order_lines(orders: DataFrame) -> DataFrame:
    """One row per line of the nested orders; an order without lines has no row."""
    return orders.select(
        "order_id",
        "registered_date",
        "business_type_id",
        "confirmed_order",
        F.col("country.country_id").alias("country_id"),
        F.col("country.country_name").alias("country_name"),
        F.col("restaurant.id").alias("partner_id"),
        F.explode("details").alias("line"),
    ).select(
        "*",
        F.col("line.product.product_id").alias("product_id"),
        F.col("line.quantity").alias("quantity"),
    ).drop("line")


def eligible_lines(lines: DataFrame, window: RunWindow, orders: OrderFilter) -> DataFrame:
    """Lines of orders in the window, of the business type, from the listed countries."""
    return order_window(lines, window).filter(
        (F.col("business_type_id") == orders.business_type)
        & F.col("country_name").isin(*orders.countries)
    )


def normalized_codes(products: DataFrame) -> DataFrame:
    return products.select(
        "id", normalize_code(F.col("gtin"), F.col("integration_code")).alias("code")
    )


def listed_codes(products: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(product_id, gtin, copies): the products whose code the catalogue lists.

    A product appears in the order data only through this table, so the catalogue is joined to the
    products here, dimension to dimension, and the order lines are joined once. ``copies`` is how
    many rows the two joins would make of one line.
    """
    listed = (
        catalogue.filter(F.col("id").isNotNull())
        .groupBy(pad_code(F.col("gtin")).alias("code"))
        .agg(F.count("*").alias("listings"))
    )
    return (
        normalized_codes(products)
        .groupBy("id", "code")
        .agg(F.count("*").alias("entries"))
        .join(listed, "code")
        .select(
            F.col("id").alias("product_id"),
            F.col("code").alias("gtin"),
            (F.col("entries") * F.col("listings")).alias("copies"),
        )
    )


def matched_lines(
    lines: DataFrame,
    products: DataFrame,
    catalogue: DataFrame,
    window: RunWindow,
    orders: OrderFilter = OrderFilter(),
) -> DataFrame:
    """The basket rows with repeats: what ``baskets`` needs, without a shuffle to drop them.

    Partner snapshots and categories add no column and no condition, so neither is joined.
    """
    codes = listed_codes(products, catalogue).select("product_id", "gtin")
    return eligible_lines(lines, window, orders).join(codes, "product_id").select(*ROW_COLUMNS)


def basket_rows(
    lines: DataFrame,
    products: DataFrame,
    catalogue: DataFrame,
    window: RunWindow,
    orders: OrderFilter = OrderFilter(),
) -> DataFrame:
    """Distinct (order, country, partner, code) of the eligible lines."""
    return matched_lines(lines, products, catalogue, window, orders).distinct()


def units_sold(
    lines: DataFrame,
    products: DataFrame,
    catalogue: DataFrame,
    window: RunWindow,
    orders: OrderFilter = OrderFilter(),
    dedupe: bool = False,
) -> DataFrame:
    """Units per (country, partner, code) over the confirmed eligible lines.

    The lines are summed per product before the join, so what is joined grows with the products a
    partner sells, not with the lines, and a best-seller's lines never meet on one key. ``dedupe``
    counts a line once however many dimension rows it matches.
    """
    codes = listed_codes(products, catalogue)
    weight = F.lit(1) if dedupe else F.col("copies")
    per_product = (
        eligible_lines(lines, window, orders)
        .filter(F.col("confirmed_order") == 1)
        .groupBy("country_id", "partner_id", "product_id")
        .agg(F.sum("quantity").alias("units"))
    )
    return (
        per_product.join(codes, "product_id")
        .groupBy("country_id", "partner_id", "gtin")
        .agg(F.sum(F.col("units") * weight).alias("items_sold"))
    )
