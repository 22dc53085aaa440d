"""Explicit schemas of the source tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def order_facts(quantity: DataType) -> StructType:
    """Nested order facts whose quantities have the type."""
    return StructType([*_ORDER_HEADS, StructField("details", ArrayType(StructType([
        StructField("product", StructType([StructField("product_id", LongType())])),
        StructField("quantity", quantity),
    ])))])


_ORDER_HEADS = [
    StructField("order_id", LongType()),
    StructField("registered_date", DateType()),
    StructField("business_type_id", IntegerType()),
    StructField("confirmed_order", IntegerType()),
    StructField("country", StructType([
        StructField("country_id", IntegerType()),
        StructField("country_name", StringType()),
    ])),
    StructField("restaurant", StructType([StructField("id", LongType())])),
]

ORDER_FACTS = order_facts(DoubleType())

PARTNER_SNAPSHOTS = StructType([
    StructField("restaurant_id", LongType()),
    StructField("date_id", DateType()),
    StructField("business_type", StringType()),
    StructField("business_name", StringType()),
    StructField("is_darkstore", IntegerType()),
    StructField("business_category_id", IntegerType()),
    StructField("yyyymmdd", DateType()),
])

PRODUCTS = StructType([
    StructField("id", LongType()),
    StructField("gtin", StringType()),
    StructField("integration_code", StringType()),
])

CATALOGUE = StructType([
    StructField("id", LongType()),
    StructField("gtin", StringType()),
])

CATEGORIES = StructType([StructField("business_category_id", IntegerType())])
