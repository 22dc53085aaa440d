"""The source tables as views over a star schema of orders, lines, parts, customers and events.

Partners are the suppliers of the lines, countries the customers' regions, snapshots the events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import normalize_code
from basketry.params import RunWindow
from basketry.sources.tables import Sources, read_table

# Fixed values of the analogue.
BUSINESS_SEGMENTS = ("BUILDING", "MACHINERY")
CONFIRMED_STATUS = "F"
CATALOGUE_GAP = 7
LINES_PER_RECORD = 1000
SNAPSHOT_SHIFT_DAYS = 8218  # puts the events' last day, 2024-01-30, on 2001-07-31


class StarSchema:
    """Views over the Parquet tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    def order_heads(self) -> DataFrame:
        """Orders with the region of their customer."""
        # Nations and regions are fixed dimensions: the planner broadcasts them by their file size.
        customers = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_mktsegment", "r_regionkey", "r_name")
        )
        return self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("registered_date"),
            _flag(F.col("c_mktsegment").isin(*BUSINESS_SEGMENTS), 2, 1).alias("business_type_id"),
            _flag(F.col("o_orderstatus") == CONFIRMED_STATUS, 1, 0).alias("confirmed_order"),
            F.col("r_regionkey").alias("country_id"),
            F.col("r_name").alias("country_name"),
        )

    def order_lines(self) -> DataFrame:
        """Order lines, flat: what ``operators.dataset.order_lines`` gives for nested orders."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("partner_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
        )
        return self.order_heads().join(lines, "order_id")

    def nested_orders(self) -> DataFrame:
        """Order facts with the lines of one partner nested, at most 1000 to a record.

        Lines read one after another share a record, so an order of any length makes many records
        and none of them grows with it.
        """
        record = F.floor(F.monotonically_increasing_id() / LINES_PER_RECORD)
        return self._order_facts(
            self.table("lineitem")
            .select("*", record.alias("record"))
            .groupBy("l_orderkey", "l_suppkey", "record")
            .agg(F.collect_list(_nested_line()).alias("details"))
        )

    def _order_facts(self, records: DataFrame) -> DataFrame:
        return self.order_heads().join(records, F.col("order_id") == F.col("l_orderkey")).select(
            "order_id",
            "registered_date",
            "business_type_id",
            "confirmed_order",
            F.struct("country_id", "country_name").alias("country"),
            F.struct(F.col("l_suppkey").alias("id")).alias("restaurant"),
            "details",
        )

    def products(self) -> DataFrame:
        """Products with gtins of several shapes, a fifth of them without one."""
        key = F.col("p_partkey")
        text = key.cast("string")
        return self.table("part").select(
            key.alias("id"),
            F.when(key % 5 == 0, F.lit(None).cast("string"))
            .when(key % 5 == 1, F.concat(F.lit("EAN "), (key + 7790000000000).cast("string")))
            .when(key % 5 == 2, F.concat(F.lit("n/a "), text))
            .otherwise((key + 77900000).cast("string"))
            .alias("gtin"),
            F.concat("p_brand", F.lit(" / "), text).alias("integration_code"),
        )

    def catalogue(self) -> DataFrame:
        """Six in seven products, by their normalised code."""
        return self.products().filter(F.col("id") % CATALOGUE_GAP != 0).select(
            "id", normalize_code(F.col("gtin"), F.col("integration_code")).alias("gtin")
        )

    def partner_snapshots(self, window: RunWindow | None = None) -> DataFrame:
        """One snapshot per event: user, day, kind, and a value; days moved into the order dates.

        With ``window`` only its days, by bounds on the events' own column, which reach the scan.
        """
        events = self.table("events")
        if window:
            shift = dt.timedelta(days=SNAPSHOT_SHIFT_DAYS)
            kind = events.schema["ts"].dataType
            start, end = (F.lit(day + shift).cast(kind) for day in (window.start, window.end))
            events = events.filter((F.col("ts") >= start) & (F.col("ts") < end))
        day = F.date_sub(F.col("ts").cast("date"), SNAPSHOT_SHIFT_DAYS)
        return events.select(
            F.col("user_id").alias("restaurant_id"),
            day.alias("date_id"),
            F.col("event_type").alias("business_type"),
            F.concat(F.lit("partner "), F.col("user_id").cast("string")).alias("business_name"),
            F.col("value").alias("is_darkstore"),
            (F.col("event_id") % 7).cast("int").alias("business_category_id"),
            day.alias("yyyymmdd"),
        )

    def categories(self) -> DataFrame:
        """One category per region."""
        return self.table("region").select(F.col("r_regionkey").alias("business_category_id"))

    def sources(self, window: RunWindow | None = None) -> Sources:
        return Sources(
            orders=self.nested_orders(),
            partner_snapshots=self.partner_snapshots(window),
            products=self.products(),
            catalogue=self.catalogue(),
            categories=self.categories(),
        )

    def brand_lines(self) -> DataFrame:
        """(order_id, gtin): the brand of each line as its item."""
        brands = self.table("part").select("p_partkey", F.col("p_brand").alias("gtin"))
        return self.table("lineitem").join(
            brands, F.col("l_partkey") == F.col("p_partkey")
        ).select(F.col("l_orderkey").alias("order_id"), "gtin")

    def brand_rows(self) -> DataFrame:
        """(country_id, order_id, gtin) of the brand lines of all orders, with repeats."""
        countries = self.order_heads().select("order_id", "country_id")
        return self.brand_lines().join(countries, "order_id").select("country_id", "order_id", "gtin")


def _nested_line() -> Column:
    return F.struct(
        F.struct(F.col("l_partkey").alias("product_id")).alias("product"),
        F.col("l_quantity").alias("quantity"),
    )


def _flag(condition: Column, yes: int, no: int) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))
