"""Order facts in buckets by order, so that lines become baskets without an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEY = "order_id"


def write_bucketed_orders(orders: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write order facts, or lines of them, as a table of the catalogue with ``buckets`` files per date at most.

    All rows of an order lie in one bucket. Everything that groups by order afterwards, like ``operators.baskets``, reads them
    where they are; 128 MB to 1 GB a bucket and month of orders is a good size. ``path`` makes it a table outside of the
    warehouse folder.
    """
    # One task per bucket, so that a bucket is one file and not one per task.
    writer = orders.repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_bucketed_orders(spark: SparkSession, table: str) -> DataFrame:
    """The rows with their buckets."""
    return spark.read.table(table)
