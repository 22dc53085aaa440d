"""Readers of the source tables, and of the tables a run has written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketry.sources import schemas

#: Below a table that is replaced as a whole: empty files whose names are ``<number>.<folder of the data>``.
POINTERS = "_versions"


@dataclass(frozen=True)
class Sources:
    """The five inputs of a run."""

    orders: DataFrame
    partner_snapshots: DataFrame
    products: DataFrame
    catalogue: DataFrame
    categories: DataFrame


def pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the versions that the table had, the present one last; none for a plain folder of files."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTERS}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    found = (name.split(".", 1) for name in names if name[:1].isdigit())
    return sorted((int(number), data) for number, data in found)


def table_folder(spark: SparkSession, path: str) -> str:
    """Where the present rows of the table lie."""
    versions = pointers(spark, path)
    return f"{path.rstrip('/')}/{versions[-1][1]}" if versions else path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table, in its present version; with a schema given, no footer is read to find it."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(table_folder(spark, path))


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """The order facts; quantities are of the type that the files have, whole numbers or not."""
    stored = read_table(spark, path).schema["details"].dataType.elementType["quantity"].dataType
    return read_table(spark, path, schemas.order_facts(stored))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at the path. That it can be read is not asked: reading will tell."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_sources(spark: SparkSession, root: str) -> Sources:
    """The inputs from ``root``, one folder per table."""
    return Sources(
        orders=read_orders(spark, f"{root}/fact_orders"),
        partner_snapshots=read_table(
            spark, f"{root}/dim_historical_partners", schemas.PARTNER_SNAPSHOTS
        ),
        products=read_table(spark, f"{root}/dim_product", schemas.PRODUCTS),
        catalogue=read_table(spark, f"{root}/catalogue", schemas.CATALOGUE),
        categories=read_table(spark, f"{root}/dim_business_category", schemas.CATEGORIES),
    )
