"""Run the queries beside their SQL: ``python -m verification.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from basketry.session import with_settings
from verification.oracle import ORACLE
from verification.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view per Parquet file of the folder."""
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, values comparable across engines, in a fixed order."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].dt.date
    rows = (tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False))
    return sorted(rows, key=repr)


def spark_rows(spark: SparkSession, name: str, folder: str) -> tuple[list[str], list[tuple]]:
    frame = QUERIES[name](spark, folder).toPandas()
    return sorted(frame.columns), normal(frame)


def oracle_rows(con: duckdb.DuckDBPyConnection, name: str) -> tuple[list[str], list[tuple]]:
    frame = con.execute(ORACLE[name]).df()
    return sorted(frame.columns), normal(frame)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = with_settings(builder).config("spark.sql.shuffle.partitions", "8")
    spark = builder.config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        columns, found = spark_rows(spark, name, folder)
        middle = time.time()
        wanted_columns, wanted = oracle_rows(con, name)
        state = "ok" if (columns, found) == (wanted_columns, wanted) else "DIFFERENT"
        print(f"{name:28}{state:10}{len(found):8}{len(wanted):8}{middle - start:8.2f}{time.time() - middle:8.2f}", flush=True)
        if state != "ok":
            print(columns, wanted_columns)
            print(sorted(set(found) - set(wanted), key=repr)[:3])
            print(sorted(set(wanted) - set(found), key=repr)[:3])


if __name__ == "__main__":
    main()
