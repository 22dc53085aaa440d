"""Checks of what the joins rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_rows, n_keys, max_copies): what joining on ``keys`` to ``df`` can multiply by."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
            F.count("*").alias("n_keys"),
            F.coalesce(F.max("copies"), F.lit(0)).alias("max_copies"),
        )
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after checking that no two rows share the keys."""
    report = fanout(df, keys).first()
    if report.max_copies > 1:
        raise ValueError(
            f"{report.n_rows} rows share {report.n_keys} values of {', '.join(keys)}"
        )
    return df
