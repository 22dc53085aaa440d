"""Session settings the library runs well with. None of them changes a result."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order or product is split even where that costs the next step a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Mining runs many short, distinct stages; the default of 100 classes recompiles them each time.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Baskets are many small groups; the default of 128 groups sorts nearly all of them. A task holds at
    # most this many before it sorts and spills.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with the settings; call ``config`` on the result to change any of them."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
