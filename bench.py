"""Headline queries, each written in full; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs after a warm-up).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from basketry import MiningParams
from basketry.session import with_settings
from verification import queries as q

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MINING = MiningParams()
# A least count well above 1: with 1, the run would measure the subsets of its baskets.
DAILY = MiningParams(min_count_floor=5)

HEADLINES = {
    "ranking_topk": q.ranking_topk,
    "basket_rows": q.basket_rows,
    "latest_snapshot": q.latest_snapshot,
    "frequent_itemsets": lambda s, f: q.frequent_itemsets(s, f, MINING),
    "frequent_itemsets_fpgrowth": lambda s, f: q.frequent_itemsets_fpgrowth(s, f, MINING),
    "recommendation_pairs": lambda s, f: q.recommendation_pairs(s, f, MINING),
    "association_rules": q.association_rules,
    "history_upsert": q.history_upsert,
    "daily_run": lambda s, f: q.daily_run(s, f, DAILY),
    "mba_documents": lambda s, f: q.mba_documents(s, f, MINING),
}


def write(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as checkpoints:
        measure(checkpoints)


def measure(checkpoints: str) -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    spark = (
        with_settings(builder)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", checkpoints)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in HEADLINES.items():
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            write(query(spark, FOLDER))
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    scale = re.search(r"sf([\d.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
