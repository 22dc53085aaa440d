"""Made-up baskets of any number, for timing: ``python -m verification.made_up [orders] [algorithm ...]``.

About 3000 items with a skewed frequency, 6 on average in a basket; one of six countries has more than half the orders.
Spark derives every basket from its number, so any number of orders takes no memory.
"""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import MiningParams, Workspace
from basketry.operators import frequent_itemsets
from basketry.params import ALGORITHMS
from basketry.session import with_settings

ITEMS = 3000
MOST = 11  # items drawn per basket; 1 to MOST, 6 on average
SKEW = 2.5


def made_baskets(spark: SparkSession, orders: int, wide: int = 0) -> DataFrame:
    """(country_id, order_id, items): ``orders`` baskets, and ``wide`` more that hold nearly all items."""
    draw = lambda *of: F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / float(1 << 30)
    country = F.greatest(F.lit(0), F.floor(draw("order_id", F.lit(-1)) * 12).cast("int") - 6)
    size = F.floor(draw("order_id", F.lit(-2)) * MOST).cast("int") + 1
    item = lambda k: F.floor(F.pow(draw("order_id", k), F.lit(SKEW)) * ITEMS).cast("int")
    code = lambda i: F.format_string("item %05d", i)
    rows = spark.range(orders).withColumnRenamed("id", "order_id").withColumn("country_id", country)
    drawn = F.transform(F.sequence(F.lit(1), size), item)
    rows = rows.select("country_id", "order_id", F.sort_array(F.transform(F.array_distinct(drawn), code)).alias("items"))
    every = F.transform(F.sequence(F.lit(0), F.lit(ITEMS - 2)), code)
    return rows.unionByName(spark.range(wide).select(F.lit(1).alias("country_id"), (-1 - F.col("id")).alias("order_id"), every.alias("items")))


def main() -> None:
    orders = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    with tempfile.TemporaryDirectory(prefix="made-up-") as folder:
        builder = with_settings(SparkSession.builder.master("local[8]")).config("spark.ui.enabled", "false")
        spark = builder.config("spark.driver.memory", "12g").config("spark.checkpoint.dir", folder).config("spark.sql.shuffle.partitions", "16").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        for algorithm in sys.argv[2:] or ALGORITHMS:
            for _ in range(3):
                with Workspace(spark) as ws:
                    start = time.perf_counter()
                    found = frequent_itemsets(made_baskets(spark, orders), MiningParams(min_support=0.002, algorithm=algorithm), ws)
                    print(f"{algorithm:10} {orders} orders {found.count()} itemsets {time.perf_counter() - start:.1f} s", flush=True)
        spark.stop()


if __name__ == "__main__":
    main()
