"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from basketry import RunWindow
from basketry import operators as op
from basketry.operators.mining import next_states
from basketry.operators.rules import next_splits
from basketry.sources import StarSchema, read_bucketed_orders, write_bucketed_orders
from verification.queries import ALL_DATES, ORDERS, WINDOW, queries_without_actions

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return StarSchema(spark, FOLDER)


@pytest.mark.parametrize("name", queries_without_actions())
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(queries_without_actions()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in plan


def test_top_k_limits_before_the_shuffle(spark, star):
    units = op.units_sold(star.order_lines(), star.products(), star.catalogue(), ALL_DATES, ORDERS)
    plan = plan_of(op.top_products(units))
    assert plan.count("WindowGroupLimit") == 2


def test_latest_snapshot_limits_before_the_shuffle(star):
    assert plan_of(op.latest_snapshot(star.partner_snapshots(), WINDOW)).count("WindowGroupLimit") == 2


def test_snapshot_days_reach_the_scan(star):
    plan = plan_of(op.latest_snapshot(star.partner_snapshots(WINDOW), WINDOW))
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_scan_reads_needed_columns_and_pushes_filters(star):
    plan = plan_of(op.basket_rows(star.order_lines(), star.products(), star.catalogue(), WINDOW, ORDERS))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in plan
    assert "GreaterThanOrEqual(o_orderdate,2000-08-02T00:00)" in plan
    assert "In(r_name, [AMERICA,EUROPE])" in plan


@pytest.fixture
def small_skew(spark):
    """Everything shuffles, and anything above a few kilobytes counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_product_splits(spark, small_skew):
    """A product in most lines: its join partition is read by several tasks, and nothing is lost."""
    orders = spark.range(20000, numPartitions=8).selectExpr(
        "id as order_id", "date '2024-02-01' as registered_date", "2 as business_type_id",
        "'Chile' as country_name", "1 as country_id", "id % 50 as partner_id",
        "if(id % 3 > 0, 1, id % 500) as product_id",
    )
    products = spark.range(500).selectExpr(
        "id", "cast(10000000 + id as string) as gtin", "cast(null as string) as integration_code"
    )
    rows = op.matched_lines(
        orders, products, products.select("id", "gtin"), RunWindow(dt.date(2024, 3, 1))
    )
    baskets = op.baskets(rows)
    assert len(baskets.collect()) == 20000
    assert "skew=true" in baskets._jdf.queryExecution().executedPlan().toString()


def test_hot_prefix_splits(spark, small_skew):
    """States of one prefix: the join that prunes them is split too."""
    states = spark.range(20000, numPartitions=8).selectExpr(
        "1L as node", "if(id % 3 > 0, 1, cast(id % 100 as int)) as item",
        "transform(sequence(1, 4), i -> cast(101 + (id * i) % 97 as int)) as tail", "1L as weight",
        "9L as least",
    )
    level = spark.range(100).selectExpr(
        "1L as node", "cast(id as int) as item", "id as child",
        "transform(sequence(101, 180), i -> struct(i as next, 9L as n)) as extensions",
    )
    pruned = next_states(states, level)
    pruned.collect()
    assert "skew=true" in pruned._jdf.queryExecution().executedPlan().toString()


def test_bucketed_orders_become_baskets_without_an_exchange(spark, star):
    write_bucketed_orders(star.brand_rows(), "bucketed_rows", 8)
    try:
        baskets = op.baskets(read_bucketed_orders(spark, "bucketed_rows"))
        assert len(baskets.collect()) > 100
        plan = baskets._jdf.queryExecution().executedPlan().toString()
        assert "collect_set" in plan and "Exchange" not in plan
        assert sorted(baskets.collect()) == sorted(op.baskets(star.brand_rows()).collect())
    finally:
        spark.sql("drop table bucketed_rows")


def pairs_with_a_hot_item(spark):
    names = "format_string('item %05d', id)"
    rest = spark.range(20000, numPartitions=8)

    def itemsets(rows, items, n):
        return rows.selectExpr("1 as country_id", f"array({items}) as items", f"{n}L as n", "20000L as n_baskets")

    sets = itemsets(spark.range(1), "'hot'", 20000).union(itemsets(rest, names, 5))
    return sets.union(itemsets(rest, f"'hot', {names}", 3)).selectExpr("*", "size(items) as number_of_items")


def test_hot_side_of_rules_splits(spark, small_skew, tmp_path):
    """One item is a side of every rule: the join that names it is split, and nothing is lost."""
    path = str(tmp_path / "itemsets")
    pairs_with_a_hot_item(spark).write.parquet(path)
    rules = op.association_rules(spark.read.parquet(path), min_threshold=0.0)
    assert sorted({(r.n, r.n_a, r.n_c) for r in rules.collect()}) == [(3, 5, 20000), (3, 20000, 5)]
    plan = rules._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_hot_side_splits_where_rules_grow(spark, small_skew):
    """Rules that share their left and right sides: both joins of a step are split."""
    below = spark.range(20000, numPartitions=8).selectExpr(
        "if(id % 3 > 0, 7L, id + 100) as number", "id + 50000 as item", "8L as rest", "1L as n", "2L as n_rest", "2L as n_item",
        "20000L as n_baskets", "true as last",
    )
    states = spark.range(10000, numPartitions=8).selectExpr("if(id % 3 > 0, 7L, id + 100) as antecedent", "if(id % 2 = 0, 8L, id) as consequent", "0L as top")
    moves = next_splits(states.withColumns({c: F.lit(1).cast("long") for c in ("n", "n_a", "n_c", "n_baskets", "n_least")}).filter("antecedent > 7 or consequent = 1"), below)
    moves.collect()
    assert "skew=true" in moves._jdf.queryExecution().executedPlan().toString()


def test_rules_join_on_numbers_only(spark, tmp_path):
    path = str(tmp_path / "itemsets")
    pairs_with_a_hot_item(spark).limit(50).write.parquet(path)
    with RecordedPlans(spark) as plans:
        op.association_rules(spark.read.parquet(path)).collect()
        op.recommendation_pairs(spark.read.parquet(path)).collect()
    joins = [line for plan in plans for line in plan.splitlines() if re.search(r"Join \[", line)]
    assert joins and not any(re.search(r"\b(items|ids|left|known|antecedents|consequents)#", re.search(r"Join (\[.*?\], \[.*?\])", line)[1]) for line in joins)


class RecordedPlans:
    """Final plans of all queries that run inside."""

    def __init__(self, spark) -> None:
        self.spark, self.plans = spark, []

    def __enter__(self) -> list[str]:
        self.write, self.collect = DataFrameWriter.parquet, DataFrame.collect
        plans = self.plans

        def parquet(writer, *a, **b):
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
            return self.write(writer, *a, **b)

        def collect(frame):
            rows = self.collect(frame)
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
            return rows

        DataFrameWriter.parquet, DataFrame.collect = parquet, collect
        return plans

    def __exit__(self, *_) -> None:
        DataFrameWriter.parquet, DataFrame.collect = self.write, self.collect
