"""One query per operator, over the whole tables of a star-schema folder."""

from __future__ import annotations

import atexit
import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import MiningParams, OrderFilter, RunWindow, Workspace
from basketry import operators as op
from basketry.operators.documents import MBA, RANKING
from basketry.plans import run_daily
from basketry.sinks import read_history, read_outbox, upsert_history
from basketry.sources import StarSchema, read_bucketed_orders, write_bucketed_orders

WINDOW = RunWindow(dt.date(2001, 8, 2), from_days=365, to_days=1)
ALL_DATES = RunWindow(dt.date(2001, 8, 2), from_days=3650, to_days=0)
ORDERS = OrderFilter(business_type=2, countries=("AMERICA", "EUROPE"))
MINING = MiningParams(min_support=0.005)
LEAST_LEVERAGE = 0.0002
HISTORY_DAYS = (dt.date(2001, 8, 1), dt.date(2001, 8, 2))
HISTORY_LIFTS = (1.2, 1.4)
SEPARATOR = "|"

DOCUMENT = (
    "country_id string, criteria string, type string, code string, "
    "recommendation array<struct<code: string, metric: string, metric_value: string>>"
)

Query = Callable[[SparkSession, str], DataFrame]


def _text(column: str) -> Column:
    return F.array_join(column, SEPARATOR).alias(column)


def workspace(spark: SparkSession) -> Workspace:
    """A workspace that outlives the query, since its rows are read later; dropped when Python ends."""
    made = Workspace(spark)
    atexit.register(_drop, made)
    return made


def _drop(made: Workspace) -> None:
    if made.spark.sparkContext._jsc is not None:
        made.drop()


def _itemsets(spark: SparkSession, folder: str, mining: MiningParams = MINING) -> DataFrame:
    carts = op.baskets(StarSchema(spark, folder).brand_rows())
    return op.frequent_itemsets(carts, mining, workspace(spark))


def _repeated_categories(star: StarSchema) -> DataFrame:
    return star.table("nation").select(F.col("n_regionkey").alias("business_category_id"))


def order_window(spark: SparkSession, folder: str) -> DataFrame:
    heads = StarSchema(spark, folder).order_heads()
    return op.order_window(heads, WINDOW).select("order_id", "registered_date")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return op.order_lines(StarSchema(spark, folder).nested_orders())


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_snapshot(StarSchema(spark, folder).partner_snapshots(WINDOW), WINDOW)


def normalized_codes(spark: SparkSession, folder: str) -> DataFrame:
    return op.normalized_codes(StarSchema(spark, folder).products())


def basket_rows(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return op.basket_rows(star.order_lines(), star.products(), star.catalogue(), WINDOW, ORDERS)


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    return op.baskets(StarSchema(spark, folder).brand_rows()).select(
        "country_id", "order_id", F.size("items").alias("n_items"), _text("items")
    )


def basket_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.basket_counts(op.baskets(StarSchema(spark, folder).brand_rows()), MINING)


def frequent_itemsets(
    spark: SparkSession, folder: str, mining: MiningParams = MINING
) -> DataFrame:
    return _itemsets(spark, folder, mining).withColumn("items", _text("items"))


def frequent_itemsets_levelwise(spark: SparkSession, folder: str) -> DataFrame:
    return frequent_itemsets(spark, folder, replace(MINING, algorithm="levelwise"))


def frequent_itemsets_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Levels for what more than 200 orders hold, bit arrays for the rest."""
    return frequent_itemsets(spark, folder, replace(MINING, local_rows=200))


def frequent_itemsets_fpgrowth(
    spark: SparkSession, folder: str, mining: MiningParams = MINING
) -> DataFrame:
    return frequent_itemsets(spark, folder, replace(mining, algorithm="fpgrowth"))


def closed_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    """With a least count of 1: the intersections of baskets."""
    carts = op.baskets(StarSchema(spark, folder).brand_rows())
    return op.closed_itemsets(carts, replace(MINING, min_support=1e-7, local_rows=500), workspace(spark)).withColumn("items", _text("items"))


def expanded_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    """All frequent itemsets, from the closed ones."""
    carts, own = op.baskets(StarSchema(spark, folder).brand_rows()), workspace(spark)
    return op.expanded(op.closed_itemsets(carts, MINING, own), own).withColumn("items", _text("items"))


def bucketed_baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Baskets from order facts that lie in buckets."""
    own = workspace(spark)
    table = f"orders_{own.path[-32:]}"
    write_bucketed_orders(StarSchema(spark, folder).brand_rows(), table, 16, own.folder("orders"))
    return op.baskets(read_bucketed_orders(spark, table)).select("country_id", "order_id", F.size("items").alias("n_items"), _text("items"))


def moving_window(spark: SparkSession, folder: str) -> DataFrame:
    """The orders in fifths, as days: four of them counted in full, then the window moves on by one."""
    carts, own = op.baskets(StarSchema(spark, folder).brand_rows()), workspace(spark)
    carts = own.save(carts.withColumn("part", F.col("order_id") % 5), "parts")
    days = [dt.date(2024, 1, 1 + k) for k in range(5)]
    moving = op.MovingItemsets(spark, own.folder("moving"), MINING)
    for k, day in enumerate(days):
        moving.store(day, carts.filter(F.col("part") == k))
    moving.itemsets(days[:4], own)
    return moving.itemsets(days[1:], own).withColumn("items", _text("items"))


def frequent_itemsets_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Baskets above four items (or what the country's limit rises to) are looked up, not expanded."""
    return frequent_itemsets(spark, folder, replace(MINING, wide_basket=4))


def association_rules(spark: SparkSession, folder: str) -> DataFrame:
    return op.association_rules(_itemsets(spark, folder), workspace=workspace(spark)).select(
        "country_id", _text("antecedents"), _text("consequents"), "n", "n_a", "n_c",
        "support", "confidence", "lift",
    )


def rule_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rules by another metric, with all metrics; an infinite conviction shows as null."""
    finite = F.when(F.col("conviction") < float("inf"), F.col("conviction"))
    return op.association_rules(_itemsets(spark, folder), "confidence", 0.15, workspace=workspace(spark)).select(
        "country_id", _text("antecedents"), _text("consequents"),
        "antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage",
        finite.alias("conviction"),
    )


def recommendation_pairs(
    spark: SparkSession, folder: str, mining: MiningParams = MINING
) -> DataFrame:
    return op.recommendation_pairs(_itemsets(spark, folder, mining), workspace=workspace(spark))


def association_rules_exact(spark: SparkSession, folder: str) -> DataFrame:
    """A threshold that many rules meet exactly, compared in whole numbers."""
    rules = op.association_rules(_itemsets(spark, folder), "lift", 1.25, exact=True, workspace=workspace(spark))
    return rules.select("country_id", _text("antecedents"), _text("consequents"), "n", "n_a", "n_c")


def leverage_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs by a metric that they do not carry otherwise."""
    return op.recommendation_pairs(_itemsets(spark, folder), "leverage", LEAST_LEVERAGE, workspace=workspace(spark))


def pair_best_metric(spark: SparkSession, folder: str) -> DataFrame:
    return op.pair_best_metric(recommendation_pairs(spark, folder))


def units_sold(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return op.units_sold(star.order_lines(), star.products(), star.catalogue(), WINDOW, ORDERS)


def ranking_topk(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return op.ranking_topk(
        star.order_lines(),
        star.products(),
        star.catalogue(),
        star.partner_snapshots(WINDOW),
        star.categories(),
        WINDOW,
        ORDERS,
    )


def ranking_top5(spark: SparkSession, folder: str) -> DataFrame:
    """A short ranking over all dates, so that most partners have more codes than it keeps."""
    star = StarSchema(spark, folder)
    return op.ranking_topk(
        star.order_lines(),
        star.products(),
        star.catalogue(),
        star.partner_snapshots(ALL_DATES),
        star.categories(),
        ALL_DATES,
        ORDERS,
        k=5,
    )


def ranking_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Units when dimension keys repeat: every code listed twice, five categories per key."""
    star = StarSchema(spark, folder)
    return op.ranked_units(
        star.order_lines(),
        star.products(),
        star.catalogue().unionAll(star.catalogue()),
        star.partner_snapshots(WINDOW),
        _repeated_categories(star),
        WINDOW,
        ORDERS,
    )


def _entries(documents: DataFrame, *more: str) -> DataFrame:
    return documents.select(
        "country_id", "criteria", "type", "code", *more, F.posexplode("recommendation")
    ).select(
        "country_id",
        "criteria",
        "type",
        "code",
        *more,
        (F.col("pos") + 1).alias("place"),
        F.col("col.code").alias("recommended"),
        F.col("col.metric").alias("metric"),
        F.col("col.metric_value").cast("double").alias("metric_value"),
    )


def _read_messages(messages: DataFrame) -> DataFrame:
    envelope = F.from_json("message", "struct<default: string>")["default"]
    return messages.select(F.from_json(envelope, DOCUMENT).alias("document"), "event_type").select(
        "document.*", "event_type"
    )


def mba_documents(
    spark: SparkSession, folder: str, mining: MiningParams = MINING
) -> DataFrame:
    return _entries(op.mba_documents(recommendation_pairs(spark, folder, mining)))


def mba_documents_support(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by another metric, whose values have many digits."""
    return _entries(op.mba_documents(recommendation_pairs(spark, folder), "support"))


def ranking_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _entries(op.ranking_documents(ranking_topk(spark, folder)))


def mba_messages(spark: SparkSession, folder: str) -> DataFrame:
    documents = op.mba_documents(recommendation_pairs(spark, folder))
    return _entries(_read_messages(op.to_messages(documents, MBA)), "event_type")


def ranking_messages(spark: SparkSession, folder: str) -> DataFrame:
    documents = op.ranking_documents(ranking_topk(spark, folder))
    return _entries(_read_messages(op.to_messages(documents, RANKING)), "event_type")


def listed_codes(spark: SparkSession, folder: str) -> DataFrame:
    star = StarSchema(spark, folder)
    return op.listed_codes(star.products(), star.catalogue())


def partner_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Five categories per key, and snapshots whose category is not listed."""
    star = StarSchema(spark, folder)
    return op.partner_copies(star.partner_snapshots(), _repeated_categories(star), WINDOW)


def fanout(spark: SparkSession, folder: str) -> DataFrame:
    return op.fanout(_repeated_categories(StarSchema(spark, folder)), ["business_category_id"])


def daily_run(
    spark: SparkSession, folder: str, mining: MiningParams = MiningParams()
) -> DataFrame:
    """Everything from nested orders to the outbox, read back from there."""
    sources = StarSchema(spark, folder).sources(WINDOW)
    out = run_daily(sources, WINDOW, workspace(spark).folder("daily"), ORDERS, mining)
    return _entries(_read_messages(read_outbox(spark, out.outbox)), "event_type")


def daily_run_leverage(spark: SparkSession, folder: str) -> DataFrame:
    """The daily run by a metric that pairs do not carry otherwise."""
    sources = StarSchema(spark, folder).sources(WINDOW)
    out = run_daily(sources, WINDOW, workspace(spark).folder("daily"), ORDERS, metric="leverage", min_threshold=0.002)
    return _entries(_read_messages(read_outbox(spark, out.outbox)), "event_type")


def history_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two days, the second one written twice with different pairs."""
    own = workspace(spark)
    pairs = own.save(recommendation_pairs(spark, folder), "pairs")
    path = own.folder("history")
    first, second = HISTORY_DAYS
    low, high = HISTORY_LIFTS
    upsert_history(pairs.filter(F.col("lift") >= low), path, first)
    upsert_history(pairs.filter(F.col("lift") >= high), path, second)
    upsert_history(pairs, path, second)
    return read_history(spark, path, pairs.schema)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        order_window,
        order_lines,
        latest_snapshot,
        normalized_codes,
        basket_rows,
        baskets,
        basket_counts,
        frequent_itemsets,
        frequent_itemsets_levelwise,
        frequent_itemsets_mixed,
        frequent_itemsets_fpgrowth,
        frequent_itemsets_wide,
        closed_itemsets,
        expanded_itemsets,
        moving_window,
        bucketed_baskets,
        association_rules,
        rule_metrics,
        association_rules_exact,
        recommendation_pairs,
        leverage_pairs,
        pair_best_metric,
        units_sold,
        ranking_topk,
        ranking_top5,
        ranking_fanout,
        mba_documents,
        mba_documents_support,
        ranking_documents,
        mba_messages,
        ranking_messages,
        listed_codes,
        partner_copies,
        fanout,
        daily_run,
        daily_run_leverage,
        history_upsert,
    )
}


def queries_without_actions() -> dict[str, Query]:
    """Those whose plan runs from the tables to the result, with nothing written in between."""
    one_plan = (
        order_window, order_lines, latest_snapshot, normalized_codes, basket_rows, baskets,
        basket_counts, units_sold, ranking_topk, ranking_top5, ranking_fanout,
        ranking_documents, ranking_messages, listed_codes, partner_copies, fanout,
    )
    return {query.__name__: query for query in one_plan}
