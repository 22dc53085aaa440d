"""Frequent itemsets of every country, in one set of jobs.

Pattern growth, breadth first. Every frequent itemset that leads to larger ones is a *node* with a
number. A *state* is ``(node, item, tail, weight, least)``: ``weight`` orders hold the node's items and
``item``, and of the items that come after it exactly ``tail``; ``least`` is the count below which an
itemset of the country is of no use. Counting a level is one explode of the tails and one sum over
keys of fixed width. The next level's states keep of each tail only what was frequent, and equal
states merge into one weighted row.

A level is a written table with one row per ``(node, item)`` that has frequent extensions: the number
of the ``child`` node they make, its ``path`` of items, and the extensions with their counts.

Items are numbered per country from rarest to most frequent. A path then starts with its rarest
item, so the item a third of all orders hold comes last and leads no states of its own.

``vertical`` and ``fpgrowth`` take levels only for what is large. A state's item that at most ``local_rows``
orders hold with its node goes, with all its tails, to one task that finds everything below at once
(``operators.growth``); the levels go on with the others. In sparse countries pairs are counted first, which cuts
most tails. ``levelwise`` takes levels for all.

Sizes. A country has at most ``mean basket size / min_support`` frequent items, and likewise
``mean number of k-subsets / min_support`` frequent k-itemsets, however many orders it has: these
tables stay small as the data grows. Whether one is broadcast is Catalyst's decision from the size
of the written table; beyond its threshold the joins shuffle, and adaptive execution splits skew.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.baskets import with_min_count
from basketry.operators.growth import MINERS, grown_below
from basketry.params import MiningParams
from basketry.workspace import Workspace

log = logging.getLogger(__name__)

BLOW_UP = (
    "a country has a least count of 1: every subset of its baskets is frequent; "
    "consider min_count_floor or max_len"
)
PREFIX = ("node", "item")
ITEMSET = ("node", "item", "next")


def frequent_itemsets(
    carts: DataFrame, params: MiningParams = MiningParams(), workspace: Workspace | None = None
) -> DataFrame:
    """(country_id, items, number_of_items, n, n_baskets, support) of the baskets.

    ``items`` is sorted. The result is a table in the workspace.
    """
    workspace = workspace or Workspace(carts.sparkSession)
    carts = workspace.save(carts, "baskets")
    counts = workspace.save(item_counts(carts), "item-counts")
    everything = counts.filter("gtin is null").select("country_id", F.col("n").alias("n_baskets"))
    wanted = with_min_count(everything, params)
    totals, least = workspace.save_measured(
        wanted.withColumn("child", F.monotonically_increasing_id()),
        "totals",
        min_count=F.min("min_count"),
    )
    if least["min_count"] == 1 and params.max_len is None:
        log.warning(BLOW_UP)
    sets = grown_itemsets(carts, counts, totals, params, workspace)
    return workspace.save(
        sets.join(totals, "country_id").select(
            "country_id",
            "items",
            F.size("items").alias("number_of_items"),
            "n",
            "n_baskets",
            (F.col("n") / F.col("n_baskets")).alias("support"),
        ),
        "itemsets",
    )


def grown_itemsets(
    carts: DataFrame,
    counts: DataFrame,
    totals: DataFrame,
    params: MiningParams,
    workspace: Workspace,
) -> DataFrame:
    """(country_id, items, n) of the baskets; levels for what is large, one task per node and item for the rest."""
    items, seen = workspace.save_measured(
        frequent_items(counts, totals),
        "items",
        dense=F.count_if(F.col("dense")),
        large=F.count_if(F.col("dense") & (F.col("n") > params.local_rows)),
        sparse=F.count_if(~F.col("dense")),
    )
    singles = items.select("country_id", F.array("gtin").alias("items"), "n")
    if params.max_len == 1:
        return singles
    coded, widest = workspace.save_measured(
        coded_baskets(carts, items), "coded", size=F.max(F.size("ids"))
    )
    miner, limit = MINERS.get(params.algorithm), params.local_rows
    level, wide = roots(totals), None
    if (widest["size"] or 0) > params.wide_basket:
        miner = None  # their orders are added level by level
        level = roots(workspace.save(wide_limits(coded, totals, params), "limits"))
        wide = WideBaskets(at_roots(coded, level).filter(F.size("ids") > F.col("widest")), workspace)
        known = at_roots(coded, level).filter(F.size("ids") <= F.col("widest"))
    else:
        level = workspace.save(with_large(level, items, limit), "roots") if miner else level
        known = at_roots(coded, level)
    known = known.withColumnRenamed("ids", "tail")
    found: list[DataFrame] = []

    def finished(states: DataFrame, level: DataFrame, size: int) -> DataFrame:
        """The other states, once the sets below the local ones are found."""
        most = None if params.max_len is None else params.max_len - size
        nodes = level.select(F.col("child").alias("node"), "country_id", "path")
        below = grown_below(states.filter("local"), MINERS[params.algorithm], most).join(nodes, "node")
        ids = F.concat("path", F.array("item"), "ids")
        found.append(workspace.save(below.select("country_id", ids.alias("ids"), "n"), f"below-{size}"))
        return states.filter("not local").drop("local")

    if miner:
        dense, parts = known.filter("large is not null"), []
        if seen["dense"]:
            others = finished(split_tails(dense), level, 1)
        if seen["large"]:
            parts.append(others)
        if seen["sparse"]:
            parts.append(split_tails(known.filter("large is null").drop("large")))
    else:
        parts = [split_tails(known)]
    size = 1
    while parts:
        states = reduce(DataFrame.unionByName, parts)
        size += 1
        counts = extension_counts(states)
        if wide:
            counts = wide.add_to(counts)
        level, kept = workspace.save_measured(
            next_level(counts, level), f"level-{size}", rows=F.count("*")
        )
        if not kept["rows"]:
            break
        found.append(level.select("country_id", "path", F.inline("extensions")).select(
            "country_id", F.concat("path", F.array("next")).alias("ids"), "n"))
        if size == params.max_len:
            break
        more = next_states(states, level, limit if miner else None)
        going = F.count_if(~F.col("local")) if miner else F.count("*")
        states, left = workspace.save_measured(more, f"states-{size}", rows=going)
        if miner:
            states = finished(states, level, size)
        if wide:
            wide.descend(level)
        elif not left["rows"]:
            break
        parts = [states]
    return decoded(reduce(DataFrame.unionByName, found), items).unionByName(singles) if found else singles


def item_counts(carts: DataFrame) -> DataFrame:
    """(country_id, gtin, n): baskets per item, and under the null item all baskets, in one pass."""
    everything = F.array(F.lit(None).cast("string"))
    return (
        carts.select("country_id", F.explode(F.concat("items", everything)).alias("gtin"))
        .groupBy("country_id", "gtin")
        .agg(F.count("*").alias("n"))
    )


def frequent_items(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(country_id, gtin, id, n, dense) with ids from the rarest item of a country to its most frequent.

    In a ``dense`` country a pair of its items is frequent on average, so that counting pairs would prune little.
    """
    country = Window.partitionBy("country_id")
    rarest_first = country.orderBy("n", "gtin")
    dense = F.pow(F.avg("n").over(country), F.lit(2)) >= F.col("n_baskets") * F.col("min_count")
    return (
        counts.filter("gtin is not null")
        .join(totals, "country_id")
        .filter("n >= min_count")
        .select("country_id", "gtin", F.row_number().over(rarest_first).alias("id"), "n", dense.alias("dense"))
    )


def coded_baskets(carts: DataFrame, items: DataFrame, least: int = 2) -> DataFrame:
    """(country_id, ids, weight): baskets cut down to frequent items, and how many are equal.

    A basket with fewer than two frequent items supports no larger itemset and goes, or with fewer than ``least``.
    """
    return (
        carts.select("country_id", "order_id", F.explode("items").alias("gtin"))
        .join(items.select("country_id", "gtin", "id"), ["country_id", "gtin"])
        .groupBy("country_id", "order_id")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .filter(F.size("ids") >= least)
        .groupBy("country_id", "ids")
        .agg(F.count("*").alias("weight"))
    )


def roots(countries: DataFrame) -> DataFrame:
    """The level above the single items: one node without items per country.

    Without limits for wide baskets, all that counts is the least count itself.
    """
    if "least" not in countries.columns:
        countries = countries.withColumn("least", F.col("min_count"))
    return countries.withColumn("path", F.array().cast("array<int>"))


def with_large(roots: DataFrame, items: DataFrame, limit: int) -> DataFrame:
    """``roots`` with the ids of the country's items that more than ``limit`` orders hold; null if all are to go on."""
    above = F.collect_list(F.when(F.col("n") > limit, F.col("id")))
    large = items.groupBy("country_id", "dense").agg(above.alias("large"))
    large = large.select("country_id", F.when(F.col("dense"), F.col("large")).alias("large"))
    return roots.join(large, "country_id", "left")


def at_roots(coded: DataFrame, roots: DataFrame) -> DataFrame:
    """The baskets with the node of their country."""
    return coded.join(roots.drop("path").withColumnRenamed("child", "node"), "country_id")


def split_tails(tails: DataFrame) -> DataFrame:
    """For each item of a tail with more behind it: the state of that item; ``local`` if it is not among the ``large``."""
    large = [c for c in tails.columns if c == "large"]
    local = [F.coalesce(~F.array_contains("large", F.col("item")), F.lit(False)).alias("local") for _ in large]
    return (
        # Without "outer" Spark would work the tail out again to filter empty ones before the explode.
        tails.select(
            "node", "tail", "weight", "least", *large, F.posexplode_outer("tail").alias("place", "item")
        )
        .filter(F.col("place") < F.size("tail") - 1)
        .select(
            "node",
            "item",
            F.slice("tail", F.col("place") + 2, F.size("tail")).alias("tail"),
            "weight",
            "least",
            *local,
        )
    )


def extension_counts(states: DataFrame) -> DataFrame:
    """(node, item, next, n) of the itemsets one item larger that are worth keeping."""
    return (
        states.select("node", "item", F.explode("tail").alias("next"), "weight", "least")
        .groupBy(*ITEMSET, "least")
        .agg(F.sum("weight").alias("n"))
        .filter("n >= least")
        .drop("least")
    )


def next_level(counts: DataFrame, above: DataFrame) -> DataFrame:
    """The frequent ones of the counted itemsets as a level, below the nodes of ``above``.

    A child's number is given in the task that writes its row, and is read from there only.
    """
    nodes = above.select(F.col("child").alias("node"), "country_id", "min_count", "path")
    return (
        counts.groupBy(*PREFIX)
        .agg(F.sort_array(F.collect_list(F.struct("next", "n"))).alias("extensions"))
        .join(nodes, "node")
        .withColumn("extensions", F.filter("extensions", lambda e: e["n"] >= F.col("min_count")))
        .filter(F.size("extensions") > 0)
        .select(
            *PREFIX,
            F.monotonically_increasing_id().alias("child"),
            "country_id",
            "min_count",
            F.concat("path", F.array("item")).alias("path"),
            "extensions",
        )
    )


def next_states(states: DataFrame, level: DataFrame, limit: int | None = None) -> DataFrame:
    """The states of the level's nodes; with a ``limit``, those of extensions up to it are ``local``.

    The intersection keeps the order of its first array, sorted like the tails, and hashes the second,
    which is the shorter one.
    """
    of = lambda sets: F.transform(sets, lambda e: e["next"])
    large = [] if limit is None else [of(F.filter("extensions", lambda e: e["n"] > limit)).alias("large")]
    nodes = level.select(*PREFIX, "child", F.col("extensions.next").alias("kept"), *large)
    tails = states.join(nodes, list(PREFIX)).select(
        F.col("child").alias("node"), F.array_intersect("kept", "tail").alias("tail"), "weight", "least", *["large" for _ in large]
    )
    split = split_tails(tails)
    keys = [c for c in split.columns if c != "weight"]
    return split.groupBy(*keys).agg(F.sum("weight").alias("weight"))


def decoded(sets: DataFrame, items: DataFrame) -> DataFrame:
    """(country_id, items, n): the sets (country_id, ids, n), of codes again."""
    return (
        sets.withColumn("row", F.monotonically_increasing_id())
        .select("row", "country_id", "n", F.explode("ids").alias("id"))
        .join(items.select("country_id", "id", "gtin"), ["country_id", "id"])
        .groupBy("row", "country_id", "n")
        .agg(F.sort_array(F.collect_list("gtin")).alias("items"))
        .select("country_id", "items", "n")
    )


def wide_limits(coded: DataFrame, totals: DataFrame, params: MiningParams) -> DataFrame:
    """(country_id, child, min_count, least, widest): up to how many items baskets are expanded.

    Expanding a basket costs the square of its size. ``widest`` is the smallest size, not below
    ``params.wide_basket``, that leaves at most half of ``min_count`` orders above it. ``least`` is
    ``min_count`` less those orders: an itemset that the other baskets hold less often than that
    cannot become frequent through the wide ones.
    """
    sizes = coded.groupBy("country_id", F.size("ids").alias("size")).agg(
        F.sum("weight").alias("orders")
    )
    country = Window.partitionBy("country_id")
    larger = country.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    smallest = F.min(F.when(F.col("above") * 2 <= F.col("min_count"), F.col("size"))).over(country)
    return (
        sizes.withColumn("above", F.coalesce(F.sum("orders").over(larger), F.lit(0)))
        .join(totals, "country_id")
        .withColumn("widest", F.greatest(smallest, F.lit(params.wide_basket)))
        .groupBy("country_id", "child", "min_count", "widest")
        .agg(F.sum(F.when(F.col("size") > F.col("widest"), F.col("orders")).otherwise(0)).alias("n_wide"))
        .select(
            "country_id",
            "child",
            "min_count",
            (F.col("min_count") - F.col("n_wide")).alias("least"),
            "widest",
        )
    )


class WideBaskets:
    """Exact counts of the few very wide baskets, without expanding them.

    Only candidates that the other baskets leave within reach are looked up: a basket known to hold
    a prefix meets the candidates of that prefix as one array, and keeps those among its own items.
    """

    def __init__(self, wide: DataFrame, workspace: Workspace) -> None:
        self.workspace = workspace
        baskets = workspace.save(
            wide.select(F.monotonically_increasing_id().alias("basket"), "node", "ids", "weight"),
            "wide",
        )
        self.held = baskets.select("basket", "node", F.explode("ids").alias("item"), "weight")
        self.contents = baskets.select("basket", "ids")
        self.matches = self.held

    def add_to(self, counts: DataFrame) -> DataFrame:
        """``counts`` of the other baskets plus the orders of the wide ones."""
        counts = self.workspace.save(counts, "narrow-counts")
        candidates = counts.groupBy(*PREFIX).agg(F.collect_list("next").alias("candidates"))
        held = self.held.join(candidates, list(PREFIX)).join(self.contents, "basket")
        among = F.explode_outer(F.array_intersect("candidates", "ids")).alias("next")
        self.matches = self.workspace.save(
            held.select("basket", *PREFIX, "weight", among).filter("next is not null"), "wide-matches"
        )
        found = self.matches.groupBy(*ITEMSET).agg(F.sum("weight").alias("n"))
        return counts.unionByName(found).groupBy(*ITEMSET).agg(F.sum("n").alias("n"))

    def descend(self, level: DataFrame) -> None:
        """Of the matches, go on with the itemsets of ``level``."""
        frequent = level.select(*PREFIX, "child", F.explode("extensions.next").alias("next"))
        self.held = self.matches.join(frequent, list(ITEMSET)).select(
            "basket", F.col("child").alias("node"), F.col("next").alias("item"), "weight"
        )
