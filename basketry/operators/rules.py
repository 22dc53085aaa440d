"""Association rules, and the item-to-item pairs made of them.

Itemsets get numbers, and a table tells for each itemset and item the number of the itemset without that item. Read
downwards it is a lattice, and where the item is the last one, a trie. Rules grow along it: a rule with one item on
the right comes from a row of the table; the next ones move an item from left to right, which is one step down for the
left side and one step along the trie for the right side. Items move in rising order, so every split is made once.
All these joins are on numbers.

A split is followed no further when no split that comes of it can reach the threshold: the left side loses items, so its
count only rises, and the right side's count is never below the least of the itemset's largest subsets. The metric with
these two counts is a bound, in doubles too, since each step of its computation is monotonic. For confidence this is
the rule that a failing consequent takes its supersets with it.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.metrics import METRICS, reaches
from basketry.params import METRIC, MIN_THRESHOLD
from basketry.workspace import Workspace

log = logging.getLogger(__name__)

PAIR_COLUMNS = ("country_id", "antecedents", "consequents", "support", "confidence", "lift")
COUNTS = ("n", "n_a", "n_c", "n_baskets")


@dataclass(frozen=True)
class Lattice:
    """Itemsets by number.

    ``named``: (number, country_id, items, n, n_baskets). ``sets``: (number, ids), the sorted numbers of its single items.
    ``below``: (number, item, rest, n, n_rest, n_item, n_baskets, last): the itemset without one item, and whether that
    is the last of its ids. ``size``: items of the largest.
    """

    named: DataFrame
    sets: DataFrame
    below: DataFrame
    size: int


@dataclass(frozen=True)
class Splits:
    """``rules``: (antecedent, consequent, n, n_a, n_c, n_baskets) by numbers; ``made``: splits looked at, by items on the right."""

    rules: DataFrame
    made: list[int]


def lattice(itemsets: DataFrame, ws: Workspace) -> Lattice:
    """Number the itemsets, and find each one's subsets with one item less.

    A subset is found by a hash of its ids and told by the ids, so a hash that two sets share does no harm.
    """
    number = F.monotonically_increasing_id().alias("number")
    named, seen = ws.save_measured(itemsets.select(number, "country_id", "items", "n", "n_baskets"), "numbered", size=F.max(F.size("items")))
    singles = named.filter(F.size("items") == 1).select("country_id", F.element_at("items", 1).alias("item"), F.col("number").alias("id"), F.col("n").alias("n_item"))
    members = named.select("number", "country_id", "n", "n_baskets", F.explode("items").alias("item")).join(singles, ["country_id", "item"])
    ids = members.groupBy("number", "n", "n_baskets").agg(F.sort_array(F.collect_list(F.struct("id", "n_item"))).alias("of"))
    sets = ws.save(ids.select("*", F.col("of.id").alias("ids"), F.xxhash64("of.id").alias("hash")), "sets")
    dropped = sets.filter(F.size("ids") > 1).select("number", "n", "n_baskets", "ids", F.inline("of"))
    dropped = dropped.withColumnRenamed("id", "item")
    rest = F.filter("ids", lambda x: x != F.col("item"))
    dropped = dropped.select("number", "n", "n_baskets", "item", "n_item", (F.col("item") == F.element_at("ids", -1)).alias("last"), F.inline(F.array(F.struct(rest.alias("left")))))
    known = sets.select("hash", F.col("ids").alias("known"), F.col("number").alias("rest"), F.col("n").alias("n_rest"))
    # Not written as an equation, which would make the arrays a key of the join.
    same = (F.col("left") <= F.col("known")) & (F.col("left") >= F.col("known"))
    below = dropped.withColumn("hash", F.xxhash64("left")).join(known, "hash").filter(same)
    below = below.select("number", "item", "last", "n", "n_baskets", "rest", "n_rest", "n_item")
    return Lattice(named, sets.select("number", "ids"), ws.save(below, "below"), seen["size"] or 0)


def grown_rules(known: Lattice, metric: str, min_threshold: float, exact: bool, ws: Workspace) -> Splits:
    """Every split of every itemset whose metric reaches the threshold, grown from one item on the right."""
    good = reaches(metric, min_threshold, exact)
    hopeful = reaches(metric, min_threshold, exact, bound=True)
    smallest = F.min("n_rest").over(Window.partitionBy("number"))
    states = known.below.withColumn("n_least", smallest).select(
        F.col("rest").alias("antecedent"), F.col("item").alias("consequent"), F.col("item").alias("top"),
        "n", F.col("n_rest").alias("n_a"), F.col("n_item").alias("n_c"), "n_baskets", "n_least",
    )
    found, made = [], []
    while len(made) < known.size - 1:
        states, seen = ws.save_measured(states, f"splits-{len(made) + 1}", rows=F.count(F.lit(1)))
        if not seen["rows"]:
            break
        made.append(seen["rows"])
        found.append(states.filter(good).select("antecedent", "consequent", *COUNTS))
        states = next_splits(states.filter(hopeful), known.below)
    log.info("splits made, by items on the right: %s", made)
    if not found:
        found = [states.select("antecedent", "consequent", *COUNTS).limit(0)]
    return Splits(reduce(DataFrame.unionByName, found), made)


def next_splits(states: DataFrame, below: DataFrame) -> DataFrame:
    """The splits with one item more on the right, an item behind those that are there."""
    step = below.select(F.col("number").alias("antecedent"), F.col("item").alias("moved"), F.col("rest").alias("next_a"), F.col("n_rest").alias("next_n_a"))
    path = below.filter("last").select(F.col("rest").alias("consequent"), F.col("item").alias("moved"), F.col("number").alias("next_c"), F.col("n").alias("next_n_c"))
    moves = states.join(step, "antecedent").filter(F.col("moved") > F.col("top"))
    return moves.join(path, ["consequent", "moved"]).select(
        F.col("next_a").alias("antecedent"), F.col("next_c").alias("consequent"), F.col("moved").alias("top"),
        "n", F.col("next_n_a").alias("n_a"), F.col("next_n_c").alias("n_c"), "n_baskets", "n_least",
    )


def association_rules(
    itemsets: DataFrame, metric: str = METRIC, min_threshold: float = MIN_THRESHOLD, exact: bool = False, workspace: Workspace | None = None
) -> DataFrame:
    """Rules whose metric reaches the threshold, with counts and all metrics.

    The threshold is met by the doubles that the metrics are; with ``exact`` by the whole numbers behind them.
    """
    _check(metric)
    ws = workspace or Workspace(itemsets.sparkSession)
    known = lattice(itemsets, ws)
    rules = grown_rules(known, metric, min_threshold, exact, ws).rules
    left = known.named.select(F.col("number").alias("antecedent"), "country_id", F.col("items").alias("antecedents"))
    right = known.named.select(F.col("number").alias("consequent"), F.col("items").alias("consequents"))
    named = rules.join(left, "antecedent").join(right, "consequent")
    return named.select("country_id", "antecedents", "consequents", *COUNTS, *[value().alias(name) for name, value in METRICS.items()])


def recommendation_pairs(
    itemsets: DataFrame, metric: str = METRIC, min_threshold: float = MIN_THRESHOLD, exact: bool = False, workspace: Workspace | None = None
) -> DataFrame:
    """(country_id, antecedents, consequents, support, confidence, lift), item to item; and ``metric`` if it is another.

    Each rule gives a row for every item of one side with every item of the other; of the rows of a
    pair with equal support and confidence the best value stays. In one country these two are equal
    exactly when n and n_a are, and lift is best where n_c is least, so the grouping is on integers.
    """
    _check(metric)
    ws = workspace or Workspace(itemsets.sparkSession)
    known = lattice(itemsets, ws)
    rules = grown_rules(known, metric, min_threshold, exact, ws).rules
    left = known.sets.select(F.col("number").alias("antecedent"), F.col("ids").alias("ids_a"))
    right = known.sets.select(F.col("number").alias("consequent"), F.col("ids").alias("ids_c"))
    # Of the metrics only the right side's own support is best where its count is greatest.
    best = F.max("n_c") if metric == "consequent_support" else F.min("n_c")
    pairs = (
        rules.join(left, "antecedent").join(right, "consequent")
        .withColumn("a", F.explode_outer("ids_a"))
        .withColumn("c", F.explode_outer("ids_c"))
        .groupBy("a", "c", "n", "n_a", "n_baskets")
        .agg(F.min("n_c").alias("n_c"), best.alias("n_best"))
    )
    alone = known.named.filter(F.size("items") == 1).select("number", "country_id", F.element_at("items", 1).alias("code"))
    antecedent = alone.select(F.col("number").alias("a"), "country_id", F.col("code").alias("antecedents"))
    consequent = alone.select(F.col("number").alias("c"), F.col("code").alias("consequents"))
    values = {name: METRICS[name]() for name in PAIR_COLUMNS[3:]}
    named = pairs.join(antecedent, "a").join(consequent, "c").withColumns(values)
    if metric in PAIR_COLUMNS:
        return named.select(*PAIR_COLUMNS)
    return named.withColumn("n_c", F.col("n_best")).select(*PAIR_COLUMNS, METRICS[metric]().alias(metric))


def pair_best_metric(pairs: DataFrame, metric: str = METRIC) -> DataFrame:
    """(country_id, antecedents, consequents, metric): the best value of the metric per pair."""
    return pairs.groupBy("country_id", "antecedents", "consequents").agg(
        F.max(metric).alias(metric)
    )


def _check(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}, not {metric!r}")
