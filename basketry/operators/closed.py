"""Closed frequent itemsets: those that no item can join without losing orders.

They hold all there is to know, since a frequent itemset has the count of its smallest closed superset
(``expanded``), and there are few of them where baskets are alike: with a least count of 1 they are the intersections of
baskets, not all their subsets.

Each closed set is made once, by prefix-preserving extension: a closed set takes an item behind its last one, and all items
that are in every order of the two are merged with it. The set counts only if none of them stands before the new item
and is not in the old set, since then it is reached from there. Rows are whole baskets, as items before the new one are
tested, too. Items that at most ``local_rows`` different baskets hold with their set, however often these come, go to one
task that finds all closed sets below; the others take a level each: one explode, one sum, and a join on numbers.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.baskets import with_min_count
from basketry.operators.growth import Found, flattened, one_task_each
from basketry.operators.mining import PREFIX, coded_baskets, decoded, frequent_items, item_counts
from basketry.params import MiningParams
from basketry.workspace import Workspace


def closed_itemsets(carts: DataFrame, params: MiningParams = MiningParams(), workspace: Workspace | None = None) -> DataFrame:
    """(country_id, items, number_of_items, n, n_baskets, support) of the closed frequent itemsets.

    ``max_len`` is not for them, as the closed superset of a short set may be long, and is refused.
    """
    if params.max_len is not None:
        raise ValueError("closed itemsets have no max_len")
    ws = workspace or Workspace(carts.sparkSession)
    carts = ws.save(carts, "baskets")
    counts = ws.save(item_counts(carts), "item-counts")
    everything = counts.filter("gtin is null").select("country_id", F.col("n").alias("n_baskets"))
    totals = ws.save(with_min_count(everything, params).withColumn("child", F.monotonically_increasing_id()), "totals")
    items = ws.save(frequent_items(counts, totals), "items")
    coded = ws.save(coded_baskets(carts, items, least=1), "coded")
    different = coded.select("country_id", F.explode("ids").alias("id")).groupBy("country_id", "id").agg(F.count(F.lit(1)).alias("rows"))
    different = ws.save(different, "different-baskets")
    nodes = ws.save(_roots(items.join(different, ["country_id", "id"]), totals), "roots")
    found = [nodes.filter(F.size("path") > 0).select("country_id", F.col("path").alias("ids"), F.col("n_baskets").alias("n"))]
    states = coded.join(nodes.drop("n_baskets"), "country_id").withColumnRenamed("child", "node")
    level = 0
    while True:
        level += 1
        states, left = ws.save_measured(_states(states, params.local_rows), f"states-{level}", local=F.count_if("local"), large=F.count_if(~F.col("local")))
        countries = nodes.select(F.col("child").alias("node"), "country_id")
        if left["local"]:
            below = one_task_each(states.filter("local").select(*PREFIX, "ids", "weight", "least", "before"), _closed_below)
            found.append(ws.save(below.join(countries, "node").select("country_id", "ids", "n"), f"below-{level}"))
        if not left["large"]:
            break
        states = states.filter("not local").drop("local")
        nodes = ws.save(_closures(states).join(countries, "node"), f"level-{level}")
        found.append(nodes.select("country_id", F.col("path").alias("ids"), "n"))
        on = nodes.select(*PREFIX, "child", "path", "extensions")
        states = states.select(*PREFIX, "ids", "weight", "least").join(on, list(PREFIX)).drop(*PREFIX).withColumnRenamed("child", "node")
    sets = decoded(reduce(DataFrame.unionByName, found), items)
    return ws.save(_measured(sets, totals), "closed")


def expanded(closed: DataFrame, workspace: Workspace | None = None, max_len: int | None = None) -> DataFrame:
    """All frequent itemsets with their counts, from the closed ones: size by size, each without one of its items.

    A set that several larger ones lead to has the greatest of their counts. No step holds more rows than a size has
    itemsets, times the items of one.
    """
    ws = workspace or Workspace(closed.sparkSession)
    closed, seen = ws.save_measured(closed.select("country_id", "items", "n", "n_baskets"), "closed", size=F.max(F.size("items")))
    found, above = [], None
    for size in range(seen["size"] or 0, 0, -1):
        rows = closed.filter(F.size("items") == size)
        if above is not None:
            each = above.select("country_id", "items", "n", "n_baskets", F.explode("items").alias("without"))
            rows = rows.unionByName(each.select("country_id", F.filter("items", lambda x: x != F.col("without")).alias("items"), "n", "n_baskets"))
        above = ws.save(rows.groupBy("country_id", "items", "n_baskets").agg(F.max("n").alias("n")), f"sets-of-{size}")
        if max_len is None or size <= max_len:
            found.append(above)
    sets = reduce(DataFrame.unionByName, found) if found else closed
    return _support(sets)


def _support(sets: DataFrame) -> DataFrame:
    return sets.select("country_id", "items", F.size("items").alias("number_of_items"), "n", "n_baskets", (F.col("n") / F.col("n_baskets")).alias("support"))


def _measured(sets: DataFrame, totals: DataFrame) -> DataFrame:
    return _support(sets.join(totals.select("country_id", "n_baskets"), "country_id"))


def _roots(items: DataFrame, totals: DataFrame) -> DataFrame:
    """(country_id, child, n_baskets, least, path, extensions): the items of all orders of a country, and the other frequent ones."""
    rows = items.select("country_id", "id", "n", "rows").join(totals, "country_id")
    every = F.col("n") == F.col("n_baskets")
    return rows.groupBy("country_id", "child", "n_baskets", F.col("min_count").alias("least")).agg(
        F.sort_array(F.collect_list(F.when(every, F.col("id")))).alias("path"),
        F.collect_list(F.when(~every, F.struct(F.col("id").alias("next"), "n", "rows"))).alias("extensions"),
    )


def _states(rows: DataFrame, limit: int) -> DataFrame:
    """(node, item, ids, weight, least, before, local): each basket with each item that may extend its set.

    ``local``: at most ``limit`` different baskets hold it with the set.

    ``before``: how many items of the set stand before that item.
    """
    fits = F.filter("extensions", lambda e: F.array_contains("ids", e["next"]))
    split = rows.select("node", "ids", "weight", "least", "path", F.inline(fits))
    before = F.size(F.filter("path", lambda x: x < F.col("next")))
    return split.select("node", F.col("next").alias("item"), "ids", "weight", "least", before.alias("before"), (F.col("rows") <= limit).alias("local"))


def _closures(states: DataFrame) -> DataFrame:
    """(node, item, child, path, n, extensions): the closed sets of large states that are not reached from elsewhere.

    An item that as many orders hold as the state has belongs to the closure.
    """
    counts = states.select(*PREFIX, "least", "before", "weight", F.explode("ids").alias("next")).groupBy(*PREFIX, "least", "before", "next")
    counts = counts.agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows"))
    own = F.max(F.when(F.col("next") == F.col("item"), F.col("n")))
    sets = counts.filter("n >= least").groupBy(*PREFIX, "before").agg(own.alias("n"), F.sort_array(F.collect_list(F.struct("next", "n", "rows"))).alias("counted"))
    same = F.transform(F.filter("counted", lambda e: e["n"] == F.col("n")), lambda e: e["next"])
    more = F.filter("counted", lambda e: (e["n"] < F.col("n")) & (e["next"] > F.col("item")))
    sets = sets.select(*PREFIX, "before", "n", same.alias("path"), more.alias("extensions"))
    sets = sets.filter(F.size(F.filter("path", lambda x: x < F.col("item"))) == F.col("before"))
    return sets.select(*PREFIX, F.monotonically_increasing_id().alias("child"), "path", "n", "extensions")


def _closed_below(group: pa.Table) -> Found:
    """Closed sets of the baskets, all of which hold the group's item, that have no further item before it."""
    flat, lengths = flattened(group["ids"])
    weights, (item, least, before) = group["weight"].to_numpy(), (group[c][0].as_py() for c in ("item", "least", "before"))
    items, at = np.unique(flat, return_inverse=True)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    words = (len(lengths) + 63) // 64
    table = np.zeros(len(items) * words, np.uint64)
    np.add.at(table, at * words + rows // 64, np.uint64(1) << (rows % 64).astype(np.uint64))
    # A row per item, a bit per basket; weights stay as they are, and are summed where bits are set.
    padded = np.zeros(words * 64, np.int64)
    padded[: len(weights)] = weights

    def closure(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Baskets per item, and the items of all baskets."""
        held = np.bitwise_count(bits).sum(1, dtype=np.int64)
        return held, held == held.max(initial=0)

    def orders(bits: np.ndarray, weight: np.ndarray) -> int:
        return int(weight[np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)].sum())

    bits, start = table.reshape(len(items), words), int(np.searchsorted(items, item))
    held, closed = closure(bits)
    if int(closed[:start].sum()) != before:
        return
    n = orders(bits[start], padded)
    yield items[closed].tolist(), n
    stack = [(start, closed, bits, padded)]
    while stack:
        core, closed, bits, weight = stack.pop()
        for e in range(core + 1, len(items)):
            if closed[e] or not bits[e].any():
                continue
            some = np.flatnonzero(bits[e])
            n = orders(bits[e, some], own := weight.reshape(-1, 64)[some].ravel())
            if n < least:
                continue
            longer = bits[:, some] & bits[e, some]
            _, joined = closure(longer)
            if (joined[:e] & ~closed[:e]).any():
                continue
            yield items[joined].tolist(), n
            stack.append((e, joined, longer, own))
