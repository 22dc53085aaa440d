from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from basketry import MiningParams
from basketry import operators as op
from basketry.operators import closed, mining
from basketry.operators.growth import by_bit_arrays, by_tree
from basketry.params import ALGORITHMS
from tests import brute

ROWS = "order_id long, country_name string, country_id int, partner_id long, gtin string"
GOLDEN = {1: [frozenset(b) for b in ("abc", "abc", "ab", "d", "cd", "a")]}
GOLDEN_SETS = {"a": 4, "b": 3, "c": 3, "d": 2, "ab": 3, "ac": 2, "bc": 2, "abc": 2}


def rows_of(spark, baskets):
    return spark.createDataFrame(brute.basket_rows(baskets), ROWS)


def mined(rows, **params):
    found = op.frequent_itemsets(op.baskets(rows), MiningParams(**params)).collect()
    sets = {(r.country_id, tuple(r["items"])): r.n for r in found}
    assert len(sets) == len(found)
    assert all(r.number_of_items == len(r["items"]) and r.support == r.n / r.n_baskets for r in found)
    return sets


def random_baskets(seed: int, sizes=(40, 15, 5)) -> dict:
    """Countries of different size; a few items are in most baskets, one basket holds all items."""
    rng = random.Random(seed)
    items = [f"{i:02d}" for i in range(9)]
    weights = [12, 6, 4, 2, 2, 1, 1, 1, 1]
    baskets = {
        country: [frozenset(rng.choices(items, weights, k=rng.randint(1, 6))) for _ in range(size)]
        for country, size in enumerate(sizes)
    }
    baskets[0].append(frozenset(items))
    return baskets


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_golden(spark, algorithm):
    found = mined(rows_of(spark, GOLDEN), min_support=0.3, algorithm=algorithm)
    assert found == {(1, tuple(k)): n for k, n in GOLDEN_SETS.items()}


@pytest.mark.parametrize("algorithm", ALGORITHMS)
@pytest.mark.parametrize(("seed", "support"), [(1, 0.1), (2, 0.25)])
def test_equals_brute_force(spark, algorithm, seed, support):
    baskets = random_baskets(seed)
    found = mined(rows_of(spark, baskets), min_support=support, algorithm=algorithm)
    assert found == brute.itemsets(baskets, support)


@pytest.mark.parametrize("wide", [2, 3, 5])
def test_wide_baskets_are_counted_exactly(spark, wide):
    """Few baskets above the limit, one of them holding everything."""
    rng = random.Random(wide)
    items = [f"{i:02d}" for i in range(12)]
    small = [frozenset(rng.sample(items, rng.randint(1, wide))) for _ in range(60)]
    baskets = {1: [*small, frozenset(items), frozenset(items[:9]), frozenset(items)], 2: small[:20]}
    found = mined(rows_of(spark, baskets), min_support=0.1, wide_basket=wide)
    assert found == brute.itemsets(baskets, 0.1)


def test_wide_limit_rises_where_many_baskets_are_wide(spark):
    """With every basket above ``wide_basket`` the limit moves up and nothing is missed."""
    baskets = random_baskets(5)
    found = mined(rows_of(spark, baskets), min_support=0.2, wide_basket=2)
    assert found == brute.itemsets(baskets, 0.2)


@pytest.mark.parametrize("max_len", [1, 2, 3])
@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_max_len(spark, algorithm, max_len):
    baskets = random_baskets(3)
    found = mined(rows_of(spark, baskets), min_support=0.15, max_len=max_len, algorithm=algorithm)
    assert found == brute.itemsets(baskets, 0.15, max_len)


def test_floor_raises_the_least_count(spark):
    found = mined(rows_of(spark, GOLDEN), min_support=0.0005, min_count_floor=3)
    assert found == {(1, tuple(k)): n for k, n in GOLDEN_SETS.items() if n >= 3}


def test_least_count_of_one_finds_every_subset(spark):
    assert mined(rows_of(spark, GOLDEN)) == brute.itemsets(GOLDEN, 0.0005)


def test_downward_closure(spark):
    found = mined(rows_of(spark, random_baskets(4)), min_support=0.1)
    for (country, items), n in found.items():
        for i in range(len(items)):
            part = items[:i] + items[i + 1 :]
            assert not part or found[country, part] >= n


def test_duplicates_order_and_nulls_change_nothing(spark):
    rows = brute.basket_rows(GOLDEN)
    shuffled = rows[::-1] + rows[3:7] + [(o, n, c, 2, g) for o, n, c, _, g in rows]
    nulls = [(None, "country 1", 1, 1, "a"), (5, "none", None, 1, "a"), (77, "country 1", 1, 1, None)]
    df = spark.createDataFrame(shuffled + nulls, ROWS)
    assert mined(df, min_support=0.3) == {(1, tuple(k)): n for k, n in GOLDEN_SETS.items()}


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_no_rows(spark, algorithm):
    assert mined(spark.createDataFrame([], ROWS), min_support=0.1, algorithm=algorithm) == {}


def test_only_single_item_baskets(spark):
    baskets = {1: [frozenset("a"), frozenset("a"), frozenset("b")]}
    found = mined(rows_of(spark, baskets), min_support=0.1)
    assert found == {(1, ("a",)): 2, (1, ("b",)): 1}


def test_text_countries(spark):
    rows = [(o, n, f"c{c}", p, g) for o, n, c, p, g in brute.basket_rows(GOLDEN)]
    df = spark.createDataFrame(rows, ROWS.replace("country_id int", "country_id string"))
    for algorithm in ALGORITHMS:
        found = mined(df, min_support=0.3, algorithm=algorithm)
        assert found == {("c1", tuple(k)): n for k, n in GOLDEN_SETS.items()}


def test_hot_order_and_hot_item(spark):
    """A third of all rows repeat one order; one item is in every basket."""
    rng = random.Random(9)
    items = [f"{i:03d}" for i in range(60)]
    baskets = {1: [frozenset(["hot", *rng.sample(items[:8], 2)]) for _ in range(80)]}
    baskets[1].append(frozenset(items))
    rows = brute.basket_rows(baskets)
    hot = [r for r in rows if r[0] == 80]
    df = spark.createDataFrame(rows + hot * 3, ROWS)
    found = mined(df, min_support=0.05, wide_basket=4)
    assert found == brute.itemsets({1: [*baskets[1][:-1], frozenset(items[:8])]}, 0.05)


def test_basket_counts(spark):
    rows = rows_of(spark, random_baskets(1))
    counts = op.basket_counts(op.baskets(rows), MiningParams(min_support=0.1)).collect()
    assert {tuple(r) for r in counts} == {(0, 41, 5), (1, 15, 2), (2, 5, 1)}


def test_baskets_are_sorted_sets(spark):
    found = {r.order_id: r["items"] for r in op.baskets(rows_of(spark, GOLDEN)).collect()}
    assert found == {i: sorted(b) for i, b in enumerate(GOLDEN[1])}


@pytest.mark.parametrize(
    "bad",
    [{"min_support": 0.0}, {"min_support": 1.5}, {"max_len": 0}, {"min_count_floor": 0},
     {"algorithm": "magic"}, {"wide_basket": 1}, {"local_rows": 0}],
)
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        MiningParams(**bad)


@pytest.mark.parametrize("algorithm", ["vertical", "fpgrowth"])
@pytest.mark.parametrize("local_rows", [1, 3, 12])
def test_levels_and_local_mining_meet(spark, algorithm, local_rows):
    """Whatever part is left to one task, and whatever max_len cuts, the sets are the same."""
    baskets = random_baskets(6, sizes=(60, 25, 4))
    found = mined(rows_of(spark, baskets), min_support=0.08, algorithm=algorithm, local_rows=local_rows)
    assert found == brute.itemsets(baskets, 0.08)
    found = mined(rows_of(spark, baskets), min_support=0.08, algorithm=algorithm, local_rows=local_rows, max_len=3)
    assert found == brute.itemsets(baskets, 0.08, 3)


def test_sparse_and_dense_countries_together(spark):
    rng = random.Random(21)
    many = [f"{i:03d}" for i in range(120)]
    sparse = [frozenset(rng.sample(many, 4)) for _ in range(300)]
    baskets = {1: sparse, 2: [frozenset(rng.sample(many[:6], 4)) for _ in range(50)]}
    assert mined(rows_of(spark, baskets), min_support=0.01) == brute.itemsets(baskets, 0.01)


@pytest.mark.parametrize("miner", [by_bit_arrays, by_tree])
@pytest.mark.parametrize("most", [1, 2, 99])
def test_local_miners_on_weighted_tails(miner, most):
    rng = random.Random(31)
    tails = [sorted(rng.sample(range(5, 25), rng.randint(1, 9))) for _ in range(200)]
    weights = [rng.choice([1, 1, 2, 7, 130]) for _ in tails]
    wanted: dict = {}
    for tail, w in zip(tails, weights, strict=True):
        for size in range(1, min(len(tail), most) + 1):
            for s in itertools.combinations(tail, size):
                wanted[s] = wanted.get(s, 0) + w
    flat = np.array([x for t in tails for x in t], np.int32)
    found = list(miner(flat, np.array([len(t) for t in tails]), np.array(weights, np.int64), 150, most))
    assert dict(found) == {s: n for s, n in wanted.items() if n >= 150} and len(found) == len(dict(found))


def test_equals_the_fp_growth_of_spark(spark):
    baskets = random_baskets(8, sizes=(80, 30))
    found = mined(rows_of(spark, baskets), min_support=0.1, algorithm="fpgrowth")
    for country, orders in baskets.items():
        frame = spark.createDataFrame([(sorted(b),) for b in orders], "items array<string>")
        sets = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.0).fit(frame).freqItemsets.collect()
        assert {tuple(sorted(r["items"])): r["freq"] for r in sets} == {i: n for (c, i), n in found.items() if c == country}


def test_local_rows_bound_what_one_task_takes(spark, tmp_path, monkeypatch):
    """No group of states that goes to one task holds more orders than the limit."""
    seen = []
    whole = mining.grown_below

    def watched(states, miner, most):
        seen.append(states.groupBy("node", "item").agg(F.sum("weight").alias("orders")).agg(F.max("orders")).first()[0])
        return whole(states, miner, most)

    monkeypatch.setattr(mining, "grown_below", watched)
    baskets = random_baskets(6, sizes=(60, 25, 4))
    assert mined(rows_of(spark, baskets), min_support=0.08, local_rows=9) == brute.itemsets(baskets, 0.08)
    assert len(seen) > 1 and max(x or 0 for x in seen) <= 9


def closed_of(sets):
    return {k: n for k, n in sets.items() if not any(k[0] == c and set(k[1]) < set(i) and m == n for (c, i), m in sets.items())}


@pytest.mark.parametrize("local_rows", [1, 6, 1 << 16])
@pytest.mark.parametrize(("seed", "support"), [(1, 1e-9), (12, 0.1), (13, 0.3)])
def test_closed_itemsets_and_their_expansion(spark, seed, support, local_rows):
    rng = random.Random(seed)
    baskets = random_baskets(seed, sizes=(30, 12, 3))
    baskets[3] = [frozenset("abc") | frozenset(rng.sample("defg", 2)) for _ in range(9)]  # three items are everywhere
    baskets[4] = [frozenset("xy")] * 5 + [frozenset("z")]
    carts = op.baskets(rows_of(spark, baskets))
    closed = op.closed_itemsets(carts, MiningParams(min_support=support, local_rows=local_rows))
    as_dict = lambda df: {(r.country_id, tuple(r["items"])): r.n for r in df.collect()}
    every = brute.itemsets(baskets, support)
    assert as_dict(closed) == closed_of(every) and closed.count() == len(closed_of(every))
    whole = op.expanded(closed)
    assert as_dict(whole) == every and whole.count() == len(every)
    assert as_dict(op.expanded(closed, max_len=2)) == {k: n for k, n in every.items() if len(k[1]) <= 2}


def test_closed_itemsets_take_no_level_for_baskets_that_come_often(spark, monkeypatch):
    def refused(states):
        raise AssertionError("a level was taken")

    monkeypatch.setattr(closed, "_closures", refused)
    baskets = {1: [frozenset(x) for x in ("abc", "abd", "bcd", "ab", "cd")] * 12}
    carts = op.baskets(rows_of(spark, baskets))
    found = op.closed_itemsets(carts, MiningParams(min_support=1e-9, local_rows=5))
    assert {(r.country_id, tuple(r["items"])): r.n for r in found.collect()} == closed_of(brute.itemsets(baskets, 1e-9))


def test_closed_itemsets_of_nothing(spark):
    empty = op.baskets(spark.createDataFrame([], ROWS))
    assert op.closed_itemsets(empty).count() == 0 and op.expanded(op.closed_itemsets(empty)).count() == 0
    with pytest.raises(ValueError, match="max_len"):
        op.closed_itemsets(empty, MiningParams(max_len=3))
