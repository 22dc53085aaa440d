from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest

from basketry import MiningParams, Workspace
from basketry import operators as op
from basketry.operators.rules import grown_rules, lattice
from tests import brute
from tests.test_mining import GOLDEN, GOLDEN_SETS, random_baskets, rows_of

GOLDEN_RULES = {
    ("a", "b"): (1 / 2, 3 / 4, 3 / 2), ("b", "a"): (1 / 2, 1, 3 / 2),
    ("a", "c"): (1 / 3, 1 / 2, 1), ("c", "a"): (1 / 3, 2 / 3, 1),
    ("b", "c"): (1 / 3, 2 / 3, 4 / 3), ("c", "b"): (1 / 3, 2 / 3, 4 / 3),
    ("a", "bc"): (1 / 3, 1 / 2, 3 / 2), ("b", "ac"): (1 / 3, 2 / 3, 2),
    ("c", "ab"): (1 / 3, 2 / 3, 4 / 3), ("ab", "c"): (1 / 3, 2 / 3, 4 / 3),
    ("ac", "b"): (1 / 3, 1, 2), ("bc", "a"): (1 / 3, 1, 3 / 2),
}
GOLDEN_BEST = {("a", "b"): 2, ("a", "c"): 3 / 2, ("b", "a"): 2, ("b", "c"): 2, ("c", "a"): 3 / 2, ("c", "b"): 2}


@pytest.fixture(scope="module")
def golden(spark):
    return op.frequent_itemsets(op.baskets(rows_of(spark, GOLDEN)), MiningParams(min_support=0.3))


def test_golden_rules(golden):
    rules = op.association_rules(golden).collect()
    found = {("".join(r.antecedents), "".join(r.consequents)): (r.support, r.confidence, r.lift) for r in rules}
    assert len(rules) == len(found) == 12
    assert found.keys() == GOLDEN_RULES.keys()
    for key, values in GOLDEN_RULES.items():
        assert found[key] == pytest.approx(values)


def test_golden_pairs(golden):
    pairs = op.recommendation_pairs(golden)
    assert pairs.columns == ["country_id", "antecedents", "consequents", "support", "confidence", "lift"]
    assert len(pairs.collect()) == 13
    best = {(r.antecedents, r.consequents): r.lift for r in op.pair_best_metric(pairs).collect()}
    assert best == pytest.approx(GOLDEN_BEST)


@pytest.mark.parametrize(("seed", "support"), [(1, 0.1), (7, 0.2)])
def test_equals_brute_force(spark, seed, support):
    baskets = random_baskets(seed)
    itemsets = op.frequent_itemsets(op.baskets(rows_of(spark, baskets)), MiningParams(min_support=support))
    sets = brute.itemsets(baskets, support)
    wanted = brute.rules(baskets, sets, 1.0)
    rules = op.association_rules(itemsets).collect()
    assert {
        (r.country_id, tuple(r.antecedents), tuple(r.consequents)): (r.support, r.confidence, r.lift)
        for r in rules
    } == wanted
    pairs = op.recommendation_pairs(itemsets).collect()
    found = {(r.country_id, r.antecedents, r.consequents, r.support, r.confidence): r.lift for r in pairs}
    assert len(found) == len(pairs)
    assert found == brute.pairs(wanted)


def test_symmetry_and_bounds(golden):
    rules = {
        (tuple(r.antecedents), tuple(r.consequents)): r
        for r in op.association_rules(golden, "support", 0.0).collect()
    }
    for (a, c), rule in rules.items():
        other = rules[c, a]
        assert rule.leverage == pytest.approx(other.leverage)
        assert rule.lift == pytest.approx(other.lift)
        assert rule.support <= rule.confidence
        assert rule.antecedent_support == other.consequent_support


def test_conviction(golden):
    for rule in op.association_rules(golden, "support", 0.0).collect():
        if rule.confidence == 1:
            assert math.isinf(rule.conviction)
        else:
            assert rule.conviction == pytest.approx((1 - rule.consequent_support) / (1 - rule.confidence))


def exact_metrics(left: str, right: str) -> dict[str, Fraction | float]:
    whole, a, c = (Fraction(GOLDEN_SETS["".join(sorted(s))], 6) for s in (left + right, left, right))
    return {
        "antecedent_support": a,
        "consequent_support": c,
        "support": whole,
        "confidence": whole / a,
        "lift": whole / a / c,
        "leverage": whole - a * c,
        "conviction": (1 - c) / (1 - whole / a) if whole < a else math.inf,
    }


@pytest.mark.parametrize(
    ("metric", "threshold"),
    [("confidence", 1.0), ("confidence", 0.7), ("lift", 2.0), ("lift", 1.4), ("support", 0.5),
     ("leverage", 0.1), ("conviction", 1.4), ("antecedent_support", 0.5), ("consequent_support", 0.6)],
)
def test_every_metric_and_inclusive_threshold(golden, metric, threshold):
    wanted = {key for key in GOLDEN_RULES if exact_metrics(*key)[metric] >= threshold}
    rules = op.association_rules(golden, metric, threshold).collect()
    assert {("".join(r.antecedents), "".join(r.consequents)) for r in rules} == wanted
    for r in rules:
        exact = exact_metrics("".join(r.antecedents), "".join(r.consequents))
        assert {name: r[name] for name in exact} == pytest.approx({k: float(v) for k, v in exact.items()})


def test_unknown_metric(golden):
    with pytest.raises(ValueError, match="metric"):
        op.association_rules(golden, "zhang")


def test_no_rules_from_single_items(spark):
    baskets = {1: [frozenset("a"), frozenset("b")]}
    itemsets = op.frequent_itemsets(op.baskets(rows_of(spark, baskets)), MiningParams(min_support=0.1))
    assert op.recommendation_pairs(itemsets).collect() == []


def subsets_of(items: int, baskets: int, seed: int) -> tuple[list[str], dict[int, int]]:
    """Names, and how many of random baskets hold each subset of the items, by bit mask."""
    rng = random.Random(seed)
    held = [sum(1 << i for i in range(items) if rng.random() < 0.9) for _ in range(baskets)]
    full = (1 << items) - 1
    held += [full] * (baskets // 4)
    return [f"i{k:02}" for k in range(items)], {m: sum(h & m == m for h in held) for m in range(1, full + 1)}


@pytest.mark.parametrize(
    ("metric", "threshold", "share"),
    [("confidence", 0.97, 0.2), ("lift", 1.05, 1.0), ("lift", 1.4, 0.6), ("leverage", 0.03, 1.0), ("leverage", 0.2, 0.4),
     ("conviction", 2.55, 0.7), ("consequent_support", 0.85, 1.0), ("antecedent_support", 0.85, 1.0), ("support", 0.7, 0.25)],
)
@pytest.mark.parametrize("exact", [False, True])
def test_splits_that_cannot_reach_the_threshold_are_not_made(spark, metric, threshold, share, exact):
    names, counts = subsets_of(8, 60, 4)
    total = 75
    rows = [(1, [n for i, n in enumerate(names) if m >> i & 1], c, total) for m, c in counts.items()]
    itemsets = spark.createDataFrame(rows, "country_id int, items array<string>, n long, n_baskets long").repartition(3)
    with Workspace(itemsets.sparkSession) as ws:
        known = lattice(itemsets, ws)
        splits = grown_rules(known, metric, threshold, exact, ws)
        found = op.association_rules(itemsets, metric, threshold, exact, ws).collect()
    wanted = set()
    for m, n in counts.items():
        a = (m - 1) & m
        while a:
            s, sa, sc = (Fraction(counts[x], total) for x in (m, a, m ^ a))
            value = {
                "antecedent_support": sa, "consequent_support": sc, "support": s, "confidence": s / sa, "lift": s / sa / sc,
                "leverage": s - sa * sc, "conviction": (1 - sc) / (1 - s / sa) if s < sa else math.inf,
            }[metric]
            if value >= Fraction(str(threshold)):
                wanted.add((a, m ^ a))
            a = (a - 1) & m
    mask = lambda items: sum(1 << names.index(i) for i in items)
    assert {(mask(r.antecedents), mask(r.consequents)) for r in found} == wanted and len(found) == len(wanted)
    every = 3**8 - 2 * 2**8 + 1
    assert sum(splits.made) <= every * share and (wanted or share < 1)


def test_exact_threshold_where_doubles_fail(spark):
    """Lift is 1 exactly in all these rules; in doubles some fall below."""
    rows, n = [], 0
    for n_baskets in (49, 75, 98, 147, 294):
        for n_a in range(7, n_baskets, 7):
            if (n_a * 7) % n_baskets == 0:
                rows += [(n, ["a"], n_a, n_baskets), (n, ["b"], 7, n_baskets), (n, ["a", "b"], n_a * 7 // n_baskets, n_baskets)]
                n += 1
    for n_baskets in range(20, 120):
        rows += [(n, ["a"], n_baskets // 2 * 2 // 2, n_baskets // 2 * 2), (n, ["b"], 2, n_baskets // 2 * 2), (n, ["a", "b"], 1, n_baskets // 2 * 2)]
        n += 1
    itemsets = spark.createDataFrame(rows, "country_id int, items array<string>, n long, n_baskets long")
    assert op.association_rules(itemsets, exact=True).count() == 2 * n
    assert op.association_rules(itemsets, "lift", 1.0000001, exact=True).count() == 0
    assert op.association_rules(itemsets).count() <= 2 * n


@pytest.mark.parametrize("metric", ["leverage", "conviction", "consequent_support", "antecedent_support"])
def test_pairs_by_another_metric(golden, metric):
    rules = op.association_rules(golden, metric, 0.0).collect()
    wanted: dict = {}
    for r in rules:
        for a in r.antecedents:
            for c in r.consequents:
                key = (a, c, r.support, r.confidence)
                lift, value = wanted.get(key, (0.0, -math.inf))
                wanted[key] = (max(lift, r.lift), max(value, r[metric]))
    pairs = op.recommendation_pairs(golden, metric, 0.0)
    assert pairs.columns[-1] == metric
    assert {(r.antecedents, r.consequents, r.support, r.confidence): (r.lift, r[metric]) for r in pairs.collect()} == wanted
    documents = {d.code: [e.code for e in d.recommendation] for d in op.mba_documents(pairs, metric).collect()}
    assert documents.keys() == {a for a, *_ in wanted}
