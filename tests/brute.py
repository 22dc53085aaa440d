"""Plain-Python answers for small inputs."""

from __future__ import annotations

import math
from itertools import combinations

Baskets = dict[object, list[frozenset[str]]]


def basket_rows(baskets: Baskets) -> list[tuple]:
    """(order_id, country_name, country_id, partner_id, gtin) rows of the baskets."""
    return [
        (100_000 * place + order, f"country {country}", country, 1, item)
        for place, (country, orders) in enumerate(baskets.items())
        for order, basket in enumerate(orders)
        for item in sorted(basket)
    ]


def itemsets(baskets: Baskets, min_support: float, max_len: int | None = None) -> dict:
    """{(country, items): n}, all sizes, by counting every subset of every basket."""
    found: dict = {}
    for country, orders in baskets.items():
        counts: dict = {}
        for basket in orders:
            for size in range(1, min(len(basket), max_len or len(basket)) + 1):
                for items in combinations(sorted(basket), size):
                    counts[items] = counts.get(items, 0) + 1
        least = math.ceil(min_support * len(orders))
        found.update({(country, items): n for items, n in counts.items() if n >= least})
    return found


def rules(baskets: Baskets, sets: dict, min_lift: float) -> dict:
    """{(country, antecedent, consequent): (support, confidence, lift)}."""
    found = {}
    for (country, items), n in sets.items():
        total = len(baskets[country])
        for size in range(1, len(items)):
            for left in combinations(items, size):
                right = tuple(i for i in items if i not in left)
                support = n / total
                confidence = support / (sets[country, left] / total)
                lift = confidence / (sets[country, right] / total)
                if lift >= min_lift:
                    found[country, left, right] = (support, confidence, lift)
    return found


def pairs(rules: dict) -> dict:
    """{(country, a, c, support, confidence): best lift}."""
    best: dict = {}
    for (country, left, right), (support, confidence, lift) in rules.items():
        for a in left:
            for c in right:
                key = (country, a, c, support, confidence)
                best[key] = max(lift, best.get(key, lift))
    return best
