"""A window that moves day by day gives what counting it in full gives."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry import MiningParams
from basketry import operators as op
from tests import brute
from tests.test_mining import rows_of

DAYS = [dt.date(2024, 3, 1) + dt.timedelta(days=k) for k in range(9)]


def day_of(seed: int, countries=(1, 2)) -> dict:
    """Baskets of one day; on some days two rare items are bought together all at once."""
    rng = random.Random(seed)
    items, weights = [f"{i:02d}" for i in range(10)], [9, 6, 4, 3, 2, 2, 1, 1, 1, 1]
    baskets = {c: [frozenset(rng.choices(items, weights, k=rng.randint(1, 5))) for _ in range(30 // c)] for c in countries}
    if seed % 3 == 2:
        baskets[1] += [frozenset(["08", "09", "new"])] * 9
    return baskets


def carts_of(spark, k: int, baskets: dict):
    """Baskets of day ``k``, with order numbers of their own."""
    return op.baskets(rows_of(spark, baskets)).withColumn("order_id", F.col("order_id") + k * 10_000_000)


def window_of(days: list[dict]) -> dict:
    out: dict = {}
    for day in days:
        for country, baskets in day.items():
            out.setdefault(country, []).extend(baskets)
    return out


@pytest.mark.parametrize(("low", "rebase"), [(0.5, 99), (1.0, 99), (0.2, 2)])
def test_every_day_equals_a_full_count(spark, tmp_path, low, rebase):
    days = [day_of(k, (1, 2, 3) if k > 4 else (1, 2)) for k in range(len(DAYS))]
    moving = op.MovingItemsets(spark, str(tmp_path / "moving"), MiningParams(min_support=0.08), low, rebase)
    read = []
    whole = moving.baskets
    moving.baskets = lambda some: read.append(list(some)) or whole(some)
    recounted = 0
    for k in range(len(DAYS)):
        moving.store(DAYS[k], carts_of(spark, k, days[k]))
        if k < 3:
            continue
        window = DAYS[k - 3 : k + 1]
        read.clear()
        found = moving.itemsets(window).collect()
        recounted += moving.recounted
        wanted = window_of(days[k - 3 : k + 1])
        assert {(r.country_id, tuple(r["items"])): r.n for r in found} == brute.itemsets(wanted, 0.08)
        assert all(r.n_baskets == len(wanted[r.country_id]) and r.support == r.n / r.n_baskets for r in found)
        if k > 3 and not moving.recounted and rebase > 50:
            # Besides the counts of baskets per country: the day that came, the one that went, and those that came before.
            assert read[1:3] == [[DAYS[k]], [DAYS[k - 4]]] and len(read) <= 4 and window not in read[1:]
    assert recounted > 0 or low < 0.5


def test_a_day_that_is_repeated_changes_nothing(spark, tmp_path):
    moving = op.MovingItemsets(spark, str(tmp_path / "moving"), MiningParams(min_support=0.1))
    days = [day_of(k) for k in range(5)]
    for k, baskets in enumerate(days):
        moving.store(DAYS[k], carts_of(spark, k, baskets))
    moving.itemsets(DAYS[:4])
    once = sorted(map(tuple, moving.itemsets(DAYS[1:5]).collect()), key=repr)
    again = sorted(map(tuple, moving.itemsets(DAYS[1:5]).collect()), key=repr)
    assert once == again and {(r[0], tuple(r[1])): r[3] for r in once} == brute.itemsets(window_of(days[1:5]), 0.1)


def test_a_jump_over_several_days_and_days_without_baskets(spark, tmp_path):
    moving = op.MovingItemsets(spark, str(tmp_path / "moving"), MiningParams(min_support=0.1))
    days = {d: day_of(k) for k, d in enumerate(DAYS) if k != 5}
    for d, baskets in days.items():
        moving.store(d, carts_of(spark, d.day, baskets))
    moving.itemsets(DAYS[:4])
    found = {(r.country_id, tuple(r["items"])): r.n for r in moving.itemsets(DAYS[3:8]).collect()}
    assert found == brute.itemsets(window_of([days[d] for d in DAYS[3:8] if d in days]), 0.1)
    with pytest.raises(ValueError, match="no baskets"):
        moving.itemsets([dt.date(2030, 1, 1)])
    with pytest.raises(ValueError, match="low"):
        op.MovingItemsets(spark, str(tmp_path), low=0.0)


def test_family_counts_against_plain_python(spark, monkeypatch):
    from basketry.operators import moving

    monkeypatch.setattr(moving, "BLOCK", 7)
    monkeypatch.setattr(moving, "CHUNK", 5)
    rng = random.Random(4)
    baskets = {c: [frozenset(rng.sample("abcdefgh", rng.randint(1, 5))) for _ in range(40)] for c in (1, 2)}
    baskets[1] += baskets[1][:5] * 3
    family = [(c, sorted(rng.sample("abcdefghxyz", rng.randint(1, 4)))) for c in (1, 2, 3) for _ in range(30)]
    family = [(c, list(s)) for c, s in {(c, tuple(s)) for c, s in family}]
    frame = spark.createDataFrame(family, "country_id int, items array<string>")
    from basketry import Workspace

    with Workspace(spark) as ws:
        found = {(r.country_id, tuple(r["items"])): r.n for r in moving.family_counts(op.baskets(rows_of(spark, baskets)), frame, ws).collect()}
    assert found == {(c, tuple(s)): sum(set(s) <= b for b in baskets.get(c, [])) for c, s in family}
