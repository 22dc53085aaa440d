"""The whole run on a small nested source."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql.types import LongType

from basketry import MiningParams, OrderFilter, RunWindow
from basketry.plans import run_daily
from basketry import operators as op
from basketry.sources import read_orders, read_sources, read_table, schemas
from tests import brute
from tests.test_mining import random_baskets

RUN = RunWindow(dt.date(2024, 3, 1))
DAY = dt.date(2024, 2, 1)
COUNTRY = {0: "Chile", 1: "Perú", 2: "Bolivia"}


@pytest.fixture(scope="module")
def baskets():
    return random_baskets(11)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory, baskets):
    root = str(tmp_path_factory.mktemp("source"))
    orders = [
        (100 * c + i, DAY, 2, 1, (c, COUNTRY[c]), (c * 10 + i % 2,), [((int(g) + 1,), 2.0) for g in sorted(b)])
        for c, orders in baskets.items()
        for i, b in enumerate(orders)
    ]
    tables = {
        "fact_orders": (orders, schemas.ORDER_FACTS),
        "dim_historical_partners": ([(0, DAY, "x", "n", 0, 1, DAY)], schemas.PARTNER_SNAPSHOTS),
        "dim_product": ([(i + 1, f"{i:02d}00000", None) for i in range(9)], schemas.PRODUCTS),
        "catalogue": ([(i, f"{i:02d}00000") for i in range(9)], schemas.CATALOGUE),
        "dim_business_category": ([(1,)], schemas.CATEGORIES),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("output"))

    def go(day=RUN, support=0.2):
        return run_daily(read_sources(spark, source), day, root, mining=MiningParams(min_support=support))

    return go


def code(item: str) -> str:
    return f"{item}00000".rjust(14, "0")


def test_run(spark, baskets, run):
    out = run()
    sets = brute.itemsets(baskets, 0.2)
    wanted = brute.pairs(brute.rules(baskets, sets, 1.0))
    pairs = read_table(spark, out.pairs).collect()
    assert {
        (r.country_id, r.antecedents, r.consequents, r.support, r.confidence): r.lift for r in pairs
    } == {(c, code(a), code(b), s, f): lift for (c, a, b, s, f), lift in wanted.items()}

    run()
    history = spark.read.parquet(out.history)
    assert history.count() == len(pairs)
    assert [r.audit_date for r in history.select("audit_date").distinct().collect()] == [RUN.run_date]

    units = {}
    for country, orders in baskets.items():
        for i, basket in enumerate(orders):
            for item in basket:
                key = (country, country * 10 + i % 2)
                units.setdefault(key, {}).setdefault(code(item), 0)
                units[key][code(item)] += 2
    ranked = {
        (c, p, gtin, place)
        for (c, p), sold in units.items()
        for place, gtin in enumerate(sorted(sold, key=lambda g: (-sold[g], g))[:30], start=1)
    }
    assert {tuple(r) for r in read_table(spark, out.ranking).collect()} == ranked

    outbox = spark.read.json(out.outbox).collect()
    documents = [(m.event_type, json.loads(json.loads(m.message)["default"])) for m in outbox]
    assert {(d["country_id"], d["code"]) for kind, d in documents if kind == "mba"} == {
        (str(c), code(a)) for (c, a, *_) in wanted
    }
    assert {(d["country_id"], d["code"]) for kind, d in documents if kind == "ranking"} == {
        (str(c), str(p)) for c, p in units
    }


def test_next_day_adds_to_the_history(spark, run):
    out = run()
    later = RunWindow(dt.date(2024, 3, 2))
    run(later)
    days = {r.audit_date: r["count"] for r in spark.read.parquet(out.history).groupBy("audit_date").count().collect()}
    assert days.keys() == {RUN.run_date, later.run_date}
    assert len(set(days.values())) == 1


def test_empty_run_keeps_the_pairs(spark, run):
    out = run()
    before = read_table(spark, out.pairs).count()
    empty = RunWindow(dt.date(2030, 1, 1))
    run(empty)
    assert read_table(spark, out.pairs).count() == before
    assert empty.run_date not in {r.audit_date for r in spark.read.parquet(out.history).collect()}
    assert read_table(spark, out.ranking).count() == 0
    assert {r.event_type for r in spark.read.json(out.outbox).collect()} == {"mba"}


def test_empty_first_run(spark, source, tmp_path):
    out = run_daily(
        read_sources(spark, source), RUN, str(tmp_path), orders=OrderFilter(business_type=9)
    )
    assert read_table(spark, out.ranking).count() == 0
    assert not (tmp_path / "recommendation_by_country").exists()


def test_quantities_may_be_whole_numbers(spark, source, tmp_path):
    """A file of longs gives the same ranking as one of doubles."""
    whole = spark.read.parquet(f"{source}/fact_orders")
    as_long = "transform(details, d -> named_struct('product', d.product, 'quantity', cast(d.quantity as bigint)))"
    whole.selectExpr(*[c for c in whole.columns if c != "details"], f"{as_long} as details").write.parquet(str(tmp_path / "fact_orders"))
    longs, doubles = read_orders(spark, str(tmp_path / "fact_orders")), read_orders(spark, f"{source}/fact_orders")
    assert longs.schema == schemas.order_facts(LongType()) and doubles.schema == schemas.ORDER_FACTS
    products = spark.read.parquet(f"{source}/dim_product")
    catalogue = spark.read.parquet(f"{source}/catalogue")
    units = [sorted(tuple(r) for r in op.units_sold(op.order_lines(o), products, catalogue, RUN, OrderFilter()).collect()) for o in (longs, doubles)]
    assert units[0] == units[1] and units[0]
