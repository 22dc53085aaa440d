from __future__ import annotations

import datetime as dt

import pytest

from basketry import OrderFilter, RunWindow
from basketry import operators as op
from basketry.params import COUNTRIES
from basketry.sources import schemas

RUN = RunWindow(dt.date(2024, 3, 1))
FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 2, 28)
CODE = "07790895000218"


def order(order_id=1, day=FIRST, business=2, confirmed=1, country=(1, "Chile"), partner=7, lines=((1, 3.0),)):
    details = None if lines is None else [((p,), q) for p, q in lines]
    return (order_id, day, business, confirmed, country, (partner,), details)


def lines_of(spark, *orders):
    return op.order_lines(spark.createDataFrame(list(orders), schemas.ORDER_FACTS))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [(1, "EAN 7790895000218", None), (2, None, "AB-12"), (3, "short 12", "AB-12"), (4, "9999999", None)],
        schemas.PRODUCTS,
    )


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([(1, "7790895000218"), (2, "AB-12"), (None, "9999999")], schemas.CATALOGUE)


def test_window_is_59_days_and_excludes_yesterday():
    assert (RUN.start, RUN.end) == (FIRST, dt.date(2024, 2, 29))
    assert (RUN.end - RUN.start).days == 59
    with pytest.raises(ValueError):
        RunWindow(dt.date(2024, 3, 1), from_days=1, to_days=2)


def test_order_window_bounds(spark):
    days = [FIRST - dt.timedelta(1), FIRST, LAST, LAST + dt.timedelta(1)]
    orders = spark.createDataFrame([order(i, d) for i, d in enumerate(days)], schemas.ORDER_FACTS)
    assert sorted(r.order_id for r in op.order_window(orders, RUN).collect()) == [1, 2]


def test_orders_without_lines_vanish(spark):
    lines = lines_of(spark, order(1, lines=()), order(2, lines=None), order(3, lines=((1, 1.0), (2, 2.0))))
    assert sorted((r.order_id, r.product_id, r.quantity) for r in lines.collect()) == [(3, 1, 1.0), (3, 2, 2.0)]


def test_basket_rows_filters_and_distinct(spark, products, catalogue):
    lines = lines_of(
        spark,
        order(1, lines=((1, 1.0), (1, 2.0), (2, 1.0), (3, 1.0), (4, 1.0), (9, 1.0))),
        order(2, confirmed=0),
        order(3, business=1),
        order(4, country=(2, "Atlantis")),
        order(5, day=dt.date(2024, 2, 29)),
    )
    rows = op.basket_rows(lines, products, catalogue, RUN).collect()
    assert sorted((r.order_id, r.gtin) for r in rows) == [
        (1, "000000000AB-12"), (1, CODE), (2, CODE),
    ]
    assert rows[0].asDict().keys() == {"order_id", "country_name", "country_id", "partner_id", "gtin"}


def test_duplicate_dimension_rows_change_no_basket(spark, products, catalogue):
    lines = lines_of(spark, order(1, lines=((1, 1.0), (2, 1.0))))
    plain = op.basket_rows(lines, products, catalogue, RUN)
    doubled = op.basket_rows(lines, products.union(products), catalogue.union(catalogue), RUN)
    assert sorted(plain.collect()) == sorted(doubled.collect())


def test_units_multiply_with_duplicates_unless_deduped(spark, products, catalogue):
    lines = lines_of(spark, order(1, lines=((1, 3.0),)), order(2, lines=((1, 2.0),)), order(3, confirmed=0))
    args = (lines, products.union(products), catalogue.union(catalogue).union(catalogue), RUN)
    assert op.units_sold(*args).first().items_sold == 5 * 2 * 3
    assert op.units_sold(*args, dedupe=True).first().items_sold == 5


def test_default_countries_are_the_fifteen():
    assert len(COUNTRIES) == len(set(COUNTRIES)) == 15
    assert OrderFilter().countries == COUNTRIES


def snapshots(spark, rows):
    return spark.createDataFrame(rows, schemas.PARTNER_SNAPSHOTS)


D1, D2 = dt.date(2024, 1, 10), dt.date(2024, 1, 20)


@pytest.fixture(scope="module")
def history(spark):
    return snapshots(
        spark,
        [
            (7, D1, "x", "n", 0, 5, D1),
            (7, D2, "x", "n", 0, 6, D2),
            (7, D2, "x", "n", 1, 4, D2),
            (7, D2, "y", "n", None, 7, D2),
            (8, D1, "x", None, 0, 5, D1),
            (8, D2, "x", None, 0, 5, dt.date(2023, 1, 1)),
            (None, D2, "x", "n", 0, 5, D2),
            (9, None, "x", "n", 0, 5, D2),
        ],
    )


def test_latest_snapshot_keeps_all_rows_of_the_last_day(history):
    rows = op.latest_snapshot(history, RUN).collect()
    found = sorted((r.restaurant_id, r.date_id, r.business_type, r.is_darkstore, r.business_category_id) for r in rows)
    assert found == [(7, D2, "x", 1, 6), (7, D2, "y", None, 7), (8, D1, "x", 0, 5)]


def test_partner_copies(spark, history):
    categories = spark.createDataFrame([(6,), (6,), (6,), (5,)], schemas.CATEGORIES)
    found = {r.partner_id: r.partner_copies for r in op.partner_copies(history, categories, RUN).collect()}
    assert found == {7: 3 + 1, 8: 1}


def test_ranking_fan_out(spark, products, catalogue, history):
    categories = spark.createDataFrame([(6,), (7,)], schemas.CATEGORIES)
    lines = lines_of(spark, order(1, lines=((1, 3.0),)), order(2, partner=99, lines=((1, 3.0),)))
    args = (lines, products, catalogue, history, categories, RUN)
    assert {r.partner_id: r.items_sold for r in op.ranked_units(*args).collect()} == {7: 6, 99: 3}
    assert {r.partner_id: r.items_sold for r in op.ranked_units(*args, dedupe=True).collect()} == {7: 3, 99: 3}


def test_ranking_ties_and_cut(spark):
    units = spark.createDataFrame(
        [(1, 7, "p", 5.0), (1, 7, "q", 5.0), (1, 7, "r", 4.0), (1, 7, "s", 0.0), (1, 7, "t", None), (1, 8, "r", 1.0)],
        "country_id int, partner_id long, gtin string, items_sold double",
    )
    found = sorted(tuple(r) for r in op.top_products(units, k=2).collect())
    assert found == [(1, 7, "p", 1), (1, 7, "q", 2), (1, 8, "r", 1)]
    assert len(op.top_products(units).collect()) == 4


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert tuple(op.fanout(df, ["k"]).first()) == (3, 2, 2)
    assert tuple(op.fanout(df.limit(0), ["k"]).first()) == (0, 0, 0)
    assert op.assert_unique(df, ["k", "v"]) is df
    with pytest.raises(ValueError, match="share"):
        op.assert_unique(df, ["k"])
