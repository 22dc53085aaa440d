"""Exact metric text, long itemsets, table replacement and metrics that a run can't carry."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.functions.metrics import number_text
from basketry.operators.rules import association_rules
from basketry.params import RunWindow
from basketry.plans import run_daily
from basketry.sinks import replace_table
from basketry.sources.tables import read_table, table_exists


def test_number_text_reads_back(spark):
    values = [2.0, 1.5, 0.0005, 1 / 3000, 0.00012345678901234567, 1e-19, 1.25e20, 123456789.125, 4 / 3, 12345678.0, 1e7]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text(F.col("v")).alias("t")).collect()
    for r in rows:
        assert float(r["t"]) == r["v"] and "E" not in r["t"], r
    assert [r["t"] for r in rows[:3]] == ["2", "1.5", "0.0005"] and rows[-1]["t"] == "10000000"


def test_splits_of_a_long_itemset(spark):
    """Every subset of ten items is frequent, and every split of each of them a rule."""
    items = [f"i{k:02}" for k in range(10)]
    subsets = [[x for i, x in enumerate(items) if m >> i & 1] for m in range(1, 1 << 10)]
    known = spark.createDataFrame([(1, s, 1, 1) for s in subsets], "country_id int, items array<string>, n long, n_baskets long")
    found = association_rules(known)
    assert found.count() == 3**10 - 2 * 2**10 + 1
    whole = found.filter(F.size("antecedents") + F.size("consequents") == 10)
    assert whole.count() == whole.select("antecedents", "consequents").distinct().count() == (1 << 10) - 2


def test_broken_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_table(spark.range(3).toDF("x"), path)
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("x")), path)
    assert read_table(spark, path).count() == 3
    replace_table(spark.range(5).toDF("x"), path)
    assert read_table(spark, path).count() == 5


def test_table_exists_only_asks_for_the_path(spark, tmp_path):
    (tmp_path / "broken" / "_temporary").mkdir(parents=True)
    assert table_exists(spark, str(tmp_path / "broken"))
    assert not table_exists(spark, str(tmp_path / "none"))


def test_unknown_metric_is_refused_before_any_write(tmp_path):
    import datetime as dt

    with pytest.raises(ValueError, match="zhang"):
        run_daily(None, RunWindow(dt.date(2024, 3, 1)), str(tmp_path / "out"), metric="zhang")
    assert not (tmp_path / "out").exists()
