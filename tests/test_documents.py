from __future__ import annotations

import json

from basketry import operators as op

PAIRS = "country_id int, antecedents string, consequents string, support double, confidence double, lift double"


def pairs(spark):
    return spark.createDataFrame(
        [
            (1, "a", "b", 0.5, 0.75, 1.5),
            (1, "a", "b", 0.3, 0.9, 2.0),
            (1, "a", "c", 0.3, 0.5, 2.0),
            (1, "a", "d", 0.3, 0.5, 10.25),
            (2, "a", "b", 0.0005, 0.5, 1.0),
        ],
        PAIRS,
    )


def values(row):
    return [(e.code, e.metric, e.metric_value) for e in row.recommendation]


def test_pair_best_metric(spark):
    found = {tuple(r) for r in op.pair_best_metric(pairs(spark), "confidence").collect()}
    assert found == {(1, "a", "b", 0.9), (1, "a", "c", 0.5), (1, "a", "d", 0.5), (2, "a", "b", 0.5)}


def test_mba_documents(spark):
    found = {r.country_id: r for r in op.mba_documents(pairs(spark)).collect()}
    assert found.keys() == {"1", "2"}
    assert (found["1"].criteria, found["1"].type, found["1"].code) == ("mba", "antecedent", "a")
    assert values(found["1"]) == [("d", "lift", "10.25"), ("b", "lift", "2"), ("c", "lift", "2")]
    assert values(found["2"]) == [("b", "lift", "1")]


def test_metric_follows_the_parameter(spark):
    found = {r.country_id: r for r in op.mba_documents(pairs(spark), "support").collect()}
    assert values(found["1"]) == [("b", "support", "0.5"), ("c", "support", "0.3"), ("d", "support", "0.3")]
    assert values(found["2"]) == [("b", "support", "0.0005")]


def ranking(spark):
    rows = [(1, 7, f"{i:02d}", i) for i in (2, 10, 1)] + [(1, 8, None, 1)]
    return spark.createDataFrame(rows, "country_id int, partner_id long, gtin string, rank int")


def test_ranking_documents_sort_ranks_as_numbers(spark):
    found = {r.code: r for r in op.ranking_documents(ranking(spark)).collect()}
    assert (found["7"].criteria, found["7"].type) == ("ranking", "partner_id")
    assert values(found["7"]) == [("01", "rank", "1"), ("02", "rank", "2"), ("10", "rank", "10")]


def test_messages_are_json_in_json_and_keep_nulls(spark):
    messages = op.to_messages(op.ranking_documents(ranking(spark)), "ranking").collect()
    assert {m.event_type for m in messages} == {"ranking"}
    documents = {}
    for message in messages:
        envelope = json.loads(message.message)
        assert list(envelope) == ["default"]
        document = json.loads(envelope["default"])
        documents[document["code"]] = document
    assert documents["8"] == {
        "country_id": "1", "criteria": "ranking", "type": "partner_id", "code": "8",
        "recommendation": [{"code": None, "metric": "rank", "metric_value": "1"}],
    }
    assert len(documents["7"]["recommendation"]) == 3


def test_messages_turn_decimals_into_numbers(spark):
    df = spark.sql("select cast(1.50 as decimal(10,2)) as amount, array(1, 2) as many")
    message = op.to_messages(df, "mba").first().message
    assert json.loads(json.loads(message)["default"]) == {"amount": 1.5, "many": [1, 2]}
