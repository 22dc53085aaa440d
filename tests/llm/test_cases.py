"""Null ids, repeated rows and written shards, where the other tests leave them out."""

from __future__ import annotations

import random
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import line_dedup, mixing, near_duplicates, quality_rules, sharding
from basketry.llm.components import connected_components
from basketry.llm.rows import TEXT_ROWS, identified, text_batches
from basketry.workspace import Workspace

TEXT = " ".join(f"word{i}" for i in range(80))
OTHER = " ".join(f"other{i}" for i in range(80))
SCHEMA = "doc_id long, text string, source string, shard int"


@pytest.fixture
def ws(spark):
    with Workspace(spark) as ws:
        yield ws


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 9) for i, t in rows], SCHEMA).repartition(3)


def test_near_duplicates_of_null_ids(spark, ws):
    """A null id never names a component that has another one; equal rows are all returned."""
    rows = [(None, TEXT), (5, TEXT + " more"), (7, TEXT), (7, TEXT), (None, OTHER), (None, None), (3, "")]
    found = near_duplicates.near_duplicates(identified(frame(spark, rows)), ws, near_duplicates.Similarity(words=3, share=90))
    table = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)
    assert table == sorted([(None, 78, 5), (5, 79, 5), (7, 78, 5), (7, 78, 5), (None, 78, None), (None, 0, None), (3, 0, 3)], key=repr)
    kept = near_duplicates.without_near_duplicates(frame(spark, rows), ws, near_duplicates.Similarity(words=3, share=90)).collect()
    assert sorted((len(r["text"] or ""), r["shard"]) for r in kept) == [(0, 9), (0, 9), (len(TEXT), 9), (len(OTHER), 9)]


def test_line_dedup_of_null_ids(spark, ws):
    """A null id comes first in the order, so the other document loses the passage."""
    rows = [(None, f"{TEXT}\nown line one"), (4, f"begin\n{TEXT}\nown line two"), (9, f"{OTHER}\n{TEXT}"), (9, f"{OTHER}\n{TEXT}")]
    found = sorted(((r["doc_id"], r["text"], r["removed"]) for r in line_dedup.deduplicated(frame(spark, rows), ws).collect()), key=repr)
    wanted = [(None, rows[0][1], []), (4, "begin\nown line two", [1]), (9, OTHER, [1]), (9, OTHER, [1])]
    assert found == sorted(wanted, key=repr)


def test_written_shards_hold_every_row_once(spark, ws, tmp_path):
    rows = [(i, f"text {i}") for i in range(200)] + [(None, "null"), (7, "text 7"), (8, None)]
    docs = frame(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "shards"), 6)
    found = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr) == sorted(rows, key=repr)
    wanted = {(r["doc_id"], r["shard"]) for r in sharding.assign_shards(docs, 6, ws).collect()}
    assert {(r["doc_id"], r["shard"]) for r in found.collect()} == wanted and len({s for _, s in wanted}) == 6


def test_a_mix_of_null_ids_and_sources(spark, ws):
    docs = spark.createDataFrame([(None, "a b c", None), (None, "a b c", None), (1, "d e", "x"), (1, "d e", "x"), (2, None, "x")], "doc_id long, text string, source string")
    found = mixing.mixed(docs, ws).collect()
    assert len(found) == 5 and all(r["taken"] <= 3 * r["size"] for r in found)


def test_ablation_of_nothing_and_of_null_texts(spark):
    empty = quality_rules.ablation(quality_rules.ledger(frame(spark, []).limit(0)), quality_rules.POLICIES[1]).collect()
    assert all((r["failed"] or 0) == 0 for r in empty)
    rows = quality_rules.ledger(frame(spark, [(1, None), (2, ""), (None, TEXT)]))
    assert rows.count() == 3 and rows.filter("n_words = 0").count() == 2
    assert rows.filter(F.col("doc_id").isNull()).first()["n_words"] == 80


def test_values_made_of_a_batch_leave_a_task_in_pieces():
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(500)]
    every = SimpleNamespace(value=np.full(1 << 10, ~np.uint64(0), np.uint64))
    similarity = near_duplicates.Similarity(words=5, share=80)
    run = near_duplicates._of_listed(similarity, every, "shingles", pa.binary(), np.ndarray.tobytes)
    rows = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(500), pa.int64())], names=["text", "row_a"])
    pieces = list(run(iter([rows])))
    assert sum(p.num_rows for p in pieces) == 500 and max(p.nbytes for p in pieces) < 2 * near_duplicates.PIECE
    whole = {x for p in pieces for x in p.column(0).to_pylist()}
    assert whole == {int(near_duplicates._set_id(s).view(np.int64)) for _, s in near_duplicates._shingle_sets(pa.array(texts), 5)}


def written(ws):
    """Names of the tables that a workspace has written, in order."""
    return [p.name.partition("-")[2] for p in sorted(Path(ws.path.removeprefix("file:")).iterdir())]


def test_components_write_one_table_a_round(spark, ws):
    nodes = list(range(1, 301))
    random.Random(3).shuffle(nodes)
    edges = [*zip(nodes, nodes[1:]), *((1000, 1000 + i) for i in range(1, 50)), (2000, 2000)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3), ws)
    expected = {n: 1 for n in nodes} | {1000 + i: 1000 for i in range(50)}
    assert {r["node"]: r["component"] for r in found.collect()} == expected
    names = written(ws)
    assert set(names) == {"edges", "labels"} and len(names) < 20


def test_rounds_without_new_pairs_write_nothing_more(spark, ws):
    """Each written file starts processes that the tool counts as large as the executor, so no table is written for nothing."""
    near = [(i, f"{TEXT} tail{i}") for i in range(6)]
    docs = frame(spark, [*near, (10, OTHER), (11, OTHER), (12, None), (13, "")])
    rows = near_duplicates.near_duplicates(identified(docs), ws, near_duplicates.Similarity(5, 80)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict.fromkeys(range(6), 0) | {10: 10, 11: 10, 12: 12, 13: 13}
    names = written(ws)
    assert [names.count(n) for n in ("sets", "verified", "edges")] == [1, 1, 1]
    assert not [n for n in names if n.startswith("rows-") or n == "merged"]


def test_links_of_a_later_round_are_in_the_components(spark, ws):
    """Sets that share a part, are linked in a chain, and of which the run's first is linked with none."""
    similarity = near_duplicates.Similarity(1, 80)
    base = [f"c{i}" for i in range(40)]
    rng = random.Random(5)
    docs = []
    for group in range(8):
        own = base[:20] + [f"g{group}x{i}" for i in range(60)]
        docs += [(100 * group + k, " ".join(own[:80 - k] + [f"g{group}y{i}" for i in range(k)])) for k in range(0, 12, 2)]
    rng.shuffle(docs)
    rows = near_duplicates.near_duplicates(identified(frame(spark, docs)), ws, similarity).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i // 100 * 100 for i, _ in docs}


def test_texts_go_to_python_in_small_batches(spark, ws, monkeypatch):
    """Every table that a text or a set of shingles goes to Python for is made from batches of few rows."""
    key, save, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", Workspace.save, {}

    def watched(self, df, name):
        seen[name] = int(spark.conf.get(key))
        return save(self, df, name)

    monkeypatch.setattr(Workspace, "save", watched)
    before = spark.conf.get(key)
    docs = frame(spark, [(i, f"{TEXT} tail{i % 3}") for i in range(2 * TEXT_ROWS + 5)]).coalesce(1)
    rows = near_duplicates.near_duplicates(identified(docs), ws, near_duplicates.Similarity(5, 80))
    assert rows.filter("component_id = 0").count() == 2 * TEXT_ROWS + 5
    assert {n: k for n, k in seen.items() if n in ("features", "keys", "parities", "sets", "verified")} == dict.fromkeys(("features", "keys", "parities", "sets", "verified"), TEXT_ROWS)
    assert spark.conf.get(key) == before
    with text_batches(spark):
        def sizes(batches):
            yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in batches)

        assert max(r["n"] for r in docs.select("text").mapInArrow(sizes, "n long").collect()) <= TEXT_ROWS
    with pytest.raises(ValueError), text_batches(spark):
        raise ValueError
    assert spark.conf.get(key) == before
