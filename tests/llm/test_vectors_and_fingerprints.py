"""Fingerprints, whitening and clustering against plain Python and NumPy, with every odd kind of row."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import clustering, imatch, whitening
from basketry.llm.rows import identified
from basketry.workspace import Workspace

DOCS = "doc_id long, text string, size long, row_a long, term string, fingerprint string, version int"
VECTORS = "vec_id long, embedding array<float>, label int, x string, cluster int, n long"


@pytest.fixture
def ws(spark):
    with Workspace(spark) as ws:
        yield ws


def _texts() -> list[tuple]:
    rng = random.Random(17)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    texts = [text(rng.randint(20, 120)) for _ in range(60)]
    texts += [texts[3], texts[3] + " tail", texts[4].upper(), None, "", " \n\t", "one", "zzz qqq xxx", "é ü 你好 \U0001f600 ß", text(20_000), "y" * 30_000, "a.b,c;d " * 50]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (5, "another text of a repeated id"), (None, "null id"), (None, None)]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, 2, "t", "f", 9) for i, t in TEXTS], DOCS).repartition(5).cache()


def _terms(text: str | None) -> list[str]:
    return list(dict.fromkeys(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w))


def _lexicon(texts: list[str | None]) -> dict[str, int]:
    df, n = Counter(t for text in texts for t in _terms(text)), len(texts)
    code = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16) % (2**31 - 2) + 1
    return {t: code(t) for t, k in df.items() if k * 16 <= n and k * 2048 >= n and k >= 2}


def _fingerprint(text: str | None, lexicon: dict[str, int]) -> str:
    terms = _terms(text)
    codes = [lexicon[t] for t in terms if t in lexicon]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    if not codes:
        whole = md5(" ".join(terms))
        return "-".join([whole[:16]] + [whole[:8]] * 16)
    parts = [md5(" ".join(map(str, sorted(codes))))[:16]]
    for r in range(16):
        factor = pow(48271, r + 1, 2**31 - 1)
        value = {c: c * factor % (2**31 - 1) for c in codes}
        bits = max(1, min(value.values()).bit_length())
        parts.append(md5(" ".join(str(c) for c in sorted(codes) if value[c] < 1 << bits))[:8])
    return "-".join(parts)


def _near(a: str, b: str) -> float:
    return sum(x == y for x, y in zip(a.split("-"), b.split("-"), strict=True)) / 17


def test_fingerprints_against_plain_python(spark, docs, ws):
    keys = {(r["doc_id"], r["text"]): (r["row_a"], r["row_b"]) for r in identified(docs).collect()}
    order = sorted(keys, key=lambda d: (d[0] is not None, d[0] or 0, keys[d]))
    lexicon = _lexicon([t for _, t in TEXTS])
    wanted = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, u = text or "", after or ""
        edited = t[: len(t) - len(t) // 4] + u[: len(t) // 4]
        prints = [_fingerprint(x, lexicon) for x in (t, edited, u)]
        wanted[i, text] = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], _near(*prints[:2]), _near(prints[0], prints[2]))
    found = imatch.edited_fingerprints(docs, ws)
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted((wanted[d] for d in TEXTS), key=repr)


def test_fingerprints_alike_without_broadcast_and_on_few_rows(spark, docs, ws, monkeypatch):
    wanted = sorted(imatch.edited_fingerprints(docs, ws).collect(), key=repr)
    monkeypatch.setattr(imatch, "BROADCAST", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(imatch.edited_fingerprints(docs, ws).collect(), key=repr) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert imatch.edited_fingerprints(docs.limit(0), ws).count() == 0
    one = imatch.edited_fingerprints(spark.createDataFrame([(1, "some words are here")], "doc_id long, text string"), ws).collect()
    assert [(r["near_edited"], r["near_next"]) for r in one] == [(0.0, 1.0)]


def test_fingerprints_stay_in_spark_and_move_texts_once(spark, docs, ws):
    docs = ws.save(docs, "docs")
    keys = identified(docs).select("doc_id", "row_a", "row_b", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edited = imatch.edited(identified(docs), imatch.following(keys, ws))
        edited.collect()
        plan = edited._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") >= 1
    for frame in (edited, imatch.edited_fingerprints(docs, ws)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))


def test_edits_stay_near_and_others_far(spark, ws):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40_000)]
    table = [(i, " ".join(rng.choices(words, k=rng.choice([60, 300, 2000])))) for i in range(120)]
    found = imatch.edited_fingerprints(spark.createDataFrame(table, "doc_id long, text string"), ws).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in found) >= 118
    assert np.mean([r["near_edited"] for r in found]) > 0.4 and np.mean([r["near_next"] for r in found]) < 0.1


def _vectors(length: int = 64) -> list[tuple]:
    rng = np.random.default_rng(11)
    base = rng.normal(0, 0.4, (150, length)).astype(np.float32).tolist()
    odd = [None, [], [None] * length, base[0][:-1] + [None], base[1][:-1] + [float("nan")], base[2][:-1] + [float("inf")], [-math.inf] * length, base[3][:-1], base[4] + [1.0]]
    rows = [(i, v) for i, v in enumerate(base + odd)] + [(7, base[7]), (7, base[8]), (None, base[9]), (None, base[9]), (500, [1000.0] + base[5][1:]), (501, [0.0] * length)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 3, 4) for i, v in rows], VECTORS).repartition(3)


def _whole(rows, length=64):
    return [(i, [math.floor(64 * c) for c in v]) for i, v in rows if v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v)]


def _f32(rows):
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def test_whitening_against_eigenvectors(spark, ws):
    rows = _f32(_vectors())
    kept = _whole(rows)
    x = np.array([v for _, v in kept], np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = whitening.whitened(_frame(spark, rows), ws)
    table = found.collect()
    assert len(table) == 32 * n and {r["n"] for r in table} == {n}
    assert len({r["identity_error"] for r in table}) == 1 and 0 <= table[0]["identity_error"] < 1e-9
    deviations = Counter((i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))) for (i, _), v in zip(kept, x, strict=True))
    assert Counter((r["vec_id"], r["deviation"]) for r in table if r["component"] == 1) == deviations
    got = {(r["vec_id"], r["component"], r["deviation"]): r for r in table}
    for k in range(32):
        own = (centred @ vectors[:, k]) / math.sqrt(values[k])
        mine = np.array([got[i, k + 1, d]["whitened"] for (i, _), d in zip(kept, [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True)) for v in x], strict=True)])
        assert min(np.abs(own - mine).max(), np.abs(own + mine).max()) < 1e-8
    for r in table:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)


def test_whitening_of_few_equal_and_extreme_vectors(spark, ws):
    rng = np.random.default_rng(5)
    flat = rng.normal(0, 1, (40, 3)) @ rng.normal(0, 1, (3, 8))  # rank 3 up to rounding to whole numbers
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate((flat * 1000).tolist())]
    table = whitening.whitened(_frame(spark, rows), ws).collect()
    assert len(table) == 40 * 8 and table[0]["identity_error"] < 1e-6
    copies = [(i, [1.0, 2.0, 3.0]) for i in range(5)]
    assert whitening.whitened(_frame(spark, copies), ws).count() == 0
    two = whitening.whitened(_frame(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0])]), ws).collect()
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"])) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)] and two[0]["explained"] == 1.0
    huge = whitening.whitened(_frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.5, 0.0]), (4, [7.0, 2.0])]), ws).collect()
    assert len(huge) == 4 and huge[0]["identity_error"] < 1e-4  # the other direction has no variance beside the first
    assert all(r["deviation"] is None for r in huge if r["vec_id"] in (1, 2))
    for empty in ([], [(1, None), (2, []), (3, [float("nan")])]):
        assert whitening.whitened(_frame(spark, empty), ws).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<double>"), ws).count() == 2


def test_jacobi_is_accurate_on_graded_matrices():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    values = 10.0 ** -np.arange(24) * 1e12
    g = whitening.orthogonal_columns(whitening.pivoted_factor((q * values) @ q.T))
    found = np.sort(np.asarray((g * g).sum(0), float))[::-1]
    assert np.allclose(found[:10], values[:10], rtol=1e-5)
    unit = np.asarray(g / np.sqrt((g * g).sum(0)), float)
    assert np.abs(unit.T @ unit - np.eye(unit.shape[1])).max() < 1e-12


def _plain_clusters(rows):
    kept = _whole(rows)
    draw = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in draw[:16]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, c), k) for k, c in enumerate(centroids))
    for _ in range(3):
        own = [nearest(v)[1] for _, v in kept]
        means = []
        for k, c in enumerate(centroids):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == k]
            means.append([sum(x) // len(members) for x in zip(*members, strict=True)] if members else c)
        centroids = means
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in last:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, inertia[k], sum(inertia.values()), sha[k]) for i, d, k in last]


@pytest.mark.parametrize("rows", [_vectors(), [(i, [float(i % 3)] * 64) for i in range(40)], _vectors()[:9], [(1, [2.5] * 64)]])
def test_clusters_against_plain_python(spark, ws, rows):
    found = clustering.clustered(_frame(spark, rows), ws)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(_plain_clusters(_f32(rows)), key=repr)


def test_clusters_of_extreme_and_no_vectors(spark, ws):
    rows = [(i, [float(i)] * 64) for i in range(20)] + [(90, [3e38] * 64), (91, [-3e38] * 64), (92, [3e38] * 63 + [0.0])]
    found = {r["vec_id"]: r for r in clustering.clustered(_frame(spark, rows), ws).collect()}
    assert len(found) == 23 and all(found[i]["distance"] is not None for i in range(20))
    assert clustering.clustered(_frame(spark, []), ws).count() == 0
    assert clustering.clustered(_frame(spark, [(1, None), (2, [1.0])]), ws).count() == 0


def test_orchard_finds_the_nearest_with_few_distances():
    rng = np.random.default_rng(8)
    centroids = rng.integers(-5, 6, (60, 4))  # many ties
    x = np.concatenate([rng.integers(-6, 7, (500, 4)), centroids])
    at, best = clustering.Orchard(centroids).nearest(x)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (best == every.min(1)).all() and (at == every.argmin(1)).all()
    one_at, one_best = clustering.Orchard(centroids[:1]).nearest(x)
    assert (one_at == 0).all() and (one_best == every[:, 0]).all()
