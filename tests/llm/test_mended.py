"""Linear time in one text, columns that stay, grammar of quotations and targets, and bounds that hold at any size."""

from __future__ import annotations

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from basketry.llm import decontamination, labelled, line_dedup, pii, rule_ensemble, secrets, spans, toxicity
from basketry.workspace import Workspace
from tests.llm import brute


@pytest.fixture
def ws(spark):
    with Workspace(spark) as ws:
        yield ws


def test_columns_named_like_keys_stay(spark, ws):
    rows = [(1, "one two three four five six seven eight nine ten eleven", 111, 222, "x", 7), (2, "other words", 333, 444, "y", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row_a long, _row_b long, row string, row_a int")
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    assert [tuple(r) for r in decontamination.decontaminated(docs, benchmark, ws).collect()] == [rows[1]]


def test_items_of_shared_windows(spark, ws):
    """A sentence that many items begin with: every document has the ids of all of them."""
    opening = " ".join(f"word{i}" for i in range(12))
    items = [(i, f"{opening} item number {i} says more words here") for i in range(300)]
    docs = [(i, f"{opening} and then something else {i}") for i in range(40)] + [(99, items[7][1]), (100, None), (101, "nothing")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), benchmark, ws)
    found = found.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(brute.contamination(docs, items), key=repr)


def test_spans_against_all_pairs():
    rng = random.Random(1)
    held = [(s := rng.randrange(500), 0, s + rng.randrange(1, 12)) for _ in range(80)]
    covered = spans.Covered(held)
    taken, plain = spans.Disjoint(), []
    for _ in range(600):
        start = rng.randrange(510)
        end = start + rng.randrange(1, 9)
        assert covered.overlaps(start, end) == any(s < end and start < e for s, _, e in held)
        free = not any(s < end and start < e for s, e in plain)
        assert taken.take(start, end) == free
        plain += [(start, end)] * free
    assert not spans.Covered([]).overlaps(0, 9)


def _seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def test_many_spans_in_one_text_take_linear_time():
    """100,000 base spans and as many candidates; all pairs of them would take hours."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    text = "\n".join(f"password = abc{i:08d} {''.join(rng.choices(letters, k=18))}" for i in range(100_000))
    base = secrets.base_spans(text)
    assert len(base) == 100_000
    assert _seconds(lambda: sum(1 for _ in secrets.candidates(text, base))) < 60
    covered = spans.Covered(base)
    assert _seconds(lambda: [covered.overlaps(i, i + 5) for i in range(0, len(text), 20)]) < 10
    taken = spans.Disjoint()
    assert _seconds(lambda: [taken.take(i * 7 % 1_000_003, i * 7 % 1_000_003 + 3) for i in range(200_000)]) < 20


def test_many_removed_lines_in_one_text(spark, ws):
    lines = [f"line {i} with ten words or so that stand here for good" for i in range(20_000)]
    docs = [(1, "\n".join(lines)), (2, "\n".join(["own first line", *lines, "", "own last line"])), (3, None), (4, "")]
    start = time.perf_counter()
    found = {r["doc_id"]: r for r in line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), ws).collect()}
    assert time.perf_counter() - start < 60
    assert found[1]["removed"] == [] and found[1]["text"] == docs[0][1]
    assert found[2]["removed"] == list(range(1, 20_001)) and found[2]["text"] == "own first line\n\nown last line"
    assert (found[3]["text"], found[4]["text"]) == (None, "")


def test_a_hot_passage_is_split(spark, ws):
    """A passage in a third of the documents: the join of its windows with their first occurrence can be split."""
    passage = " ".join(f"w{i}" for i in range(55))
    docs = spark.range(3000, numPartitions=6).selectExpr("id as doc_id", f"if(id % 3 = 0, concat('{passage}', '\\n', 'own ', id), concat('line ', id)) as text")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        _, runs = line_dedup.repeated_runs(docs, ws)
        assert runs.count() == 999
        runs.collect()
        assert "skew=true" in runs._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_refuted_candidates_are_never_added(spark, ws):
    """Numbers of a card's form that fail its check, beside cards that pass."""
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    right = lambda body: body + next(c for c in "0123456789" if pii.luhn(body + c))
    cards = [right("4" + digits(14)) for _ in range(200)]
    wrong = [c[:-1] + str((int(c[-1]) + 3) % 10) for c in cards]
    texts = [f"card {c} paid" for c in cards] + [f"card {w} paid" for w in wrong]
    found = pii.personal_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ws).collect()
    assert sum(len(r["spans"]) for r in found if r["doc_id"] < 200) == 200
    assert [r["spans"] for r in found if r["doc_id"] >= 200 and r["spans"]] == []


def test_thresholds_need_support():
    assert pii.calibrated([(9, 3, 3), (8, 4, 4)]) is None
    assert pii.calibrated([(9, 30, 30), (8, 4, 4)]) == 8


LEXICON = toxicity.Lexicon({"idiot": (100, 0)}, 100, 100)


def kinds(text: str) -> list[str]:
    return [k for k, v in zip(toxicity.KINDS, toxicity.matched(text, LEXICON, toxicity.grammar()), strict=False) if v]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("He said „gut“ today. you are an idiot", ["bound"]),  # a German quotation closes
        ('one " stray mark. you are an idiot', ["bound"]),  # a mark without its partner is none
        ('"quoted idiot" it read', ["reported"]), ("«idiot» it read", ["reported"]), ("„idiot“ it read", ["reported"]), ("“idiot” it read", ["reported"]),
        ('a "mark\n\nnext paragraph". you are an idiot', ["bound"]),  # quotations end with their paragraph
        ('"one two.\nstill an idiot" it read', ["reported"]),
        ("idiot you", ["bound"]), ("an idiot. you there", ["plain"]), ("what an idiot he is", ["bound"]),
    ],
)
def test_quotations_and_targets_behind(text, wanted):
    assert kinds(text) == wanted


def test_a_threat_weighs_more_with_its_target_behind():
    threat = lambda text: toxicity.matched(text, LEXICON, toxicity.grammar())[toxicity.KINDS.index("threat")]
    assert threat("kill you") == threat("you kill") > threat("kill time") > 0


def test_the_grammar_against_a_plain_reading():
    """Matches of random texts, by a direct reading of the grammar's rules word by word."""
    rng = random.Random(7)
    words = ["idiot", "kill", "you", "not", "said", "the", "of", "and", '"', "\n", ".", "„", "“"]
    for _ in range(400):
        text = " ".join(rng.choices(words, [3, 2, 3, 1, 1, 4, 4, 4, 1, 1, 2, 1, 1], k=rng.randint(1, 25)))
        assert toxicity.matched(text, LEXICON, toxicity.grammar()) == pytest.approx(_plain_reading(text)), text


def _plain_reading(text: str) -> list[float]:
    tokens = toxicity.TOKEN.findall(text.lower())
    marks = toxicity.quotations(tokens)
    sums, words, hits = dict.fromkeys(toxicity.KINDS, 0.0), 0, 0
    clauses: list[list[tuple[str, bool]]] = [[]]
    quoted = False
    for i, t in enumerate(tokens):
        if t in toxicity.ENDS:
            clauses.append([])
        elif t in toxicity.MARKS:
            if i in marks:
                quoted = marks[i] == "open"
                clauses[-1].append((marks[i], quoted))
        else:
            words += 1
            clauses[-1].append((toxicity.CLASSES.get(t, "insult" if t == "idiot" else "other"), quoted))
    for clause in clauses:
        out = [s for s, _ in clause]
        for trigger, mark, reach in (("negation", "negated", 3), ("report", "reported", 8)):
            out = [mark if m else s for s, m in zip(out, _governed(out, trigger, reach), strict=True)]
        out = ["reported" if quoted and s in ("insult", "threat") else s for s, (_, quoted) in zip(out, clause, strict=True)]
        bound = _bound(out)
        behind = _bound([("insult" if x == "insult" else x) for x in (o if not b else f"{o}!" for o, b in zip(out, bound, strict=True))][::-1])[::-1]
        for o, b, c in zip(out, bound, behind, strict=True):
            weight = LEXICON.weight("idiot") if o == "insult" else 1.0
            if o == "insult":
                sums["bound" if b or c else "plain"] += weight * (1.5 if b or c else 1.0)
                hits += 1
            elif o == "threat":
                sums["threat"] += 2.0 if b or c else 1.0
        for i, o in enumerate(out):
            if o in ("negated", "reported"):
                sums[o] += LEXICON.weight("idiot") if clause[i][0] == "insult" else 1.0
    return [math.log1p(sums[k]) for k in toxicity.KINDS] + [math.log1p(100.0 * hits / max(words, 1))]


def _governed(symbols: list[str], trigger: str, reach: int) -> list[bool]:
    """Whether a trigger stands before a match with at most ``reach`` - 1 other words between, matches not counted."""
    left, found = 0, []
    for s in symbols:
        match = s in ("insult", "threat") and left > 0
        found.append(match)
        left = reach if s == trigger else left if match else max(0, left - 1)
    return found


def _bound(out: list[str]) -> list[bool]:
    """Whether a target, or a match that one binds, is at most four words before."""
    left, bound = 0, []
    for o in out:
        base = o.rstrip("!")
        if base == "target":
            left = 4
            bound.append(False)
        elif left and base in ("insult", "threat"):
            left = 4
            bound.append(not o.endswith("!"))
        else:
            left = max(0, left - 1)
            bound.append(False)
    return bound


def test_the_share_of_labels_is_that_of_all_rows(spark, ws):
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(4000)], "doc_id long, toxic int")
    sample, shift = labelled.labelled_sample(labels, "toxic", 3, 1, 50, ws)
    assert {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()} == {0: 50, 1: 50}
    rest = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    toxic, every = rest.filter("toxic = 1").count(), rest.count()
    assert shift == pytest.approx(math.log(toxic / (every - toxic)))
    whole, none = labelled.labelled_sample(labels, "toxic", 3, 1, 5000, ws)
    assert none == 0.0 and whole.count() == every
    assert labelled.labelled_sample(labels.filter("toxic = 1"), "toxic", 3, 1, 50, ws)[1] == 0.0


def test_compiled_rules_against_a_plain_evaluation(spark, ws):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "through", "a", "valley", "of", "green", "hills"]) for _ in range(rng.randint(40, 120)))
    bad = lambda: " ".join(rng.choice(["###", "BUY", "NOW", "$$$", "!!", "x"]) for _ in range(rng.randint(5, 60)))
    docs = spark.createDataFrame([(i, good() if i % 2 else bad()) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    rows = ws.save(rule_ensemble.statistics(docs), "statistics")
    model = rule_ensemble.quality_model(rows, labels, ws)
    assert model.rules
    for r in rows.withColumn("score", model.score()).collect():
        total = model.intercept
        for rule, weight in zip(model.rules, model.weights, strict=True):
            total += weight * all(low < r[name] <= high for name, low, high in rule.bounds)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))
