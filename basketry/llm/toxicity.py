"""Toxicity by a weighted finite-state pattern grammar.

Words become classes (insult, threat, target, negation, report, quote), and clauses run through composed
transducers: negation and reported speech rewrite insults and threats that they govern, a target shortly
before one binds it, and the last machine sums weights per kind of matched clause. Documents are
scored on these sums and on the share of plain and bound matches, not on isolated words.

Learned from a bounded sample (up to ``PER_CLASS`` documents of each class outside the held-out fold): the
insult lexicon, words of any length and word beginnings by log odds, bounded by support and odds alone, and the weights of the kinds, by a logistic
model; in training, a document's own share is taken out of the lexicon's counts. Closed classes are
fixed lists. Scores use the text alone and cover whole texts.

Cases: null and empty texts match nothing and get the score of texts without matches; without labels of
both classes the lexicon is empty; equal rows get equal scores; null ids are scored and not held out; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.labelled import labelled_sample
from basketry.llm.rows import batch, plain
from basketry.workspace import Workspace

FOLDS, HELD_OUT = 3, 1
PER_CLASS = 3000
SHORTEST, LONGEST = 4, 8  # letters of word beginnings
LEAST_DOCS, LEAST_ODDS = 4, 2.0
SURE = 1.4  # standard errors by which log odds must exceed LEAST_ODDS

# Closed word classes in English, German, French and Spanish.
THREATS = "kill hurt destroy die burn beat shoot attack töten sterben verbrennen schlagen tuer mourir brûler frapper matar morir quemar golpear"
TARGETS = "you your yours they them he she him her people du dich dir ihr euch sie er tu toi vous ils elles il elle tú usted ustedes ellos ellas él ella"
NEGATIONS = "not no never neither nor without cannot don't isn't nicht kein keine nie niemals ohne pas jamais sans nunca jamás sin tampoco"
REPORTS = "said says wrote writes called calls claimed quoted reported sagte schrieb nannte behauptete dit écrit appelé dijo escribió llamó"
CLASSES = {w: c for c, ws in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in ws.split()}

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.,;:!?\n|\"“”„«»]")
ENDS = set(".,;:!?\n|")
#: Marks that open a quotation, with those that close it.
QUOTES = {'"': '"', "„": "“”", "“": "”", "«": "»", "»": "«"}
MARKS = {*QUOTES, *"".join(QUOTES.values())}
KINDS = ("plain", "bound", "negated", "reported", "threat")

Step = tuple[int, str, float]


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) → (state, output, factor); other symbols pass and lead to ``rest`` of the state."""

    steps: dict[tuple[int, str], Step]
    rest: dict[int, int]

    def step(self, state: int, symbol: str) -> Step:
        return self.steps.get((state, symbol)) or (self.rest.get(state, state), symbol, 1.0)


class Composed:
    """Transducers in a row; the product's states are made as texts reach them."""

    def __init__(self, *parts: Transducer) -> None:
        self.parts, self._memo = parts, {}

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str, float]:
        found = self._memo.get((state, symbol))
        if found is None:
            after, out, factor = [], symbol, 1.0
            for part, s in zip(self.parts, state, strict=True):
                s, out, f = part.step(s, out)
                after.append(s)
                factor *= f
            found = self._memo[state, symbol] = (tuple(after), out, factor)
        return found


def _governs(trigger: str, mark: str, reach: int) -> Transducer:
    """After the trigger, insults and threats within ``reach`` words carry the mark."""
    steps: dict[tuple[int, str], Step] = {(s, trigger): (reach, trigger, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        steps[s, "insult"] = (s, mark, 1.0)
        steps[s, "threat"] = (s, mark, 1.0)
    return Transducer(steps, {s: max(0, s - 1) for s in range(reach + 1)})


def _quotation() -> Transducer:
    """Inside paired quotation marks, insults and threats are reported."""
    return Transducer(
        {(0, "open"): (1, "open", 1.0), (1, "close"): (0, "close", 1.0), (1, "insult"): (1, "reported", 1.0), (1, "threat"): (1, "reported", 1.0)},
        {},
    )


def _binding(reach: int = 4) -> Transducer:
    """A target within ``reach`` words before binds an insult; a threat to a target weighs more."""
    steps: dict[tuple[int, str], Step] = {(s, "target"): (reach, "target", 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        steps[s, "insult"] = (reach, "bound", 1.5)
        steps[s, "threat"] = (reach, "threat", 2.0)
    return Transducer(steps, {s: max(0, s - 1) for s in range(reach + 1)})


def grammar() -> Composed:
    return Composed(_governs("negation", "negated", 3), _governs("report", "reported", 8), _quotation(), _binding())


START = (0, 0, 0, 0)
BACKWARDS = _binding()


def quotations(tokens: list[str]) -> dict[int, str]:
    """Place and symbol of the marks that pair up within a paragraph; a mark without its partner is none."""
    found: dict[int, str] = {}
    opened: tuple[int, str] | None = None
    for i, token in enumerate(tokens):
        if token == "\n" and tokens[i - 1 : i] == ["\n"]:
            opened = None
        elif token in MARKS:
            if opened and token in QUOTES[opened[1]]:
                found[opened[0]], found[i] = "open", "close"
                opened = None
            elif token in QUOTES and (opened is None or opened[1] != '"'):
                opened = (i, token)
    return found


def bound_from_behind(clause: list[tuple[str, str, float, float]]) -> Iterator[tuple[str, str, float, float]]:
    """The clause's (symbol, output, weight, factor) once targets that follow a match bind it, too: it is read backwards."""
    state = 0
    for symbol, out, weight, factor in reversed(clause):
        state, again, more = BACKWARDS.step(state, out)
        yield (symbol, again, weight, more) if out == "insult" or out == "threat" and factor == 1.0 else (symbol, out, weight, factor)


def units(word: str) -> list[str]:
    """The word and its beginnings, as the lexicon names them."""
    return [word] + [f"{word[:k]}*" for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)]


class Lexicon:
    """Units with the numbers of toxic and other documents that have them."""

    def __init__(self, counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> None:
        self.counts, self.toxic, self.clean = counts, toxic, clean
        self.stems = {u[:SHORTEST] for u in counts}
        self._memo: dict[tuple[str, int | None], float] = {}

    def odds(self, toxic: int, clean: int) -> float:
        return math.log((toxic + 0.5) / (self.toxic + 1)) - math.log((clean + 0.5) / (self.clean + 1))

    def weight(self, word: str, own: int | None = None) -> float:
        """The largest log odds of the word's units; ``own``: the label of the document to leave out."""
        if word[:SHORTEST] not in self.stems:
            return 0.0
        if (word, own) not in self._memo:
            best = 0.0
            for u in units(word):
                if u in self.counts:
                    t, c = self.counts[u]
                    t, c = t - (own == 1), c - (own == 0)
                    if t >= LEAST_DOCS - 1 and (w := self.odds(t, c)) >= LEAST_ODDS:
                        best = max(best, w)
            if len(self._memo) > 100_000:
                self._memo.clear()
            self._memo[word, own] = best
        return self._memo[word, own]


def matched(text: str, lexicon: Lexicon, machine: Composed, own: int | None = None) -> list[float]:
    """Per kind, the log of 1 plus the sum of matched clause weights; then the log of 1 plus plain and bound insults per 100 words."""
    sums = dict.fromkeys(KINDS, 0.0)
    state, words, hits = START, 0, 0
    tokens = TOKEN.findall(text.lower())
    marks = quotations(tokens) if not MARKS.isdisjoint(tokens) else {}
    clause: list[tuple[str, str, float, float]] = []
    for i, token in enumerate([*tokens, "\n"]):
        if token in ENDS:
            for symbol, out, weight, factor in bound_from_behind(clause):
                if symbol in ("insult", "threat"):
                    sums["plain" if out == "insult" else out] += weight * factor
                    hits += out in ("insult", "bound")
            clause = []
            state = (0, 0, state[2], 0)  # a clause ends; a quotation may go on
            continue
        weight = 1.0
        if token in MARKS:
            if i not in marks:
                continue
            symbol = marks[i]
        else:
            words += 1
            symbol = CLASSES.get(token, "other")
            if symbol == "other" and (w := lexicon.weight(token, own)):
                symbol, weight = "insult", w
        state, out, factor = machine.step(state, symbol)
        clause.append((symbol, out, weight, factor))
    return [math.log1p(sums[k]) for k in KINDS] + [math.log1p(100.0 * hits / max(words, 1))]


def _document_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) → distinct units of each document, summed up per batch."""
    fields = pa.schema([("unit", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for b in batches:
        counts: dict[str, list[int]] = {}
        for text, label in zip(plain(b.column(0)), plain(b.column(1)), strict=True):
            for u in {u for w in set(TOKEN.findall((text.as_py() or "").lower())) if w[0].isalpha() for u in units(w)}:
                counts.setdefault(u, [0, 0])[0 if label.as_py() else 1] += 1
        if counts:
            toxic, clean = zip(*counts.values(), strict=True)
            yield batch(fields, {"unit": list(counts), "toxic": list(toxic), "clean": list(clean)})


def learn_lexicon(training: DataFrame) -> Lexicon:
    """Units in enough toxic documents at odds that are surely high; longer ones only where they say more.

    Without the standard error, words of a few near copies would pass for insults.
    """
    sizes = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = training.select("text", "label").mapInArrow(_document_units, "unit string, toxic long, clean long")
    counts = counts.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    counts = counts.filter((F.col("toxic") >= LEAST_DOCS) & (odds - SURE * error >= LEAST_ODDS))  # of a bounded sample
    table = Lexicon({}, toxic, clean)
    kept: dict[str, tuple[int, int]] = {}
    for r in sorted(counts.collect(), key=lambda r: (len(r["unit"].rstrip("*")), not r["unit"].endswith("*"), r["unit"])):
        shorter = [kept[f"{r['unit'][:k]}*"] for k in range(SHORTEST, LONGEST + 1) if f"{r['unit'][:k]}*" in kept]
        if all(table.odds(*s) < table.odds(r["toxic"], r["clean"]) - 0.7 for s in shorter):
            kept[r["unit"]] = (r["toxic"], r["clean"])
    return Lexicon(kept, toxic, clean)


def _features(lexicon: Lexicon) -> Callable:
    fields = pa.schema([("label", pa.float64()), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar()
        for b in batches:
            labels = plain(b.column(1)).to_pylist()
            rows = [matched(t or "", lexicon, machine, y) for t, y in zip(plain(b.column(0)).to_pylist(), labels, strict=True)]
            yield batch(fields, {"label": [float(y) for y in labels], "features": rows})

    return run


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: tuple[float, ...]
    intercept: float

    def score(self, text: str, machine: Composed) -> float:
        total = self.intercept + float(np.dot(self.weights, matched(text, self.lexicon, machine)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def toxicity_model(docs: DataFrame, labels: DataFrame, ws: Workspace) -> ToxicityModel:
    sample, shift = labelled_sample(labels, "toxic", FOLDS, HELD_OUT, PER_CLASS, ws)
    training = ws.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("text", "label"), "toxicity-training")
    lexicon = learn_lexicon(training)
    if not lexicon.toxic or not lexicon.clean:
        return ToxicityModel(Lexicon({}, lexicon.toxic, lexicon.clean), (0.0,) * (len(KINDS) + 1), math.log((lexicon.toxic + 0.5) / (lexicon.clean + 0.5)))
    table = ws.save(training.mapInArrow(_features(lexicon), "label double, features array<double>"), "toxicity-table")
    model = LogisticRegression(regParam=0.0005, maxIter=100).fit(table.select("label", array_to_vector("features").alias("features")))
    return ToxicityModel(lexicon, tuple(map(float, model.coefficients.toArray())), float(model.intercept) + shift)


def _scored(model: ToxicityModel) -> Callable:
    fields = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar()
        for b in batches:
            yield batch(fields, {"doc_id": b.column(0), "score": [model.score(t.as_py() or "", machine) for t in plain(b.column(1))]})

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, score) of each row."""
    model = toxicity_model(docs, labels, ws)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(model), "doc_id long, score double")
