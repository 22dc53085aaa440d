"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Trees are grown on a bounded sample of labelled documents, every path from a root becomes a rule, and a
logistic model with an L1 penalty over all rules keeps few of them. Rules and weights compile into one
column expression, so scoring runs inside Spark's generated code on the statistics of each row.

The sample: up to ``PER_CLASS`` labelled documents of each class outside the held-out fold. Statistics and
scores cover every row and whole texts.

Cases: null and empty texts have zero statistics and a score like any other; without labels of both
classes the score is one constant; equal rows get equal scores; null ids are scored; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.labelled import labelled_sample
from basketry.llm.quality_rules import CARRIED, measured
from basketry.workspace import Workspace

FOLDS, HELD_OUT = 4, 2
PER_CLASS = 5000
TREES, DEPTH, PENALTY, SEED = 16, 3, 0.002, 11

#: Shares per word, character or line, each with its column expression over the measurements.
STATISTICS = {
    "words": "log(1.0 + n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "equal_lines": "n_dup_lines / greatest(n_lines, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction of (statistic, lower bound, upper bound): lower < statistic <= upper."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            if low > -math.inf:
                parts.append(F.col(name) > low)
            if high < math.inf:
                parts.append(F.col(name) <= high)
        return reduce(Column.__and__, parts)


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def shifted(self, log_odds: float) -> RuleEnsemble:
        """The model for other shares of the labels than it was taught by."""
        return replace(self, intercept=self.intercept + log_odds)

    def score(self) -> Column:
        """The probability of label 1 as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.holds(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the statistics of each row; with ``carry`` the whole row as a struct, too.

    They leave through a generator: a filter on the score stays above it, where the statistics are
    values, instead of repeating the measuring for each of its terms.
    """
    values = [F.expr(e).cast("double").alias(n) for n, e in STATISTICS.items()]
    one = F.struct(*([F.col(CARRIED)] if carry else []), "doc_id", *values)
    return measured(docs, carry).select(F.inline(F.array(one)))


def _paths(node, bounds: dict[str, tuple[float, float]], names: list[str], out: set[Rule]) -> None:
    """Rules for the node and all below it; ``node`` is a tree node of the fitted model."""
    if bounds:
        out.add(Rule(tuple(sorted((n, *b) for n, b in bounds.items()))))
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    name, at = names[split.featureIndex()], split.threshold()
    low, high = bounds.get(name, (-math.inf, math.inf))
    _paths(node.leftChild(), {**bounds, name: (low, min(high, at))}, names, out)
    _paths(node.rightChild(), {**bounds, name: (max(low, at), high)}, names, out)


def fit(rows: DataFrame, ws: Workspace) -> RuleEnsemble:
    """Trees, their paths as rules, and lasso weights, from statistics with ``label``."""
    names = list(STATISTICS)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleEnsemble((), (), math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="0.6", minInstancesPerNode=5, seed=SEED)
    found: set[Rule] = set()
    for tree in forest.fit(vectors).trees:
        _paths(tree._java_obj.rootNode(), {}, names, found)
    rules = tuple(sorted(found))
    if not rules:
        return RuleEnsemble((), (), math.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    held = F.array(*[F.when(r.holds(), F.lit(1.0)).otherwise(F.lit(0.0)) for r in rules])
    table = ws.save(rows.select(held.alias("held"), F.col("label").cast("double").alias("label")), "rule-table")
    table = table.select(array_to_vector("held").alias("features"), "label")
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, standardization=False, maxIter=100)
    model = lasso.fit(table)
    used = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if abs(w) > 1e-9]
    return RuleEnsemble(tuple(r for r, _ in used), tuple(w for _, w in used), float(model.intercept))


def quality_model(rows: DataFrame, labels: DataFrame, ws: Workspace) -> RuleEnsemble:
    """The ensemble that ``labels`` teach; ``rows`` are statistics with doc_id."""
    sample, shift = labelled_sample(labels, "quality", FOLDS, HELD_OUT, PER_CLASS, ws)
    return fit(ws.save(rows.join(sample, "doc_id"), "training"), ws).shifted(shift)


def good_documents(docs: DataFrame, labels: DataFrame, least: float, ws: Workspace) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, all columns as they are."""
    sample, shift = labelled_sample(labels, "quality", FOLDS, HELD_OUT, PER_CLASS, ws)
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    taught = statistics(taught, carry=True).withColumn("label", F.col(f"{CARRIED}.label")).drop(CARRIED)
    model = fit(ws.save(taught, "training"), ws).shifted(shift)
    return statistics(docs, carry=True).filter(model.score() >= least).select(f"{CARRIED}.*")


def quality_scores(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, score) of each row."""
    rows = ws.save(statistics(docs), "statistics")
    return rows.select("doc_id", quality_model(rows, labels, ws).score().alias("score"))
