"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets whole epochs while its target holds them; the rest of its target is drawn without
replacement: rows are ordered by an exponential key, -ln(u) / quality weight, and taken while the
running sum of sizes comes nearer to the rest. u is hashed from seed, id and text, so reruns agree.

Targets share the sum of all sizes by weight. A target stops at ``most`` times its source's size, and the
excess is shared anew among the others: with sources ordered by size / weight the stopped ones come
first, so running sums over that order give the level at once.

Cases: a null text has size 0 and is never short of room; a null source is a source, last in order; a
null id counts as ``null`` in the hash; equal rows are taken or not one by one; sources without words
get the target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.order import in_order
from basketry.llm.quality_rules import SYMBOLS, word_list
from basketry.llm.rows import row_key
from basketry.workspace import Workspace

SEED = 7
MOST = 3


def quality_weight(text: Column) -> Column:
    """From 0.05 to 1: a text loses a tenth for each percent of symbols among its characters."""
    whole = F.greatest(F.length(text), F.lit(1))
    symbols = F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(10.0) * symbols / whole)


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: int = SEED) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text)
    digits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double")
    return -F.log((digits + 0.5) / F.lit(float(1 << 48))) / weight


PLACE = ["key", "doc_id", "row_a", "row_b"]


def _place(seed: int) -> dict[str, Column]:
    """The source of a row, and what orders the rows of a source."""
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = sampling_key(F.col("doc_id"), text, quality_weight(text), seed)
    row = row_key(doc_id, F.struct(source.alias("source"), "text"))
    return {"source": source, **dict(zip(PLACE, [key, doc_id, *row], strict=True))}


def source_targets(sources: DataFrame, ws: Workspace, most: int = MOST) -> DataFrame:
    """(source, source_size) → with ``target``: weights 1, 2, 3, repeating, by code point of the source."""
    ranked = in_order(sources, [F.col("source").asc_nulls_last()], [], ws, "sources")
    ranked = ranked.withColumn("weight", F.col("position") % 3 + 1).withColumn("most", most * F.col("source_size"))
    # size / weight in whole numbers: weights divide 6.
    filling = in_order(ranked.drop("position"), [F.expr("source_size * (6 div weight)")], ["most", "weight"], ws, "filling")
    total = filling.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if not total["size"]:
        return filling.select("source", "source_size", F.lit(0.0).alias("target"))
    left, weight = F.lit(total["size"]) - F.col("most_before"), F.lit(total["weight"]) - F.col("weight_before")
    stopped = F.col("most") * weight < F.col("weight") * left
    level = filling.filter(~stopped).orderBy("position").select(left.alias("left"), weight.alias("weight")).first()
    share = F.col("weight") * F.lit(level["left"]) / F.lit(level["weight"])
    return filling.select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def mixed(docs: DataFrame, ws: Workspace, seed: int = SEED, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, chosen, taken) of each row; taken = size × copies."""
    size = F.size(word_list(F.coalesce(F.col("text"), F.lit("")))).cast("long")
    rows = docs.select(size.alias("size"), *[c.alias(name) for name, c in _place(seed).items()])
    order = [F.col("source").asc_nulls_last(), *map(F.col, ("key", "doc_id", "row_a", "row_b"))]
    placed = ws.save(in_order(rows, order, ["size"], ws, "mix"), "mix")
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("size_before").alias("first"))
    sources = ws.save(sources, "source-sizes")
    targets = source_targets(sources.select("source", "source_size"), ws, most)
    targets = targets.withColumnRenamed("source", "own").join(sources.drop("source_size"), F.col("own").eqNullSafe(F.col("source"))).drop("source")
    placed = placed.join(ws.save(targets, "targets"), F.col("source").eqNullSafe(F.col("own")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    before = F.col("size_before") - F.col("first")
    placed = placed.withColumn("epochs", epochs.cast("long")).withColumn("chosen", (F.col("size") > 0) & (2 * before + F.col("size") <= 2 * rest))
    taken = F.col("size") * (F.col("epochs") + F.col("chosen").cast("long"))
    return placed.select("doc_id", "source", "size", "source_size", "target", "epochs", "chosen", taken.alias("taken"), *PLACE)


def mixture(docs: DataFrame, ws: Workspace, seed: int = SEED, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are.

    The rows chosen from a source are the first in its order, so its last one tells for each row whether it is
    chosen, and texts need not move. Where equal rows lie on both sides of that limit, one stands for all.
    """
    rows = mixed(docs, ws, seed, most)
    place = F.struct(*PLACE)
    ends = rows.groupBy(F.col("source").alias("own")).agg(
        F.max("epochs").alias("epochs"),
        F.max(F.when(F.col("chosen"), place)).alias("last"),
        F.min(F.when(~F.col("chosen") & (F.col("size") > 0), place)).alias("next"),
    )
    ends = ws.save(ends.withColumn("divided", F.coalesce(F.col("last") == F.col("next"), F.lit(False))), "ends")
    own = _place(seed)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own["source"].alias("source"),
        F.struct(*[own[c].alias(c) for c in PLACE]).alias("place"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    ).join(ends, F.col("source").eqNullSafe(F.col("own")))
    chosen = F.col("worded") & F.coalesce(F.col("place") <= F.col("last"), F.lit(False))
    at_limit = F.col("divided") & (F.col("place") == F.col("last"))
    taken = whole.filter(~F.coalesce(at_limit, F.lit(False))).withColumn("copies", F.col("epochs") + chosen.cast("long")).select("row", "copies")
    divided = ends.filter("divided")
    if not divided.isEmpty():
        counts = rows.select("source", "epochs", "chosen", place.alias("place")).join(
            divided.select("own", "last"), F.col("source").eqNullSafe(F.col("own")) & (F.col("place") == F.col("last"))
        ).groupBy("own").agg(F.sum(F.col("epochs") + F.col("chosen").cast("long")).alias("copies")).toDF("of", "copies")
        equal = whole.filter(at_limit).dropDuplicates(["own"])
        taken = taken.unionByName(equal.join(counts, F.col("own").eqNullSafe(F.col("of"))).select("row", "copies"))
    taken = taken.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*[F.col(f"row.`{c}`") for c in docs.columns])
