"""Benchmark decontamination by winnowing.

A document is hit where it repeats ``span`` consecutive words of a benchmark item. Both sides keep the
smallest k-gram hash of every window of ``span - k + 1`` k-grams; a shared span has the same window
on both sides, hence the same minimum at the same place, so no shared span is missed. Fingerprints are
joined, and every joined place is compared word by word in both directions, so none is reported by
chance. An item with fewer than ``span`` words is one short window: its whole hash is looked up among
the document's grams of that length, and compared likewise.

Skew: equal places of the benchmark are one row with a list of items before the join, so a passage in
many items meets a document once. The join has plain exchanges on both sides; adaptive execution
splits a fingerprint that many documents share. A bitmap of fixed size over the benchmark's
fingerprints drops nearly all document fingerprints before they move.

Cases: null and empty texts have no words and no hits; equal rows get equal results; an empty benchmark
hits nothing, an empty table returns no rows; items with a null id hit like others, but the id is not counted
among a document's items; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.bits import LOG_BITS, bitmap, present
from basketry.llm.rows import ROW_KEY, batch, identified, plain, row_key
from basketry.llm.words import ALNUM_LOWER, Words, grams, mix, slices, words_of
from basketry.workspace import Workspace

SPAN = 10
GRAM = 5

#: One place: its fingerprint, the place's word and the words around it from ``lead`` words before it.
PLACES = "fp long, size int, at long, lead int, around string"


def _short_key(hashes: np.ndarray, size: int) -> np.ndarray:
    return mix(hashes + np.uint64(size))


def _lower(word: bytes) -> str:
    return word.lower().decode("utf-8", "replace")


def _around(words: Words, low: int, high: int) -> str:
    return " ".join(_lower(words.text(i)) for i in range(low, high))


def _minima(words: Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window that lies in one row: its first word, and its smallest k-gram hash."""
    g = grams(words.hash, gram)
    width = span - gram + 1
    count = len(g) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = g[:count].copy()
    for i in range(1, width):
        np.minimum(low, g[i : i + count], out=low)
    whole = np.flatnonzero(words.row[:count] == words.row[span - 1 :])
    return whole, low[whole]


def _window_places(words: Words, windows: np.ndarray, minima: np.ndarray, span: int, gram: int) -> list[tuple]:
    """A place for each distinct selected k-gram of the given windows, rightmost on ties."""
    g = grams(words.hash, gram)
    width = span - gram + 1
    seen: set[int] = set()
    out = []
    for w, m in zip(windows.tolist(), minima, strict=True):
        p = w + width - 1 - int(np.argmax(g[w : w + width][::-1] == m))
        if p in seen:
            continue
        seen.add(p)
        row = words.row[p]
        first, last = int(words.bounds[row]), int(words.bounds[row + 1])
        low, high = max(first, p - (span - gram)), min(last, p + span)
        out.append((row, int(m.view(np.int64)), span, p - first, p - low, _around(words, low, high)))
    return out


def _short_places(words: Words, starts: np.ndarray, keys: np.ndarray, size: int) -> list[tuple]:
    out = []
    for p, key in zip(starts.tolist(), keys, strict=True):
        row = words.row[p]
        out.append((row, int(key.view(np.int64)), size, p - int(words.bounds[row]), 0, _around(words, p, p + size)))
    return out


def _benchmark_places(span: int, gram: int) -> tuple[Callable, str]:
    schema = f"item string, {PLACES}"
    fields = pa.schema([("item", pa.string()), ("fp", pa.int64()), ("size", pa.int32()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = plain(b.column(0))
            for first, data, offsets in slices(b.column(1)):
                words = words_of(first, data, offsets, ALNUM_LOWER)
                places = _window_places(words, *_minima(words, span, gram), span, gram)
                lengths = np.diff(words.bounds)
                for row in np.flatnonzero((lengths > 0) & (lengths < span)).tolist():
                    start, size = int(words.bounds[row]), int(lengths[row])
                    key = _short_key(grams(words.hash[start : start + size], size), size)
                    places += _short_places(words, np.array([start]), key, size)
                if places:
                    row, *rest = zip(*places, strict=True)
                    yield batch(fields, dict(zip(fields.names, [items.take(pa.array([r + first for r in row])), *map(list, rest)], strict=True)))

    return run, schema


def _document_places(span: int, gram: int, bits: Broadcast, sizes: list[int]) -> tuple[Callable, str]:
    """One row per document with its number of words, then a row per place that passes the bitmap."""
    schema = f"doc_id long, row_a long, row_b long, n_words long, {PLACES}"
    fields = pa.schema(
        [("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("n_words", pa.int64())]
        + [("fp", pa.int64()), ("size", pa.int32()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [plain(b.column(i)) for i in (0, 2, 3)]
            for first, data, offsets in slices(b.column(1)):
                words = words_of(first, data, offsets, ALNUM_LOWER)
                nothing = [None] * words.rows
                own = [i.slice(first, words.rows) for i in ids]
                yield batch(fields, dict(zip(fields.names, [*own, np.diff(words.bounds), *[nothing] * 5], strict=True)))
                windows, minima = _minima(words, span, gram)
                hit = present(bits.value, minima)
                places = _window_places(words, windows[hit], minima[hit], span, gram)
                for size in sizes:
                    keys = _short_key(grams(words.hash, size), size)
                    starts = np.flatnonzero(words.row[: len(keys)] == words.row[size - 1 :]) if len(keys) else np.zeros(0, int)
                    starts = starts[present(bits.value, keys[starts])]
                    places += _short_places(words, starts, keys[starts], size)
                if places:
                    row, *rest = zip(*places, strict=True)
                    at = pa.array(row)
                    yield batch(fields, dict(zip(fields.names, [*[i.take(at) for i in own], [None] * len(row), *map(list, rest)], strict=True)))

    return run, schema


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _matched(doc, doc_lead, item, item_lead, size):
    """Starts, counted from the place, of the windows of ``size`` words that are equal on both sides."""
    out = []
    for d, dl, i, il, n in zip(doc, doc_lead, item, item_lead, size, strict=True):
        d, i = d.split(" "), i.split(" ")
        low = -min(dl, il)
        high = min(len(d) - dl, len(i) - il)
        same = [d[dl + k] == i[il + k] for k in range(low, high)]
        out.append([low + k for k in range(len(same) - n + 1) if all(same[k : k + n])])
    return pd.Series(out)


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, ws: Workspace, span: int = SPAN, gram: int = GRAM, log_bits: int = LOG_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every document row with its number of words, and every hit window (row key, first word, size, items_of), and the sets (items, items_of)."""
    spark = docs.sparkSession
    run, schema = _benchmark_places(span, gram)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text"))
    places = ws.save(items.mapInArrow(run, schema), "benchmark-places")
    bits = spark.sparkContext.broadcast(bitmap(places, "fp", log_bits))
    sizes = sorted(r[0] for r in places.select("size").distinct().collect() if r[0] < span)  # fewer than span values
    run, schema = _document_places(span, gram, bits, sizes)
    found = ws.save(identified(docs).mapInArrow(run, schema), "document-places")
    # The same place in several items is one row; a place is told by its words, not by chance of its hash.
    # Windows carry the number of their set of items, and the sets travel on their own.
    known = places.groupBy("fp", "size", "lead", "around").agg(F.sort_array(F.collect_set("item")).alias("items"))
    known = ws.save(known, "known-places")
    sets = ws.save(known.select("items").distinct().withColumn("items_of", F.monotonically_increasing_id()), "item-sets")
    known = ws.save(known.join(sets, "items").drop("items"), "numbered-places")
    candidates = found.filter("fp is not null").alias("d").join(known.alias("k"), ["fp", "size"])
    start = F.explode(_matched("d.around", "d.lead", "k.around", "k.lead", "size")).alias("start")
    windows = candidates.select(*ROW_KEY, "at", "size", "items_of", start)
    return found, windows.select(*ROW_KEY, (F.col("at") + F.col("start")).alias("first_word"), "size", "items_of"), sets


def contamination(docs: DataFrame, benchmark: DataFrame, ws: Workspace, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document row: doc_id, row key, n_words, n_hit (words inside hit windows) and sorted ``items``."""
    found, windows, sets = contaminated_windows(docs, benchmark, ws, span, gram)
    windows = ws.save(windows, "hit-windows")
    spans = windows.groupBy(*ROW_KEY, "first_word").agg(F.max("size").alias("size"))
    # A word counts once: each window adds what lies beyond all earlier ones.
    before = Window.partitionBy(*ROW_KEY).orderBy("first_word").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first_word") + F.col("size")
    fresh = F.greatest(F.lit(0), end - F.greatest("first_word", F.coalesce(F.max(end).over(before), F.lit(0))))
    words = spans.select(*ROW_KEY, fresh.alias("fresh")).groupBy(*ROW_KEY).agg(F.sum("fresh").alias("n_hit"))
    items = (
        windows.select(*ROW_KEY, "items_of").distinct().join(sets, "items_of")
        .select(*ROW_KEY, F.explode("items").alias("item")).distinct()
        .groupBy(*ROW_KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    hits = words.join(items, ROW_KEY, "left")  # hits of null ids only have no items
    return found.filter("n_words is not null").select("doc_id", *ROW_KEY, "n_words").join(hits, ROW_KEY, "left").select(
        "doc_id", *ROW_KEY, "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, ws: Workspace, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without hits, all columns as they are."""
    _, windows, _ = contaminated_windows(docs, benchmark, ws, span, gram)
    hit = ws.save(windows.select(*ROW_KEY).distinct(), "hit-rows")
    keys = zip(ROW_KEY, row_key(F.col("doc_id").cast("long"), F.col("text")), strict=True)
    # The row is carried as one value, so that none of its names can clash with a key.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[k.alias(c) for c, k in keys])
    return keyed.join(hit, ROW_KEY, "left_anti").select(*[F.col(f"row.`{c}`") for c in docs.columns])
