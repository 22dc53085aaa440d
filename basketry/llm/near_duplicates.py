"""N-gram Jaccard join by parity sketches: all links between word-shingle sets, and their components.

Sketch. The range of 64-bit shingle hashes is cut into P equal parts, and each part is the XOR of the
hashes in it. A shingle that only one set has changes one part, so the number of differing parts is at
most the symmetric difference. Sets with similarity t and sizes a and b differ in at most
``d = (1 - t)(a + b) / (1 + t)`` shingles; with ``P = d + 1 + g`` parts at least g + 1 are equal.

Pigeonhole join per size band. Bands grow by half; a set joins its own band and the next one where it
could be linked with it. Parts with fewer than two shingles say little, so a set with at most g of them
leaves them out: one of its g + 1 equal parts is then a telling one. A set with more keeps them all.
No link is lost either way.

Rounds. Rows (part, class) are sorted by range, so a part that very many classes share spreads over tasks.
First each class is verified against the first class of its run. Then, for parts whose classes are
still in several components, a second sketch (bit parities, whose Hamming distance is also at most the
symmetric difference) is compared in blocks: each class with its nearest of another component, and at
last all that remain. Groups that are linked already are never expanded into pairs.

Equal sets are one class from the start, told by 64 bits made of the XOR and the sum over their hashes.

Cases: texts without words (null, empty) have empty sets and no links, each its own component; a text
with fewer than n words has one shingle; equal rows are one class; null ids take part, and a component
is named by its smallest id that is not null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.bits import bitmap, passes, present
from basketry.llm.components import connected_components
from basketry.llm.rows import ROW_KEY, batch, identified, plain, row_key, text_batches
from basketry.llm.words import SPACED_LOWER, grams, mix, slices, words_of
from basketry.workspace import Workspace

GROWTH = 1.5
PIECE = 1 << 18  # keys, or bytes, that a task holds before it sends them on


@dataclass(frozen=True)
class Similarity:
    """Word shingles of ``words`` words; linked at ``share`` percent Jaccard similarity or more."""

    words: int
    share: int

    def most_apart(self, total: int) -> int:
        """The largest symmetric difference of two linked sets whose sizes add up to ``total``."""
        return total * (100 - self.share) // (100 + self.share)


@dataclass(frozen=True)
class Band:
    number: int
    low: int  # sizes low <= n < high are its own
    high: int
    parts: int
    spare: int  # g
    least: int  # shingles of a telling part


class Bands:
    """The size bands of a similarity, made as sizes need them."""

    def __init__(self, similarity: Similarity) -> None:
        self.similarity = similarity
        self._bands: list[Band] = []

    def band(self, number: int) -> Band:
        while len(self._bands) <= number:
            low = self._bands[-1].high if self._bands else 1
            high = max(low + 1, int(low * GROWTH))
            apart = self.similarity.most_apart(2 * (high - 1))
            self._bands.append(Band(len(self._bands), low, high, *self._parts(low, apart)))
        return self._bands[number]

    @staticmethod
    def _parts(low: int, apart: int) -> tuple[int, int, int]:
        """Parts, spare ones, and how many shingles tell: two where the spare parts cover those with fewer, else one."""
        if not apart:
            return 1, 0, 1
        for least in (2, 1):
            for spare in range(1, apart // 2 + 4):
                parts = apart + 1 + spare
                thin = parts * math.exp(-low / parts) * (1 + (low / parts if least == 2 else 0))
                if thin + 2 * math.sqrt(thin) <= spare:
                    return parts, spare, least
        return parts, spare, least

    def of(self, n: int) -> Iterator[Band]:
        """The band of size ``n``, and the next one if a set of it may be linked with this."""
        number = 0
        while self.band(number).high <= n:
            number += 1
        yield self.band(number)
        following = self.band(number + 1)
        if 100 * n >= self.similarity.share * following.low:
            yield following


def _edges(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def _telling_parts(shingles: np.ndarray, band: Band, edges: np.ndarray) -> np.ndarray:
    """Keys of the set's parts in this band; ``shingles`` are distinct and sorted."""
    if band.parts == 1:
        return np.zeros(0, np.uint64)  # only equal sets are linked, and those are one class
    at = np.concatenate(([0], np.searchsorted(shingles, edges), [len(shingles)]))
    upto = np.zeros(len(shingles) + 1, np.uint64)
    np.bitwise_xor.accumulate(shingles, out=upto[1:])
    value = upto[at[1:]] ^ upto[at[:-1]]
    keys = mix(value + mix(np.arange(band.parts, dtype=np.uint64) + np.uint64(band.number << 32)))
    thin = np.diff(at) < band.least
    return keys if thin.sum() > band.spare else keys[~thin]


def _shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    for first, data, offsets in slices(column):
        words = words_of(first, data, offsets, SPACED_LOWER)
        all_grams = grams(words.hash, size)
        for row in range(words.rows):
            low, high = int(words.bounds[row]), int(words.bounds[row + 1])
            if high - low >= size:
                yield first + row, np.unique(all_grams[low : high - size + 1])
            else:
                yield first + row, grams(words.hash[low:high], high - low) if high > low else np.zeros(0, np.uint64)


def _set_id(shingles: np.ndarray) -> np.uint64:
    """64 bits that stand for the set, from XOR and sum over its hashes."""
    if not len(shingles):
        return np.uint64(0)
    n = np.uint64(len(shingles))
    both = mix(np.array([np.bitwise_xor.reduce(shingles) + n, np.add.reduce(mix(shingles + n))], np.uint64))
    return mix(both[:1] + both[1:] * np.uint64(3))[0]


def _features(similarity: Similarity) -> tuple[Callable, str]:
    """Rows (doc_id, text, row_a, row_b) → their set's size and identity."""
    fields = pa.schema([("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("n_shingles", pa.int64()), ("set", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, ids = [], []
            for _, s in _shingle_sets(b.column(1), similarity.words):
                sizes.append(len(s))
                ids.append(_set_id(s))
            yield batch(fields, dict(zip(fields.names, [
                *[plain(b.column(i)) for i in (0, 2, 3)], sizes, np.array(ids, np.uint64).view(np.int64),
            ], strict=True)))

    return run, "doc_id long, row_a long, row_b long, n_shingles long, set long"


def _of_listed(similarity: Similarity, listed: Broadcast, name: str, kind: pa.DataType, made: Callable) -> Callable:
    """Rows (text, row_a) that the bitmap passes → (set, ``name``), the latter ``made`` of their shingles.

    What is made of a batch is many times its rows, so it is sent on in pieces.
    """
    fields = pa.schema([("set", pa.int64()), (name, kind)])

    def rows(sets: list, values: list) -> pa.RecordBatch:
        return batch(fields, {"set": np.array(sets, np.uint64).view(np.int64), name: pa.array(values, kind)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            passed = present(listed.value, plain(b.column(1)).to_numpy(zero_copy_only=False).view(np.uint64))
            sets, values, size = [], [], 0
            for _, s in _shingle_sets(plain(b.column(0)).filter(pa.array(passed)), similarity.words):
                if len(s):
                    sets.append(_set_id(s))
                    values.append(made(s))
                    size += len(values[-1])
                if size >= PIECE:
                    yield rows(sets, values)
                    sets, values, size = [], [], 0
            if sets:
                yield rows(sets, values)

    return run


def _all_keys(similarity: Similarity) -> Callable:
    """Keys of a set's parts in all its bands."""
    bands, edges = Bands(similarity), {}

    def made(shingles: np.ndarray) -> np.ndarray:
        own = []
        for band in bands.of(len(shingles)):
            if band.number not in edges:
                edges[band.number] = _edges(band.parts)
            own.append(_telling_parts(shingles, band, edges[band.number]))
        return np.concatenate(own).view(np.int64)

    return made


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, set) → (key, set, pivot) for keys of several sets; pivot is the run's first set.

    A run may go on in another task, so the pivots of the task's first and last run are passed on with
    ``border``. Memory: one batch, and one row carried to the next.
    """
    fields = pa.schema([("key", pa.int64()), ("set", pa.int64()), ("pivot", pa.int64()), ("border", pa.bool_())])
    carried = None  # the last row: key, set, its pivot, whether it was written
    for b in batches:
        key, sets = (plain(b.column(i)).to_numpy(zero_copy_only=False) for i in (0, 1))
        if carried:
            key, sets = np.concatenate(([carried[0]], key)), np.concatenate(([carried[1]], sets))
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (sets[1:] != sets[:-1])
        key, sets = key[fresh], sets[fresh]
        same = key[1:] == key[:-1]
        start = np.concatenate(([True], ~same))
        pivot = sets[np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))]
        write = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        if carried:
            pivot[key == carried[0]] = carried[2]
            write[0] &= not carried[3]
        else:
            yield batch(fields, {"key": key[:1], "set": sets[:1], "pivot": sets[:1], "border": [True]})
        last_written = bool(write[-1]) or bool(carried and len(key) == 1 and carried[3])
        carried = (key[-1], sets[-1], pivot[-1], last_written)
        if write.any():
            yield batch(fields, {"key": key[write], "set": sets[write], "pivot": pivot[write], "border": np.zeros(int(write.sum()), bool)})
    if carried:
        yield batch(fields, {"key": [carried[0]], "set": [carried[2]], "pivot": [carried[2]], "border": [True]})


def _shared_parts(keys: DataFrame, ws: Workspace) -> DataFrame:
    """(key, set, pivot) for every part value of several classes; all pivots of a key lead to one."""
    rows = keys.select(F.explode("keys").alias("key"), "set")
    ordered = rows.repartitionByRange("key", "set").sortWithinPartitions("key", "set")
    runs = ws.save(ordered.mapInArrow(_runs, "key long, set long, pivot long, border boolean"), "runs")
    # Two rows per task: runs that go on in other tasks.
    border = runs.filter("border").select("key", "set").distinct()
    least = border.groupBy("key").agg(F.min("set").alias("pivot"), F.count(F.lit(1)).alias("pivots")).filter("pivots > 1")
    inside = runs.filter("not border").select("key", "set", "pivot")
    return inside.union(border.join(least, "key").select("key", "set", "pivot"))


def _verify(similarity: Similarity) -> Callable:
    """Pairs with both sets → whether they are linked."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(plain(b.column(2)), plain(b.column(3)), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= similarity.share * (len(both) - common))
            yield batch(fields, {"a": b.column(0), "b": b.column(1), "linked": linked})

    return run


def _possible(similarity: Similarity) -> Callable:
    """Pairs with sizes and parities of both → those that the parities don't rule out."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c, n, m, x, y = (plain(col) for col in b.columns)
            passed = []
            for total, one, two in zip((n.to_numpy() + m.to_numpy()).tolist(), x.to_pylist(), y.to_pylist(), strict=True):
                width = min(len(one), len(two)) // 8
                apart = int(np.bitwise_count(_folded(one, width) ^ _folded(two, width)).sum())
                passed.append(apart <= similarity.most_apart(total))
            keep = pa.array(passed, pa.bool_())
            yield batch(fields, {"a": a.filter(keep), "b": c.filter(keep)})

    return run


def _parities(shingles: np.ndarray) -> bytes:
    """Bit parities of a set, of a power of two of bits from one to two times its size."""
    m = 1 << min(17, max(7, len(shingles).bit_length()))
    odd = np.bincount((shingles & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(body: bytes, size: int) -> np.ndarray:
    """The same parities over fewer bits."""
    x = np.frombuffer(body, np.uint64)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _compared(similarity: Similarity, nearest: bool) -> Callable:
    """Rows of a cell (sorted by it) → pairs of different components that the parities don't rule out.

    ``nearest``: for each class the closest one only. Memory: the rows of one cell, a bounded number.
    """
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(rows: pd.DataFrame) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        width = min(len(x) for x in rows["bits"]) // 8
        bits = np.stack([_folded(x, width) for x in rows["bits"]])
        n, component, sets, block = (rows[c].to_numpy() for c in ("n", "component", "set", "block"))
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        mine = np.flatnonzero(block == low)
        others = mine if low == high else np.flatnonzero(block == high)
        left, right = [], []
        for i in mine.tolist():
            apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
            most = (n[others] + n[i]) * (100 - similarity.share) // (100 + similarity.share)
            near = (apart <= most) & (component[others] != component[i])
            if nearest and near.any():
                j = others[np.argmin(np.where(near, apart, np.iinfo(np.int64).max))]
                left.append(sets[i : i + 1])
                right.append(sets[j : j + 1])
            elif near.any():
                right.append(sets[others[near]])
                left.append(np.full(len(right[-1]), sets[i]))
        if not left:
            return None
        a, b = np.concatenate(left), np.concatenate(right)
        return batch(fields, {"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            rows = b.to_pandas()
            if rest is not None:
                rows = pd.concat([rest, rows], ignore_index=True)
            if not len(rows):
                continue
            cells = rows[["key", "low", "high"]].to_numpy()
            cut = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1
            bounds = [0, *cut.tolist()]
            for x, y in zip(bounds, bounds[1:], strict=False):
                if (found := pairs(rows.iloc[x:y])) is not None:
                    yield found
            rest = rows.iloc[bounds[-1] :]
        if rest is not None and (found := pairs(rest)) is not None:
            yield found

    return run


BLOCK = 1000


class _Join:
    """The rounds over the shared parts of one corpus."""

    def __init__(self, similarity: Similarity, classes: DataFrame, shared: DataFrame, docs: DataFrame, ws: Workspace) -> None:
        self.similarity, self.ws, self.shared, self.classes = similarity, ws, shared, classes
        self.texts = docs.select("text", "row_a")
        # Two classes in one run are verified as a pair at first; the later rounds need longer runs only.
        rows = shared.select("key", "set")
        # Aggregates are written before they are joined: only plain exchanges on both sides let a hot key be split.
        long_runs = ws.save(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 2"), "long-runs")
        self.crowded = ws.save(rows.join(long_runs, "key").select("key", "set", "rows"), "crowded-parts")
        bits = self.made_of(shared.select("set").distinct(), "bits", _parities)
        with text_batches(ws.spark):
            self.parities = ws.save(bits.join(classes.select("set", F.col("n_shingles").alias("n")), "set").select("set", "n", "bits"), "parities")
        self.verified: DataFrame | None = None
        self.labels: DataFrame | None = None  # components of the links so far, where they are made

    def made_of(self, sets: DataFrame, name: str, made: Callable) -> DataFrame:
        """(set, ``name``) of these sets, made anew of one text each; others may be among them."""
        listed = self.classes.join(sets, "set").select("row_a")
        listed = listed.sparkSession.sparkContext.broadcast(bitmap(listed, "row_a"))
        run = _of_listed(self.similarity, listed, name, pa.binary(), made)
        return self.texts.mapInArrow(run, f"set long, {name} binary").dropDuplicates(["set"])

    def verify(self, pairs: DataFrame, compared: bool) -> None:
        """Compare the sets of new pairs (a, b) exactly, after their parities unless these were ``compared``."""
        if self.verified is not None:
            pairs = pairs.join(self.verified, ["a", "b"], "left_anti")
        if not compared:
            one = self.parities.toDF("a", "n", "x")
            two = self.parities.toDF("b", "m", "y")
            pairs = pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "x", "y")
            pairs = pairs.mapInArrow(_possible(self.similarity), "a long, b long")
        pairs, seen = self.ws.save_measured(pairs.select("a", "b"), "possible", pairs=F.count(F.lit(1)))
        if self.verified is not None and not seen.get("pairs"):
            return
        sets = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
        # Only the sets of pairs that the parities leave are made and moved.
        with text_batches(self.ws.spark):
            sets = self.ws.save(self.made_of(sets, "shingles", np.ndarray.tobytes), "sets")
            whole = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", "x", "y")
            whole = whole.mapInArrow(_verify(self.similarity), "a long, b long, linked boolean")
            found, seen = self.ws.save_measured(whole, "verified", links=F.count_if("linked"))
        self.verified = found if self.verified is None else self.verified.union(found)
        if seen.get("links"):
            self.labels = None

    def components(self) -> DataFrame:
        if self.labels is None:
            self.labels = connected_components(self.verified.filter("linked").select("a", "b"), self.ws)
        return self.labels

    def across(self, nearest: bool) -> DataFrame:
        """Pairs of different components that share a part and may be linked."""
        labels = self.components().withColumnRenamed("node", "set")
        rows = self.crowded.join(labels, "set", "left")
        rows = self.ws.save(rows.select("key", "set", "rows", F.coalesce("component", "set").alias("component")), "labelled-parts")
        several = rows.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        several = self.ws.save(several.filter("least < most").select("key"), "several-components")
        rows = rows.join(several, "key")
        rows = rows.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("set"), "blocks").cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cells = rows.select("key", "set", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        cells = cells.join(self.parities, "set").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
        return cells.mapInArrow(_compared(self.similarity, nearest), "a long, b long").distinct()

    def run(self) -> DataFrame:
        first = self.shared.filter("set <> pivot")
        self.verify(first.select(F.least("set", "pivot").alias("a"), F.greatest("set", "pivot").alias("b")).distinct(), compared=False)
        self.verify(self.across(nearest=True), compared=True)
        self.verify(self.across(nearest=False), compared=True)
        return self.components()


def near_duplicates(docs: DataFrame, ws: Workspace, similarity: Similarity) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, row_a, row_b) as (doc_id, row_a, row_b, n_shingles, component_id, component, copies)

    component_id: the smallest doc_id among the rows that links lead to; own rows without words: their own.
    copies: rows of the component. component: its label, null where the row is alone.
    """
    run, schema = _features(similarity)
    with text_batches(ws.spark):
        features = ws.save(docs.select("doc_id", "text", "row_a", "row_b").mapInArrow(run, schema), "features")
    # Copies share a set, and the parts of one are enough.
    first = features.filter("n_shingles > 0").groupBy("set", "n_shingles").agg(F.min(F.struct("doc_id", "row_a")).alias("first"))
    first = ws.save(first.select("set", "n_shingles", F.col("first.row_a").alias("row_a")), "classes")
    listed = docs.sparkSession.sparkContext.broadcast(bitmap(first, "row_a"))
    run = _of_listed(similarity, listed, "keys", pa.list_(pa.int64()), _all_keys(similarity))
    # The keys are needed once, and dropped with their folder then.
    with Workspace(docs.sparkSession) as keys:
        with text_batches(ws.spark):
            found = keys.save(docs.select("text", "row_a").mapInArrow(run, "set long, keys array<long>"), "keys")
        shared = _shared_parts(found, ws)
    labels = _Join(similarity, first, shared, docs, ws).run().withColumnRenamed("node", "set")
    rows = features.select("doc_id", "row_a", "row_b", "n_shingles", "set")
    classes = rows.filter("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    classes = classes.join(labels, "set", "left").withColumn("component", F.coalesce("component", "set"))
    classes = ws.save(classes, "labelled-classes")
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("copies"))
    named = ws.save(named, "named-components")
    named = ws.save(classes.select("set", "component").join(named, "component").select("set", "component", "component_id", "copies"), "components")
    # Most classes have one row; only the others are joined back.
    named = named.filter("copies > 1")
    worded = rows.filter("n_shingles > 0").join(named, "set", "left")
    bare = rows.filter("n_shingles = 0").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id"), "copies": F.lit(1).cast("long")})
    out = worded.unionByName(bare.select(*worded.columns))
    return out.select(
        "doc_id", "row_a", "row_b", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        "component", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
    )


def without_near_duplicates(docs: DataFrame, ws: Workspace, similarity: Similarity) -> DataFrame:
    """One row of each component, the first by (id, content); all columns as they are.

    Of rows with equal id and text one stays, whatever their other columns.
    """
    every = ws.save(near_duplicates(identified(docs), ws, similarity).select("component", "doc_id", *ROW_KEY, "copies"), "every-row")
    place = F.struct("doc_id", *ROW_KEY)
    rows = every.filter("copies > 1").groupBy("component", "doc_id", *ROW_KEY).agg(F.count(F.lit(1)).alias("rows"))
    rows = ws.save(rows, "repeated-rows")
    first = ws.save(rows.groupBy("component").agg(F.min(place).alias("first")), "first-rows")
    rows = rows.join(first, "component").withColumn("stays", (F.col("first.row_a") == F.col("row_a")) & (F.col("first.row_b") == F.col("row_b")))
    rows = ws.save(rows.select(*ROW_KEY, "stays", "rows"), "decided")
    # Rows whose bit is not set stay where they are. Of the others only those move that have the bit of a row to keep.
    listed = rows.filter("not stays or rows > 1")
    passes_first = passes(docs, bitmap(listed, "row_a"))
    kept = every.filter("copies = 1").select(*ROW_KEY).union(rows.filter("stays").select(*ROW_KEY))
    passes_second = passes(docs, bitmap(kept.filter(passes_first("row_a")), "row_b"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[k.alias(c) for c, k in zip(ROW_KEY, row_key(F.col("doc_id").cast("long"), F.col("text")), strict=True)],
    )
    moved = keyed.filter(passes_first("row_a")).filter(passes_second("row_b"))
    alone = moved.join(listed.select(*ROW_KEY), ROW_KEY, "left_anti")
    # Rows that are equal in id and text: hardly any, and reduced before they move.
    equal = moved.join(rows.filter("stays and rows > 1").select(*ROW_KEY), ROW_KEY, "left_semi").dropDuplicates(ROW_KEY)
    out = keyed.filter(~passes_first("row_a")).unionByName(alone).unionByName(equal)
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns])
