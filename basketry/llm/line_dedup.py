"""Line dedup: repeated runs of lines across and inside documents, by winnowing over line hashes.

A window is the shortest run of lines, from a line on or up to a line, that has ``LEAST`` words. Its
smallest line hash is its fingerprint, so a repeated run of ``LEAST`` words or more has the same windows
and the same fingerprints wherever it stands: no such run is missed. Fingerprints that occur once end
there. For the others, windows are joined by content with their first occurrence in corpus order, by
id, then line; windows from each line on extend a match to the left, those up to each line to the right.
A line goes if it lies in a window whose first occurrence is in an earlier document, or in the same one
and ends before. First occurrences stay whole.

A window meets its first occurrence only, never all others, and counts are pre-aggregated, so a passage in
a third of all documents costs a row per occurrence. Fingerprints first pass a bitmap of fixed size.

Cases: lines without words are kept and skipped in runs; null texts stay null, empty ones empty; rows
with equal id and text are one document and get equal results; null ids come first; an empty table gives
no rows; other columns are ignored. Lines are compared by 64-bit and windows by 64-bit hashes of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.bits import bitmap, passes, present
from basketry.llm.rows import ROW_KEY, batch, identified, plain
from basketry.llm.words import _POWERS, mix
from basketry.workspace import Workspace

LEAST = 50


def _lines(text: str) -> list[tuple[int, int, int]]:
    """(number, words, hash) of each line with a word."""
    out = []
    for i, line in enumerate(text.encode().split(b"\n")):
        if words := len(line.split()):
            out.append((i, words, xxhash.xxh3_64_intdigest(line)))
    return out


def _line_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = pa.schema([("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("line", pa.list_(pa.int32())), ("words", pa.list_(pa.int32())), ("hash", pa.list_(pa.int64()))])
    for b in batches:
        rows = [_lines(t.as_py() or "") for t in plain(b.column(1))]
        columns = [[[x[k] for x in row] for row in rows] for k in range(2)]
        hashes = [np.array([x[2] for x in row], np.uint64).view(np.int64) for row in rows]
        yield batch(fields, dict(zip(fields.names, [*[b.column(c) for c in (0, 2, 3)], *columns, hashes], strict=True)))


def windows(words: np.ndarray, hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, content hash, fingerprint) of each distinct window, both ways."""
    upto = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    last = np.searchsorted(upto, upto[:-1] + least) - 1  # from each line on
    first = np.searchsorted(upto, upto[1:] - least, "right") - 1  # up to each line
    on, back = last < n, first >= 0
    pairs = np.unique(np.concatenate([np.stack([np.flatnonzero(on), last[on]], 1), np.stack([first[back], np.flatnonzero(back)], 1)]), axis=0)
    if not len(pairs):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    i, j = pairs[:, 0], pairs[:, 1]
    _POWERS.grow(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes) * _POWERS.up[:n])))
    content = mix((sums[j + 1] - sums[i]) * _POWERS.down[i] + (j - i + 1).astype(np.uint64))
    padded = np.concatenate((hashes, np.full(1, np.iinfo(np.uint64).max, np.uint64)))
    fingerprint = np.minimum.reduceat(padded, np.stack([i, j + 1], 1).ravel())[::2]
    return i, j, content, mix(fingerprint)


def _own(b: pa.RecordBatch, row: int, least: int) -> tuple[np.ndarray, ...]:
    words = b.column(4)[row].values.to_numpy(zero_copy_only=False)
    hashes = b.column(5)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
    return windows(words.astype(np.int64), hashes, least)


def _fingerprints(least: int) -> Callable:
    """One fingerprint for each place where one is selected."""
    fields = pa.schema([("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chosen = []
            for row in range(b.num_rows):
                i, j, _, fp = _own(b, row, least)
                if len(fp):
                    # The place of the minimum: equal neighbours select the same line once.
                    hashes = b.column(5)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    places = np.array([x + int(np.argmin(hashes[x : y + 1])) for x, y in zip(i.tolist(), j.tolist(), strict=True)])
                    chosen.append(mix(hashes[np.unique(places)]))
            if chosen:
                yield batch(fields, {"fp": np.concatenate(chosen).view(np.int64)})

    return run


def _windows(least: int, bits: Broadcast) -> tuple[Callable, str]:
    fields = pa.schema([("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("content", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for row in range(b.num_rows):
                i, j, content, fp = _own(b, row, least)
                known = present(bits.value, fp)
                if known.any():
                    lines = b.column(3)[row].values.to_numpy(zero_copy_only=False)
                    parts.append((lines[i[known]], lines[j[known]], content[known].view(np.int64)))
                    rows.append(np.full(int(known.sum()), row))
            if rows:
                at = pa.array(np.concatenate(rows))
                ids = [plain(b.column(c)).take(at) for c in (0, 1, 2)]
                yield batch(fields, dict(zip(fields.names, [*ids, *map(np.concatenate, zip(*parts, strict=True))], strict=True)))

    return run, "doc_id long, row_a long, row_b long, first int, last int, content long"


def repeated_runs(docs: DataFrame, ws: Workspace, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The line table, and (row key, first, last) of every window that goes; line numbers count from 0."""
    spark = docs.sparkSession
    lines = ws.save(identified(docs).mapInArrow(_line_table, "doc_id long, row_a long, row_b long, line array<int>, words array<int>, hash array<long>"), "lines")
    several = lines.mapInArrow(_fingerprints(least), "fp long").groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bits = spark.sparkContext.broadcast(bitmap(several, "fp"))
    run, schema = _windows(least, bits)
    places = ws.save(lines.mapInArrow(run, schema).distinct(), "windows")
    place = F.struct("doc_id", "row_a", "row_b", "first", "last")
    firsts = places.groupBy("content").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("content", "origin")
    firsts = ws.save(firsts, "first-occurrences")  # written, so that the join's sides are plain and a hot passage is split
    joined = places.join(firsts, "content")
    same = (F.col("origin.row_a") == F.col("row_a")) & (F.col("origin.row_b") == F.col("row_b")) & F.col("origin.doc_id").eqNullSafe(F.col("doc_id"))
    return lines, joined.filter(~same | (F.col("origin.last") < F.col("first"))).select(*ROW_KEY, "first", "last")



def deduplicated(docs: DataFrame, ws: Workspace, least: int = LEAST) -> DataFrame:
    """(doc_id, text, n_lines, removed) of each row: the text without ``removed`` lines, whose numbers count from 0.

    n_lines counts lines with a word; so does ``removed``.
    """
    lines, runs = repeated_runs(docs, ws, least)
    covered = runs.select(*ROW_KEY, F.explode(F.sequence("first", "last")).alias("line")).groupBy(*ROW_KEY)
    # Lines of one document.
    covered = covered.agg(F.collect_set("line").alias("covered"))
    table = lines.select(*ROW_KEY, "line").join(covered, ROW_KEY).dropDuplicates(ROW_KEY)
    table = ws.save(table.select(*ROW_KEY, F.array_sort(F.array_intersect("line", "covered")).alias("removed")), "removed")
    # Only texts that may lose lines move: a bitmap tells them, and those that it confuses with them meet no removals.
    # Removals of a corpus have no bound to broadcast by.
    table = table.filter(F.size("removed") > 0)
    may_lose = passes(docs, bitmap(table, "row_a"))
    none = F.array().cast("array<int>")
    moved = identified(docs).filter(may_lose("row_a")).join(table.hint("merge"), ROW_KEY, "left").withColumn("removed", F.coalesce("removed", none))
    rows = identified(docs).filter(~may_lose("row_a")).withColumn("removed", none).unionByName(moved)
    # Numbers of the lines that stay, then the lines; the lines are bound once.
    stay = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    kept = F.transform(F.array(F.split("text", "\n")), lambda lines: F.array_join(F.transform(stay(lines), lambda i: F.get(lines, i)), "\n"))
    text = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.get(kept, F.lit(0)))
    worded = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    return rows.select("doc_id", text.alias("text"), worded.cast("long").alias("n_lines"), "removed")
