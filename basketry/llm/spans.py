"""Spans of a text as (start, kind, end) in code points, kinds by number, and their digest columns."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = tuple[int, int, int]
ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
SQL = "array<struct<start: int, kind: int, end: int>>"
TYPE = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "kind", "end")]))


def as_rows(spans: Iterable[Span]) -> list[dict[str, int]]:
    return [{"start": s, "kind": k, "end": e} for s, k, e in sorted(spans)]


class Covered:
    """Whether a span overlaps one of these, in the logarithm of their number; they may overlap each other."""

    def __init__(self, spans: Iterable[Span]) -> None:
        ordered = sorted(spans)
        self.starts = [s for s, _, _ in ordered]
        self.ends = list(accumulate((e for _, _, e in ordered), max))  # the furthest end so far

    def overlaps(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


class Disjoint:
    """Spans that are taken one by one, each unless it overlaps one that is there."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def take(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        if at and self.ends[at - 1] > start:
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def written(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span, comma-joined; by start, then kind."""
    names = F.array(*[F.lit(k) for k in kinds])
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
