"""Frequent itemsets of a window that moves by a day, without counting it anew.

Baskets are stored per day. A full count keeps more than is frequent: all sets that reach ``low`` of the least count, with
their counts. When days come and go, those counts change by what the sets have in the days that came and went, and no other
day is read. A set that is not kept had fewer than its country's kept least count, so it can only be frequent if
the days that came since hold at least the rest of the new least count; these days alone are mined for such sets, and
the few that are found are counted once over the whole window and kept from then on. The result is exact.

The kept sets, the days they stand for and the days that came since the full count are one table, replaced in one
step; a run that breaks off is repeated from the day before.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.operators.baskets import with_min_count
from basketry.operators.growth import flattened
from basketry.operators.mining import coded_baskets, grown_itemsets, item_counts
from basketry.params import MiningParams
from basketry.sinks.tables import replace_table
from basketry.sources.tables import read_table, table_exists
from basketry.workspace import Workspace

log = logging.getLogger(__name__)

BLOCK = 1 << 14  # baskets of a country that are counted as one block of bits
CHUNK = 20_000  # sets that meet a block at a time


class MovingItemsets:
    """Itemsets of the stored days below ``root``.

    ``low``: which share of the least count a set needs to be kept. ``rebase``: after how many days that came since the last
    full count the window is counted in full again.
    """

    def __init__(self, spark: SparkSession, root: str, params: MiningParams = MiningParams(), low: float = 0.5, rebase: int = 20) -> None:
        if not 0.0 < low <= 1.0:
            raise ValueError("low must be in (0, 1]")
        self.spark, self.root, self.params, self.low, self.rebase = spark, root.rstrip("/"), params, low, rebase
        self.recounted = 0  # sets that the last call counted over the whole window

    def store(self, day: dt.date, carts: DataFrame) -> None:
        """Keep the baskets (country_id, order_id, items) of a day; a day that is stored again is replaced.

        An order belongs to one day.
        """
        replace_table(carts.select("country_id", "order_id", "items"), self._path(day))

    def baskets(self, days: Sequence[dt.date]) -> DataFrame:
        """The stored baskets of the days; days that were not stored have none."""
        found = [read_table(self.spark, self._path(d)) for d in days if table_exists(self.spark, self._path(d))]
        if not found:
            raise ValueError("no baskets are stored for these days")
        out = found[0]
        for one in found[1:]:
            out = out.unionByName(one)
        return out

    def itemsets(self, days: Sequence[dt.date], workspace: Workspace | None = None) -> DataFrame:
        """(country_id, items, number_of_items, n, n_baskets, support) of the window's ``days``, as ``frequent_itemsets`` has them."""
        ws = workspace or Workspace(self.spark)
        days, self.recounted = sorted(days), 0
        counts = self.baskets(days).groupBy("country_id").agg(F.count("*").alias("n_baskets"))
        totals = ws.save(with_min_count(counts, self.params), "totals")
        known = read_table(self.spark, self._kept) if table_exists(self.spark, self._kept) else None
        state = known.select("days", "entered").first() if known is not None else None
        came = [d for d in days if state and d not in state["days"]]
        entered = sorted({*(state["entered"] if state else []), *came} & {*days})
        if state is None or len(entered) > self.rebase:
            kept, entered = self._counted_in_full(days, totals, ws), []
        else:
            gone = [d for d in state["days"] if d not in days]
            kept = self._moved(known.drop("days", "entered"), came, gone, entered, days, totals, ws)
        of = lambda x: F.lit([d.isoformat() for d in x]).cast("array<date>") if x else F.array().cast("array<date>")
        replace_table(kept.withColumns({"days": of(days), "entered": of(entered)}), self._kept)
        frequent = kept.filter("items is not null").join(totals, "country_id").filter("n >= min_count")
        support = (F.col("n") / F.col("n_baskets")).alias("support")
        return ws.save(frequent.select("country_id", "items", F.size("items").alias("number_of_items"), "n", "n_baskets", support), "window-itemsets")

    def _path(self, day: dt.date) -> str:
        return f"{self.root}/baskets/{day.isoformat()}"

    @property
    def _kept(self) -> str:
        return f"{self.root}/kept"

    def _counted_in_full(self, days: Sequence[dt.date], totals: DataFrame, ws: Workspace) -> DataFrame:
        """(country_id, items, n, least): all sets with ``least`` orders or more, and a row without items per country."""
        least = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("min_count") * self.low))
        kept = ws.save(totals.select("country_id", "n_baskets", least.alias("min_count")), "low-totals")
        sets = _mined(ws.save(self.baskets(days), "window"), kept, self.params, ws)
        sets = sets.join(kept.select("country_id", F.col("min_count").alias("least")), "country_id").select("country_id", "items", "n", "least")
        none = kept.select("country_id", F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n"), F.col("min_count").alias("least"))
        return ws.save(sets.unionByName(none), "kept")

    def _moved(self, known: DataFrame, came: list, gone: list, entered: list, days: list, totals: DataFrame, ws: Workspace) -> DataFrame:
        """The kept sets with the counts of the new window, and those that the new days may have made frequent."""
        for some, sign in ((came, 1), (gone, -1)):
            some = [d for d in some if table_exists(self.spark, self._path(d))]
            if some:
                change = family_counts(self.baskets(some), known.filter("items is not null").select("country_id", "items"), ws)
                change = change.select("country_id", "items", (F.col("n") * sign).alias("change"))
                known = ws.save(known.join(change, ["country_id", "items"], "left").withColumn("n", F.col("n") + F.coalesce("change", F.lit(0))).drop("change"), "moved")
        # A country that was not there has kept nothing, and misses nothing.
        least = known.filter("items is null").select("country_id", "least")
        fresh = totals.join(least, "country_id", "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long")))
        new = fresh.join(least, "country_id", "left_anti").select("country_id", F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n"), "least")
        known = known.unionByName(new)
        some = [d for d in entered if table_exists(self.spark, self._path(d))]
        if some:
            rest = fresh.select("country_id", "n_baskets", "least", F.greatest(F.lit(1).cast("long"), F.col("min_count") - F.col("least") + 1).alias("min_count"))
            rest = ws.save(rest, "rest-totals")
            suspects = _mined(ws.save(self.baskets(some), "entered"), rest.drop("least"), self.params, ws)
            suspects = suspects.join(known.filter("items is not null").select("country_id", "items"), ["country_id", "items"], "left_anti")
            suspects, seen = ws.save_measured(suspects.select("country_id", "items"), "suspects", rows=F.count(F.lit(1)))
            self.recounted = seen["rows"]
            if seen["rows"]:
                found = family_counts(self.baskets(days), suspects, ws).join(rest.select("country_id", "least"), "country_id")
                known = known.unionByName(found.select("country_id", "items", "n", "least"))
        log.info("%d sets were counted over the whole window", self.recounted)
        return ws.save(known, "kept")


def _mined(carts: DataFrame, totals: DataFrame, params: MiningParams, ws: Workspace) -> DataFrame:
    """(country_id, items, n) with at least the country's ``min_count`` of ``totals``."""
    numbered = ws.save(totals.withColumn("child", F.monotonically_increasing_id()), "numbered-totals")
    return grown_itemsets(carts, ws.save(item_counts(carts), "item-counts"), numbered, params, ws)


def family_counts(carts: DataFrame, family: DataFrame, ws: Workspace) -> DataFrame:
    """(country_id, items, n): how many of the baskets hold each set of the family (country_id, items), exactly, in one pass.

    Blocks of baskets become bit arrays, one per item, and a set's orders are the AND of its items' arrays; sets that begin
    alike share the beginning. Blocks meet the sets of their country by a join, in chunks of bounded size.
    """
    family, seen = ws.save_measured(family.withColumn("number", F.monotonically_increasing_id()), "family", rows=F.count(F.lit(1)))
    members = family.select("number", "country_id", F.explode("items").alias("gtin"))
    by_name = Window.partitionBy("country_id").orderBy("gtin")
    items = ws.save(members.select("country_id", "gtin").distinct().withColumn("id", F.row_number().over(by_name)), "family-items")
    sets = members.join(items, ["country_id", "gtin"]).groupBy("number", "country_id").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    chunk = F.pmod(F.xxhash64("number"), F.lit(max(1, -(-seen["rows"] // CHUNK))))
    chunks = sets.groupBy("country_id", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("ids", "number"))).alias("sets"))
    chunks = ws.save(chunks.select("country_id", "sets"), "family-chunks")
    coded, held = ws.save_measured(coded_baskets(carts, items, least=1), "family-baskets", rows=F.count(F.lit(1)))
    block = F.pmod(F.xxhash64("ids"), F.lit(max(1, -(-held["rows"] // BLOCK))))
    blocks = coded.groupBy("country_id", block.alias("block")).agg(F.collect_list(F.struct("ids", "weight")).alias("rows"))
    blocks = ws.save(blocks.select("country_id", F.col("rows.ids").alias("ids"), F.col("rows.weight").alias("weights")), "family-blocks")
    counted = blocks.join(chunks, "country_id").select("ids", "weights", "sets").mapInArrow(_counted, "number long, n long")
    counted = counted.groupBy("number").agg(F.sum("n").alias("n"))
    return ws.save(family.join(counted, "number", "left").select("country_id", "items", F.coalesce("n", F.lit(0).cast("long")).alias("n")), "family-counts")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, n) of the sets of each row in the baskets of the row."""
    for b in batches:
        for row in range(b.num_rows):
            baskets, weights, sets = (b.column(c)[row].values for c in range(3))
            ids, numbers = sets.field("ids"), sets.field("number").to_numpy()
            counts = _counts_in(*flattened(pa.chunked_array([baskets])), weights.to_numpy(), ids.to_pylist())
            some = counts > 0
            yield pa.RecordBatch.from_arrays([pa.array(numbers[some]), pa.array(counts[some])], ["number", "n"])


def _counts_in(flat: np.ndarray, lengths: np.ndarray, weights: np.ndarray, sets: list[list[int]]) -> np.ndarray:
    """Weighted number of baskets that hold each set; ``sets`` are sorted, and so are their items."""
    words = (len(lengths) + 63) // 64
    items, at = np.unique(flat, return_inverse=True)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    bits = np.zeros(len(items) * words, np.uint64)
    np.add.at(bits, at * words + rows // 64, np.uint64(1) << (rows % 64).astype(np.uint64))
    bits = bits.reshape(len(items), words)
    place = {item: i for i, item in enumerate(items.tolist())}
    padded = np.zeros(words * 64, np.int64)
    padded[: len(weights)] = weights
    alike = bool((weights == 1).all())
    out = np.zeros(len(sets), np.int64)
    path: list[tuple[int, np.ndarray | None]] = []  # the items of the last set, and the AND up to each
    for k, own in enumerate(sets):
        shared = 0
        while shared < min(len(path), len(own)) and path[shared][0] == own[shared]:
            shared += 1
        del path[shared:]
        for item in own[shared:]:
            above = path[-1][1] if path else None
            here = bits[place[item]] if item in place and (not path or above is not None) else None
            both = here if here is None or not path else here & above
            path.append((item, both if both is not None and both.any() else None))
        held = path[-1][1]
        if held is not None:
            out[k] = int(np.bitwise_count(held).sum()) if alike else int(padded[np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)].sum())
    return out
