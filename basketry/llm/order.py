"""Positions and running sums in a total order, without a window over all rows.

Rows are dealt by range, so each task holds a stretch of the order, numbers it in one pass, and adds what
lies in earlier tasks from a table of one row per task. Equal rows are told apart by their place in the
input, so a value that very many rows share spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.rows import plain
from basketry.workspace import Workspace


def _numbered(sums: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at, so_far = TaskContext.get().partitionId(), 0, [0] * len(sums)
        for b in batches:
            n = b.num_rows
            columns = [plain(c) for c in b.columns]
            before = []
            for i, c in enumerate(sums):
                value = columns[c].to_numpy(zero_copy_only=False)
                upto = so_far[i] + np.cumsum(value)
                before.append(pa.array(upto - value))
                so_far[i] = int(upto[-1]) if n else so_far[i]
            place = [pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at, at + n))]
            names = [*b.schema.names, "_task", "_at", *(f"_before_{i}" for i in range(len(sums)))]
            yield pa.RecordBatch.from_arrays([*columns, *place, *before], names=names)
            at += n

    return run


def in_order(rows: DataFrame, order: list[Column], sums: list[str], ws: Workspace, name: str) -> DataFrame:
    """``rows`` with ``position`` from 0 and ``<column>_before`` for each column of ``sums`` (longs, not null).

    The result is written to the workspace. Rows that ``order`` does not tell apart follow the input.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["_task int", "_at long"] + [f"_before_{i} long" for i in range(len(sums))])
    saved = ws.save(dealt.mapInArrow(_numbered([rows.columns.index(c) for c in sums]), schema), f"{name}-stretches")
    tasks = saved.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{i}") for i, c in enumerate(sums)])
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    start = {"_rows": "_start", **{f"_sum_{i}": f"_start_{i}" for i in range(len(sums))}}
    tasks = tasks.select("_task", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(a) for c, a in start.items()])
    placed = saved.join(tasks, "_task")
    return placed.select(
        *rows.columns,
        (F.col("_start") + F.col("_at")).alias("position"),
        *[(F.col(f"_start_{i}") + F.col(f"_before_{i}")).alias(f"{c}_before") for i, c in enumerate(sums)],
    )
