"""Mining a small conditional database inside one task: bit arrays or an FP-tree.

A node's state rows are the tails behind one item of the node: ``weight`` orders each, sorted from the country's rarest
item to its most frequent. What follows from them needs no other rows, so once a node and item have at most
``MiningParams.local_rows`` orders, one task takes them all and finds every frequent itemset below at once; the levels
(``operators.mining``) are left to larger ones. All nodes of all countries are dealt out by (node, item) in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Found = Iterator[tuple[tuple[int, ...], int]]
Miner = Callable[[np.ndarray, np.ndarray, np.ndarray, int, int], Found]

BATCH = 1 << 14  # itemsets per batch that a task sends on
NO_LIMIT = 1 << 30


def by_bit_arrays(flat: np.ndarray, lengths: np.ndarray, weights: np.ndarray, least: int, most: int) -> Found:
    """Frequent sets of up to ``most`` items of the tails, depth first; an item is an array of a bit per tail.

    An extension is counted by AND and a count of bits. Words that lose all bits are dropped on the way down. Weights other
    than 1 are counted by their binary digits, each an array of bits, too.
    """
    rows = np.repeat(np.arange(len(lengths)), lengths)
    items, at = np.unique(flat, return_inverse=True)
    counts = np.bincount(at, weights=weights[rows], minlength=len(items)).astype(np.int64)
    good = np.flatnonzero(counts >= least)
    place = np.full(len(items), -1)
    place[good] = np.arange(len(good))
    kept = place[at] >= 0
    words = (len(lengths) + 63) // 64
    bits = np.zeros(len(good) * words, np.uint64)
    np.add.at(bits, place[at[kept]] * words + rows[kept] // 64, np.uint64(1) << (rows[kept] % 64).astype(np.uint64))
    digits = [_bits(weights >> d & 1) for d in range(int(weights.max(initial=0)).bit_length())] if weights.max(initial=0) > 1 else []
    stack = [((), items[good], counts[good], bits.reshape(len(good), words), np.array(digits, np.uint64).reshape(len(digits), words))]
    while stack:
        prefix, items, counts, bits, digits = stack.pop()
        for i, (item, n) in enumerate(zip(items.tolist(), counts.tolist(), strict=True)):
            own = (*prefix, item)
            yield own, n
            if len(own) < most and i + 1 < len(items):
                some = np.flatnonzero(bits[i])
                longer = bits[i + 1 :, some] & bits[i, some]
                held = digits[:, some]
                n_longer = sum(np.bitwise_count(longer & d).sum(1, dtype=np.int64) << k for k, d in enumerate(held)) if len(held) else np.bitwise_count(longer).sum(1, dtype=np.int64)
                on = n_longer >= least
                if on.any():
                    stack.append((own, items[i + 1 :][on], n_longer[on], longer[on], held))


def _bits(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(flags) + 63) // 64 * 64, np.uint8)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view(np.uint64)


def by_tree(flat: np.ndarray, lengths: np.ndarray, weights: np.ndarray, least: int, most: int) -> Found:
    """The same sets from an FP-tree: tails that begin alike, from the most frequent item on, share a path."""
    ends = np.cumsum(lengths)
    bases = [((), [(flat[e - k : e][::-1].tolist(), w) for e, k, w in zip(ends.tolist(), lengths.tolist(), weights.tolist(), strict=True)])]
    while bases:
        prefix, paths = bases.pop()
        counts: dict[int, int] = {}
        for path, w in paths:
            for item in path:
                counts[item] = counts.get(item, 0) + w
        frequent = {item for item, n in counts.items() if n >= least}
        # A vertex is [item, weight, parent]; children are found by (parent's place, item).
        tree: list[list[int]] = [[-1, 0, -1]]
        children: dict[tuple[int, int], int] = {}
        for path, w in paths:
            at = 0
            for item in path:
                if item in frequent:
                    at = children.get((at, item)) or _grown(tree, children, at, item)
                    tree[at][1] += w
        above: dict[int, list[int]] = {}
        for at in range(1, len(tree)):
            above.setdefault(tree[at][0], []).append(at)
        for item in frequent:
            own = (*prefix, item)
            yield own, counts[item]
            if len(own) < most:
                base = [(path, tree[at][1]) for at in above[item] if (path := _path(tree, at))]
                if base:
                    bases.append((own, base))


def _grown(tree: list[list[int]], children: dict[tuple[int, int], int], at: int, item: int) -> int:
    children[at, item] = len(tree)
    tree.append([item, 0, at])
    return len(tree) - 1


def _path(tree: list[list[int]], at: int) -> list[int]:
    """Items above a vertex, from the root down."""
    out = []
    while (at := tree[at][2]) > 0:
        out.append(tree[at][0])
    return out[::-1]


MINERS: dict[str, Miner] = {"vertical": by_bit_arrays, "fpgrowth": by_tree}


def grown_below(states: DataFrame, miner: Miner, most: int | None) -> DataFrame:
    """(node, item, ids, n): every frequent itemset that adds up to ``most`` items, ``ids``, to a node's item.

    ``states`` are (node, item, tail, weight, least).
    """

    def mined(group: pa.Table) -> Found:
        flat, lengths = flattened(group["tail"])
        return miner(flat, lengths, group["weight"].to_numpy(), group["least"][0].as_py(), NO_LIMIT if most is None else most)

    return one_task_each(states.select("node", "item", "tail", "weight", "least"), mined)


def flattened(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a column of arrays."""
    column = pa.concat_arrays(lists.chunks)
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def one_task_each(states: DataFrame, mined: Callable[[pa.Table], Found]) -> DataFrame:
    """(node, item, ids, n) of what ``mined`` finds in the rows of each (node, item), which start the columns.

    The rows of a group go to one task, which takes its groups in turn and sends on what it finds in batches.
    """
    dealt = states.repartition("node", "item").sortWithinPartitions("node", "item")
    types = pa.schema([("node", pa.int64()), ("item", pa.int32()), ("ids", pa.list_(pa.int32())), ("n", pa.int64())])

    def batch(key: tuple[int, int], ids: list, counts: list[int]) -> pa.RecordBatch:
        columns = [[key[0]] * len(counts), [key[1]] * len(counts), ids, counts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    def found(key: tuple[int, int], group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = [], []
        for own, n in mined(pa.Table.from_batches(group)):
            ids.append(own)
            counts.append(n)
            if len(counts) == BATCH:
                yield batch(key, ids, counts)
                ids, counts = [], []
        if counts:
            yield batch(key, ids, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            keys = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if x == y:
                    continue
                key = tuple(keys[x].tolist())
                if group and key != last:
                    yield from found(last, group)
                    group = []
                group.append(b.slice(x, y - x))
                last = key
        if group:
            yield from found(last, group)

    return dealt.mapInArrow(run, "node long, item int, ids array<int>, n long")
