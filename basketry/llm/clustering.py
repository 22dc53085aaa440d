"""Centroid clustering in whole numbers, with Orchard's search for the nearest centroid.

Every centroid has the list of the others by rising distance from it. A vector starts at the first centroid and goes
along that one's list; where it meets a closer centroid it goes on with the list of that, centroids it has met are
marked, and it stops where the list's next is strictly further away than twice the present distance: by the triangle
inequality nothing closer follows, and nothing equally close with a smaller number. All distances are squared and
exact, so ties are real ties. A round sends a row per task, cluster and dimension; the centroids, clusters times
dimensions whole numbers, are all that reaches the driver.

Cases: rows whose vector is null, of another length, or holds null or non-finite entries are left out. With fewer
vectors than clusters every vector starts one. A null id stays null, and starts a cluster only after all others; equal
ids follow their vectors. Equal rows are all returned. A distance or sum beyond a long is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.rows import batch
from basketry.llm.vectors import DIGITS, as_long, digits, longs, matrices, of_length, squares, whole_vectors
from basketry.workspace import Workspace

SCALE = 64.0
LENGTH = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1

ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("exact", pa.decimal128(38, 0))])


class Orchard:
    """Centroids with each one's list of the others, nearest first."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        number = len(centroids)
        apart = [squares(centroids - c) for c in centroids]
        self.lists = np.array([sorted((i for i in range(number) if i != c), key=lambda i: (d[i], i)) for c, d in enumerate(apart)], np.int64).reshape(number, number - 1)
        self.apart = [[int(d[i]) for i in self.lists[c]] for c, d in enumerate(apart)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each row, all rows one step at a time."""
        number, rows = len(self.centroids), len(x)
        at = np.zeros(rows, np.int64)
        best = squares(x - self.centroids[0])
        wide = best.dtype == object or any(d > (1 << 62) for own in self.apart for d in own)
        apart = np.array(self.apart, object if wide else np.int64).reshape(number, number - 1)
        met = np.zeros((rows, number), bool)
        met[:, 0] = True
        place, going = np.zeros(rows, np.int64), np.arange(rows if number > 1 else 0)
        while len(going):
            own, spot = at[going], place[going]
            # Strictly further than twice the distance: four times when squared, and halves avoid overflow.
            on = ~(apart[own, spot] // 4 > best[going]) & ~((apart[own, spot] // 4 == best[going]) & (apart[own, spot] % 4 > 0))
            going, own, spot = going[on], own[on], spot[on]
            other = self.lists[own, spot]
            place[going] += 1
            new = ~met[going, other]
            row, to = going[new], other[new]
            if len(row):
                met[row, to] = True
                d = squares(x[row] - self.centroids[to])
                if d.dtype == object and best.dtype != object:
                    best = best.astype(object)
                closer = (d < best[row]) | ((d == best[row]) & (to < at[row]))
                jump = row[closer]
                at[jump], best[jump], place[jump] = to[closer], d[closer], 0
            going = going[place[going] < number - 1]
        return at, best


def kept_vectors(embeddings: DataFrame, ws: Workspace, length: int = LENGTH, scale: float = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that count, as a written table."""
    vectors = whole_vectors(embeddings, scale)
    return ws.save(vectors.filter(of_length(vectors, length)), "vectors")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """Vectors of the ``clusters`` smallest hashes of ``<seed>:<vec_id>``, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(draw.alias("draw"), "x").orderBy(F.asc_nulls_last("draw"), "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, i, n, total): rows and sums per dimension of the vectors nearest to each centroid."""
    number, length = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n, total = Orchard(centroids), np.zeros(number, np.int64), np.zeros((number, length), object)
        for b in batches:
            for _, x in matrices(b, length):
                at, _ = search.nearest(x)
                for c in np.unique(at):
                    n[c], total[c] = n[c] + (at == c).sum(), total[c] + x[at == c].sum(axis=0, dtype=object)
        own = np.flatnonzero(n)
        where = np.repeat(own, length)
        columns = [pa.array(where, pa.int32()), pa.array(np.tile(np.arange(length), len(own)), pa.int32()), pa.array(n[where], pa.int64()), digits(list(total[own].ravel()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "i", "n", "total"])

    parts = vectors.select("x").mapInArrow(run, f"cluster int, i int, n long, total {DIGITS}")
    return parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centroids at the floor of the mean of their vectors; those without any stay."""
    out = centroids.copy()
    for r in sums.collect():  # clusters times dimensions
        out[r["cluster"], r["i"]] = int(r["total"]) // r["n"]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, exact): the nearest centroid of each vector; ``exact`` holds any distance."""
    length = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for b in batches:
            for first, x in matrices(b, length):
                at, best = search.nearest(x)
                exact = digits(list(best)) if best.dtype == object else pa.array(best, pa.int64()).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
                yield batch(ASSIGNED, {"vec_id": b.column(0).slice(first, len(x)), "cluster": at, "distance": longs(best), "exact": exact})

    return vectors.mapInArrow(run, f"vec_id long, cluster int, distance long, exact {DIGITS}")


def clustered(embeddings: DataFrame, ws: Workspace, clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector after the last round."""
    vectors = kept_vectors(embeddings, ws, length)
    centroids = first_centroids(vectors, clusters)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(vectors, centroids))
    rows = ws.save(assigned(vectors, centroids), "assigned")
    totals = rows.groupBy("cluster").agg(F.sum("exact").alias("total")).collect()  # a row per cluster
    whole = sum(int(r["total"]) for r in totals)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = vectors.sparkSession.createDataFrame([(r["cluster"], r["total"], names[r["cluster"]]) for r in totals], f"cluster int, total {DIGITS}, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", as_long(F.col("total")).alias("cluster_inertia"),
        as_long(F.lit(str(whole)).cast(DIGITS)).alias("inertia"), "centroid_sha256",
    )
