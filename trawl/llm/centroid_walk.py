"""Centroid clustering with the threshold algorithm.

Vectors become integers, floor(scale * x). In every round Spark deals the vectors to tasks; the centroids (k rows) go
to the tasks, and the nearest one is found by the threshold algorithm: for every dimension the
centroids' values are a sorted list, and from the vector's own value the list is walked outward, the nearer
side first. A centroid that comes up in any list gets its exact squared distance at once. The squares of the frontier
distances (the next value of each list) sum up to a bound that no centroid still unseen can go below;
the walk ends as soon as that sum strictly exceeds the best exact distance, so that a tie with an unseen centroid of
smaller number is never missed. All vectors of a batch walk together in numpy.

A task returns one row per cluster: count, componentwise sums and the sum of distances. Spark adds them up, the
driver gets k rows a round and makes the exact floors. Arithmetic is in integers throughout: 64 bits for distances and
a task's sums, decimals and Python integers beyond a task, so the order of rows and tasks has no effect.

A round is a job over the source table that reads it anew; what the driver carries from round to round is k
centroids. A lost executor costs the tasks it ran.

Defined results: vectors that are null, of another length, or that hold a null, an infinite or a NaN
component are left out, and so are components of 2^17 or more, whose squared distances a long cannot hold; null ids
and repeated rows count row by row; with fewer than k vectors there are as many centroids as vectors, with none the
result is empty. Vectors equal in the seed order's hash (repeated ids) are ordered by their components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, ROUNDS, DIMS, SCALE = 8, 10, 64, 1024
SEED = "3:"
LIMIT = 1 << 17  # components must be smaller: 64 * (2 * 2^17 * 1024)^2 is 2^62
BATCH = 2048  # vectors that walk together
_FAR = 1 << 28  # frontier distance of a list read to its end
_MOST = np.iinfo(np.int64).max


def usable(vector: Column, dims: int = DIMS) -> Column:
    """Of ``dims`` components, none null, NaN or as large as ``LIMIT``."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


class SortedLists:
    """The centroids' values per dimension in ascending order, with the numbers of their centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.number = np.argsort(centroids, axis=0, kind="stable").T
        self.value = np.take_along_axis(centroids.T, self.number, axis=1)

    def sides(self, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the next value on either side; ``_FAR`` past the end."""
        k, dim = len(self.centroids), np.arange(x.shape[1])
        below = np.where(left >= 0, x - self.value[dim, np.maximum(left, 0)], _FAR)
        above = np.where(right < k, self.value[dim, np.minimum(right, k - 1)] - x, _FAR)
        return below, above

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) per row of ``x``, and the exact distances taken."""
        (n, dims), k = x.shape, len(self.centroids)
        right = np.empty((n, dims), dtype=np.int64)
        for d in range(dims):
            right[:, d] = np.searchsorted(self.value[d], x[:, d])
        left, dim = right - 1, np.arange(dims)
        best, label = np.full(n, _MOST), np.full(n, k)
        walking, seen, taken = np.arange(n), np.zeros((n, k), dtype=bool), 0
        below, above = self.sides(x, left, right)
        while len(walking):
            up = above < below  # the nearer side of each list comes up
            here = np.where(up, np.minimum(right, k - 1), np.maximum(left, 0))
            fresh = np.zeros((len(walking), k), dtype=bool)
            fresh[np.arange(len(walking))[:, None], self.number[dim, here]] = True
            fresh &= ~seen
            seen |= fresh
            row, c = np.nonzero(fresh)
            taken += len(row)
            exact = np.full((len(walking), k), _MOST)
            exact[row, c] = ((x[row] - self.centroids[c]) ** 2).sum(axis=1)
            which = exact.argmin(axis=1)  # the first of equal ones has the smallest number
            d = exact[np.arange(len(walking)), which]
            old, old_label = best[walking], label[walking]
            better = (d < old) | ((d == old) & (which < old_label))
            best[walking], label[walking] = np.where(better, d, old), np.where(better, which, old_label)
            right, left = right + up, left - ~up
            below, above = self.sides(x, left, right)
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            on = (frontier <= best[walking]) & ~seen.all(axis=1)
            walking, x, left, right, seen = walking[on], x[on], left[on], right[on], seen[on]
            below, above = below[on], above[on]
        return label, best, taken


def integers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, a row per vector."""
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).astype(np.int64).reshape(-1, dims)


def _batches(vectors: pa.Array, dims: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(vectors), BATCH):
        yield i, integers(vectors.slice(i, BATCH), dims, scale)


def seeds(vectors: DataFrame, k: int, scale: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of seed and id, in that order."""
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return [r["v"] for r in vectors.select(key.alias("key"), whole.alias("v")).orderBy("key", "v").limit(k).collect()]


def _totals(vectors: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> list:
    """Per non-empty cluster: (cluster, n, distance, sums), exact Python integers."""
    k = len(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        high, low = np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            for _, x in _batches(b.column(0), dims, scale):
                label, distance, _ = lists.nearest(x)
                order = np.argsort(label, kind="stable")
                has, at = np.unique(label[order], return_index=True)
                n[has] += np.diff(np.append(at, len(label)))
                sums[has] += np.add.reduceat(x[order], at, axis=0)
                high[has] += np.add.reduceat(distance[order] >> 32, at)
                low[has] += np.add.reduceat(distance[order] & 0xFFFFFFFF, at)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has, type=pa.int32()), pa.array(n[has]), pa.array(high[has]), pa.array(low[has]),
             pa.array(list(sums[has]), type=pa.list_(pa.int64()))], ["cluster", "n", "high", "low", "sums"])

    part = vectors.select("v").mapInArrow(assign, "cluster int, n long, high long, low long, sums array<long>")
    wide = "decimal(38,0)"
    adds = [F.sum(F.col("sums")[d].cast(wide)).alias(f"s{d}") for d in range(dims)]
    rows = part.groupBy("cluster").agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("high").cast(wide)).alias("high"),
                                       F.sum(F.col("low").cast(wide)).alias("low"), *adds).collect()  # k rows at most
    return [(r["cluster"], int(r["n"]), (int(r["high"]) << 32) + int(r["low"]), [int(r[f"s{d}"]) for d in range(dims)])
            for r in rows]


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
                    dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) for every usable vector."""
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), dims))
    centroids = np.array(seeds(vectors, k, scale, seed), dtype=np.int64).reshape(-1, dims)
    cost: dict[int, int] = {}
    if len(centroids):
        for _ in range(rounds):
            new = centroids.copy()
            for c, n, _, sums in _totals(vectors, centroids, dims, scale):
                new[c] = [s // n for s in sums]
            centroids = new
        cost = {c: d for c, _, d, _ in _totals(vectors, centroids, dims, scale)}
    inertia = sum(cost.values())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        whole = pa.array(list(centroids), type=pa.list_(pa.int64()))
        for b in batches:
            for i, x in _batches(b.column(1), dims, scale):
                which, distance, _ = lists.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, len(x)), pa.array(which, type=pa.int32()), pa.array(distance),
                     _long([cost[c] for c in which.tolist()]), _long([inertia] * len(x)),
                     whole.take(pa.array(which))],
                    ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"])
    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(label, f"id {id_type}, cluster int, distance long, cluster_inertia long, "
                                     "inertia long, centroid array<long>")


def _long(values: list[int]) -> pa.Array:
    """Longs; a sum beyond them is null."""
    return pa.array([v if v <= _MOST else None for v in values], type=pa.int64())


def centroid_digest(centroid: Column) -> Column:
    """Lowercase hex SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
