"""Clustering by exact nearest centroids, found by equal-average equal-variance search.

Vectors are whole numbers.  Centroids lie sorted by the sum of their components
(``length`` times the mean).  A vector starts at the centroid whose sum is next
to its own and walks outward, always to the nearer side.  With ``S`` the sum and
``V`` the deviation (root of the summed squares around the mean),

    |x - c|^2 >= (S_x - S_c)^2 / length + (V_x - V_c)^2,

so the walk ends once the first term alone exceeds the best distance (the mean
inequality; all centroids further out exceed it too), and a centroid whose two
terms exceed it is passed over (the deviation inequality).  The others get their
exact distance in whole numbers.  The first test is in whole numbers; the second
is in floating point with a margin above its rounding, so no centroid is passed
over wrongly and ties are always settled by the smaller number.

A round is one scan: each task assigns its rows and returns one sum per
centroid, which Spark adds up.  Only centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .vectors import by_length, quantised, whole

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
LENGTH = 64
_FAR = np.iinfo(np.int64).max


class Centroids:
    """A sorted table of centroids that answers nearest-centroid searches."""

    def __init__(self, table: np.ndarray):
        self.k, self.length = table.shape
        total = table.sum(axis=1)
        order = np.argsort(total, kind="stable")
        self.number, self.table, self.sums = order, table[order], total[order]
        self.deviation = self._deviation(self.table, self.sums)
        self.exact = 0  # exact distances computed so far, for tests and figures

    def _deviation(self, x: np.ndarray, sums: np.ndarray) -> np.ndarray:
        n = max(self.length, 1)
        if int(np.abs(x).max(initial=0)) ** 2 * 8 * n * n >= 1 << 62:
            raise OverflowError("squared distances of these vectors overflow a long")
        return np.sqrt((n * np.einsum("ij,ij->i", x, x) - sums * sums) / n)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number, squared distance)`` of the nearest centroid of each row."""
        n, k = len(x), self.k
        sums = x.sum(axis=1)
        deviation = self._deviation(x, sums)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        best, who = np.full(n, _FAR), np.full(n, k)
        live = np.arange(n)
        while len(live):
            u, d = up[live], down[live]
            above = np.where(u < k, self.sums[np.minimum(u, k - 1)] - sums[live], _FAR)
            below = np.where(d >= 0, sums[live] - self.sums[np.maximum(d, 0)], _FAR)
            gap = np.minimum(above, below)
            on = gap < _FAR
            # the mean inequality, in whole numbers; before the first distance it holds for none
            far = np.where(on, gap, 0) ** 2 > np.minimum(best[live], _FAR // max(self.length, 1)) * self.length
            on &= ~far
            live, gap, rising = live[on], gap[on], (above <= below)[on]
            at = np.where(rising, up[live], down[live])
            up[live] += rising
            down[live] -= ~rising
            first = gap.astype(np.float64) ** 2 / max(self.length, 1)
            bound = first + (deviation[live] - self.deviation[at]) ** 2
            margin = 1e-6 + 1e-9 * (first + deviation[live] ** 2 + self.deviation[at] ** 2)
            close = bound - margin <= best[live]
            rows, at = live[close], at[close]
            self.exact += len(rows)
            diff = x[rows] - self.table[at]
            dist, number = np.einsum("ij,ij->i", diff, diff), self.number[at]
            win = (dist < best[rows]) | ((dist == best[rows]) & (number < who[rows]))
            best[rows[win]], who[rows[win]] = dist[win], number[win]
        return who, best


def _sums(table: np.ndarray, scale: int):
    """A task: the sum and the count of its rows for each centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(table)
        total, count = np.zeros_like(table), np.zeros(len(table), np.int64)
        for batch in batches:
            for _, q in by_length(batch.column(0), scale, table.shape[1]):
                who, _ = search.nearest(q)
                order = np.argsort(who, kind="stable")
                groups, head = np.unique(who[order], return_index=True)
                total[groups] += np.add.reduceat(q[order], head, axis=0)
                count += np.bincount(who, minlength=len(table))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(list(total[some]), pa.list_(pa.int64())),
             pa.array(count[some], pa.int64())], names=["cluster", "total", "n"])
    return run


def _assigned(table: np.ndarray, scale: int):
    """A task: number and distance of the nearest centroid of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(table)
        for batch in batches:
            for rows, q in by_length(batch.column(1), scale, table.shape[1]):
                who, dist = search.nearest(q)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(who, pa.int32()), pa.array(dist, pa.int64())],
                    names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(embeddings: DataFrame, clusters: int = CLUSTERS, seed: int = 1, scale: int = SCALE,
                    length: int = LENGTH) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order (NULL ids last)."""
    kept = embeddings.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("v"))
    kept = kept.where(whole("v") & (F.size("v") == length))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "v").limit(clusters).collect()
    return quantised(np.array([r["v"] for r in rows], np.float64).reshape(len(rows), length), scale)


def next_centroids(embeddings: DataFrame, table: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Each centroid replaced by the floor of its rows' componentwise mean; empty ones stay."""
    sums = embeddings.select("embedding").mapInArrow(_sums(table, scale), "cluster int, total array<long>, n long")
    parts = sums.select("cluster", "n", F.posexplode("total").alias("place", "part"))
    out = table.copy()
    # one row per centroid and component
    for r in parts.groupBy("cluster", "place").agg(F.sum("part").alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["place"]] = r["total"] // r["n"]
    return out


def cluster_vectors(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1,
                    scale: int = SCALE, length: int = LENGTH) -> DataFrame:
    """One row per vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors that are NULL, of another length, or hold NULL or non-finite
    components take no part.  Rows that repeat, or share an id, count each; rows
    with a NULL id are assigned like others but start no centroid while others
    can.  Equal distances go to the smaller number.  With fewer vectors than
    ``clusters`` there are as many centroids as vectors; without any the result
    is empty.  Other columns are not read.  Vectors whose squared distances
    overflow a long are an error.
    """
    table = first_centroids(embeddings, clusters, seed, scale, length)
    ids = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    if len(table):
        for _ in range(rounds):
            table = next_centroids(ids, table, scale)
        found = ids.mapInArrow(_assigned(table, scale), "vec_id long, cluster int, distance long")
    else:
        found = ids.where(F.lit(False)).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    found = materialize(found, "centroid-distances")
    inside = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = [(j, s, sum(inside.values()), hashlib.sha256(",".join(map(str, table[j].tolist())).encode()).hexdigest())
             for j, s in inside.items()]
    each = embeddings.sparkSession.createDataFrame(
        named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(each), "cluster")  # one row per centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
