"""Hard negatives: exact whole-number scores by subset-sum tables (Four Russians).

An anchor's components are taken eight at a time; for each group a table holds
the sums of all 256 subsets.  A candidate's components are written as bit
planes in two's complement, and the eight bits of a group on one plane are one
byte.  A plane's part of the inner product is the sum of one table entry per
group, looked up by those bytes; planes are added from the highest down,
doubling in between, and the sign plane counts negatively.  So the sum is the
full product, not an estimate.

Anchors are a stated query set and meet all rows, in blocks: parts of bounded
size are broadcast, and for each part the rows are scanned where they lie.  A
task keeps the best few of each anchor only, so what is shuffled does not
depend on the number of candidates in a task.  The first scan finds the
positives of a part, the second the negatives in each positive's score band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize
from .vectors import by_length, quantised, whole

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90           # per cent of the positive's score
CLASSES = 10
PART_BYTES = 16 << 20        # components of the anchors of one broadcast part
WIDE, ROWS = 64, 2048        # anchors and candidates scored at once
_NONE = np.iinfo(np.int64).max


def subset_sums(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """``(groups, 256, anchors)``: the sums of all subsets of each eight components."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    a = np.zeros((groups * 8, n), kind)
    a[:dim] = anchors.T
    out = np.zeros((groups, 256, n), kind)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + a[j::8][:, None]
    return out


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """``(planes, groups, rows)`` bytes: two's complement bits of each eight components, sign plane last."""
    bits = int(max(rows.max(initial=0), ~rows.min(initial=0))).bit_length() + 1
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.int64)
    wide[:, :rows.shape[1]] = rows
    shifted = (wide[None] >> np.arange(bits)[:, None, None]) & 1
    packed = np.packbits(shifted.astype(np.uint8), axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``(rows, anchors)`` inner products, by lookups, doublings and additions."""
    out = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(out)
    for b in range(len(planes) - 1, -1, -1):
        out += out
        for g in range(len(tables)):
            np.take(tables[g], planes[b, g], axis=0, out=found, mode="clip")
            if b == len(planes) - 1:
                out -= found
            else:
                out += found
    return out


class _Part:
    """Anchors of one broadcast part, grouped by vector length and label."""

    def __init__(self, anchors: list):
        self.groups = {}
        for i, (vec_id, label, v, *_) in enumerate(anchors):
            self.groups.setdefault(len(v), {}).setdefault(label, []).append(i)
        self.ids = np.array([a[0] for a in anchors], np.int64)
        self.largest = max((abs(c) for a in anchors for c in a[2]), default=0)
        self.anchors = anchors

    def blocks(self, batch: pa.RecordBatch, scale: int, same: bool):
        """``(anchors, ids, scores)`` for each block: candidates of the anchors' label, or of all others.

        Candidates are in order of their ids, scores one row per anchor.
        """
        ids = np.asarray(batch.column(0).fill_null(_NONE)).astype(np.int64)
        kinds = batch.column(1)
        known, kinds = np.asarray(kinds.is_valid()), np.asarray(kinds.fill_null(0))
        for rows, q in by_length(batch.column(2), scale):
            keep = known[rows]
            rows, q = rows[keep], q[keep]
            order = np.argsort(ids[rows], kind="stable")
            rows, q = rows[order], q[order]
            most = q.shape[1] * self.largest * int(np.abs(q).max(initial=0))
            if most >= 1 << 55:
                raise OverflowError("inner products of these vectors overflow a long")
            mine = self.groups.get(q.shape[1], {})
            planes, label = bit_planes(q), kinds[rows]
            for kind, members in mine.items():
                pick = np.flatnonzero((label == kind) == same)
                for a in range(0, len(members) if len(pick) else 0, WIDE):
                    some = members[a:a + WIDE]
                    table = subset_sums(np.array([self.anchors[i][2] for i in some], np.int64).reshape(len(some), -1),
                                        np.int32 if most < 1 << 30 else np.int64)
                    for s in range(0, len(pick), ROWS):
                        at = pick[s:s + ROWS]
                        yield some, ids[rows[at]], scores(table, planes[:, :, at]).T.astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, ties by smaller id (``ids`` are in order)."""
    if len(score) > 4 * most:  # all that reach the last score that can count
        at = np.flatnonzero(score >= np.partition(score, len(score) - most)[len(score) - most])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:most]]


class _Kept:
    """The best few of each key over the batches of a task."""

    def __init__(self, most: int):
        self.most, self.found = most, {}

    def add(self, key, score, ids):
        if key in self.found:
            s, i = self.found[key]
            if len(s) == self.most:
                can = score >= s[-1]
                score, ids = score[can], ids[can]
                if not len(score):
                    return
            score, ids = np.concatenate((s, score)), np.concatenate((i, ids))
        if len(score):
            order = _best(score, ids, self.most)
            self.found[key] = score[order], ids[order]

    def columns(self):
        keys = [k for k, (s, _) in self.found.items() for _ in s]
        score = np.concatenate([s for s, _ in self.found.values()] or [np.zeros(0, np.int64)])
        ids = np.concatenate([i for _, i in self.found.values()] or [np.zeros(0, np.int64)])
        return keys, pa.array(ids, pa.int64(), mask=ids == _NONE), pa.array(score, pa.int64())


def _positives(part, scale: int, most: int):
    """A task: the best rows of each anchor's own label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, kept = _Part(part.value), _Kept(most)
        for batch in batches:
            for some, ids, score in mine.blocks(batch, scale, same=True):
                for i, s in zip(some, score):
                    other = ids != mine.ids[i]
                    kept.add(i, s[other], ids[other])
        keys, ids, score = kept.columns()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), ids, score], names=["anchor", "id", "score"])
    return run


def _negatives(part, scale: int, most: int, low: int, high: int):
    """A task: the best of each score band; ``part`` holds ``(vec_id, label, vector, positives)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = part.value
        mine, kept = _Part(anchors), _Kept(most)
        for batch in batches:
            for some, ids, score in mine.blocks(batch, scale, same=False):
                for i, s in zip(some, score):
                    for p in sorted({p for _, p in anchors[i][3]}):
                        inside = np.flatnonzero((s >= -(-low * p // 100)) & (s <= high * p // 100))
                        kept.add((i, p), s[inside], ids[inside])
        keys, ids, score = kept.columns()
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()),
                                          pa.array([k[1] for k in keys], pa.int64()), ids, score],
                                         names=["anchor", "positive_score", "id", "score"])
    return run


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def labelled_vectors(embeddings: DataFrame, moved: int = 7, classes: int = CLASSES) -> DataFrame:
    """``vec_id, label, embedding``: where ``vec_id`` is divisible by ``moved`` the next label counts."""
    i, y = F.col("vec_id").cast("long"), F.col("label").cast("long")
    y = F.when(i % moved == 0, (y + 1) % classes).otherwise(y)
    return embeddings.select(i.alias("vec_id"), y.alias("label"), "embedding").where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull())


OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, "
       "positive_rank int")


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, part_bytes: int = PART_BYTES) -> DataFrame:
    """Hard negatives of each anchor and positive among ``rows`` (``vec_id, label, embedding``).

    Anchors are the rows for which ``anchor`` holds.  An anchor's positives are
    the ``positives`` best rows of its label with another id; its negatives the
    ``negatives`` best rows of other labels whose score is from ``low`` to
    ``high`` per cent of the positive's.  Higher scores come first, ties by
    smaller id, NULL ids last.  Returns ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, positive_rank``.

    Rows with a NULL label, or a vector that is NULL or holds NULL or non-finite
    components, take no part; vectors of different lengths never meet.  Anchors
    equal in id, label and vector ask once; as candidates repeated rows count
    each.  A positive without negatives, an anchor without positives and an
    empty table give no rows.  Products that overflow a long are an error.
    """
    spark = rows.sparkSession
    use = [F.col(c).cast("long").alias(c) for c in ("vec_id", "label")] + [F.col("embedding")]
    asks = rows.where(anchor & whole("embedding") & F.col("label").isNotNull()).select(*use)
    asks = materialize(asks.withColumn("v", F.col("embedding").cast("array<double>")).drop("embedding").distinct(),
                       "negatives-anchors")
    rows = rows.select(*use)
    size = asks.agg(F.sum(8 * F.size("v") + 64)).first()[0] or 0
    parts = max(1, -(-int(size) // part_bytes))
    out = scratch_path(spark, "negatives")
    for p in range(parts):
        held = asks.where(F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(parts)) == p).collect()
        held = [(r[0], r[1], quantised(np.array(r[2], np.float64), scale).tolist()) for r in held]
        task = _positives(spark.sparkContext.broadcast(held), scale, positives)
        best = _first(rows.mapInArrow(task, "anchor int, id long, score long"), ["anchor"], positives)
        near = [[] for _ in held]
        for r in best.orderBy("anchor", "rank").collect():  # at most `positives` rows per anchor of the part
            near[r["anchor"]].append((r["id"], r["score"]))
        full = [(*a, n) for a, n in zip(held, near) if n]
        task = _negatives(spark.sparkContext.broadcast(full), scale, negatives, low, high)
        found = _first(rows.mapInArrow(task, "anchor int, positive_score long, id long, score long"),
                       ["anchor", "positive_score"], negatives)
        pairs = spark.createDataFrame([(i, a[0], pid, s, j + 1) for i, a in enumerate(full)
                                       for j, (pid, s) in enumerate(a[3])],
                                      "anchor int, anchor_id long, positive_id long, positive_score long, positive_rank int")
        found = found.join(F.broadcast(pairs), ["anchor", "positive_score"])  # pairs of one part
        found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                     F.col("score").alias("negative_score"), "positive_rank").write.mode("overwrite").parquet(f"{out}/part={p}")
    return spark.read.schema(OUT).parquet(out).drop("part")


def mined_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives with the rows whose ``vec_id`` is divisible by ``every`` as anchors."""
    return hard_negatives(labelled_vectors(embeddings), F.col("vec_id") % every == 0)
