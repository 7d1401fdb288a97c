"""Change-feed apply (T2, C12): change rows -> current-state table.

A change row carries the key, the row image, an operation (I/U/D) and an
ordering (e.g. commit time, sequence).  The current state keeps, per key, the
row with the greatest ordering; a delete there removes the key.

``latest_per_key`` is a ``max_by`` aggregate over a struct of the ordering
columns: Spark aggregates it partially on the map side, so a key that holds a
third of all change rows collapses to one row per task before the shuffle
(a ROW_NUMBER window would sort the whole hot key in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from ..sources.versions import BucketTable


def latest_per_key(changes: DataFrame, key: list, order: list) -> DataFrame:
    """Latest change row per key (tombstones kept)."""
    payload = [c for c in changes.columns if c not in key]
    agg = changes.groupBy(*key).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("_latest"))
    return agg.select(*key, *[F.col(f"_latest.{c}").alias(c) for c in payload])


def current_state(changes: DataFrame, key: list, order: list, op_col: str = "op",
                  delete_value: str = "D", keep_op: bool = False) -> DataFrame:
    """Current rows: latest image per key unless that latest change is a delete."""
    latest = latest_per_key(changes, key, order)
    out = latest.where(~F.col(op_col).eqNullSafe(F.lit(delete_value)))  # a change without op is no delete
    return out if keep_op else out.drop(op_col)


def merge_changes(snapshot: DataFrame | None, batch: DataFrame, key: list, order: list) -> DataFrame:
    """New snapshot (tombstones kept) from the previous one and a batch of changes.

    Idempotent: merging a batch twice yields the same snapshot, and out-of-order
    batches cannot resurrect a deleted key or roll a row back.
    """
    combined = batch if snapshot is None else snapshot.unionByName(batch)
    return latest_per_key(combined, key, order)


class SnapshotStore:
    """Current state (tombstones kept) as a versioned table cut into key buckets.

    A batch is reduced to its latest change per key, merged with the buckets
    its keys fall in, and those buckets are written once, one file each, as a
    new version.  Work per batch is O(batch + touched buckets), not O(state);
    size ``buckets`` so one bucket is a few hundred MB at the expected state
    size.

    Readers see whole versions: a frame opened before or during ``apply``
    keeps the state it was opened on (``keep`` versions stay).  A batch that
    fails before its version is published leaves the state as it was.  Merging
    is idempotent (taking the latest of rows that already include the batch
    changes nothing), so a batch may be applied again.
    """

    def __init__(self, spark, root: str | None = None, name: str = "cdc", buckets: int = 64, keep: int = 2):
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark)}/{name}").rstrip("/")
        self.buckets, self.keep = buckets, keep

    def table(self, key: list | None = None) -> BucketTable:
        return BucketTable(self.spark, self.root, key or [], self.buckets, self.keep)

    def latest(self, version: int | None = None) -> DataFrame | None:
        return self.table().read(version)

    def apply(self, batch: DataFrame, batch_id: int, key: list, order: list) -> None:
        table = self.table(key)
        batch = latest_per_key(batch, key, order).persist()
        try:
            touched = table.touched(batch)
            if not touched and table.manifest()["schema"] is not None:
                return
            state = table.read(buckets=touched)
            merged = batch if state is None else latest_per_key(state.unionByName(batch), key, order)
            table.replace(merged, touched, {"batch": int(batch_id)})
        finally:
            batch.unpersist()


def buckets_for(state_bytes: int, target_bytes: int = 256 << 20, minimum: int = 4,
                maximum: int = 65_536) -> int:
    """Bucket count keeping one state bucket near ``target_bytes``."""
    return max(minimum, min(maximum, -(-state_bytes // target_bytes)))


def latest_topn(state: DataFrame, by: str, n: int, tiebreak: str) -> DataFrame:
    """The ``n`` most recent rows by ``by`` (total order via ``tiebreak``)."""
    return state.orderBy(F.desc(by), F.desc(tiebreak)).limit(n)
