"""Continuous file ingest (T1, S8) and change-feed apply.

File ingest: a file stream over the landing folder (suffix filter) with a
checkpoint, so each file is ingested exactly once however often the job
restarts.  Each micro-batch is appended to a RAW table whose schema is a
committed log (``sources/raw_table.py``): new fields become columns without
loss of digits, type changes are refused, and neither the history nor the file
names of a batch are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc
from ..sources.raw_table import RawTable
from .refresh import run_available_now


class EvolvingFileIngest:
    """foreachBatch handler: NDJSON lines -> RAW table with a schema log."""

    def __init__(self, raw_path: str, base_schema: T.StructType, source: str = "default"):
        self.raw_path, self.base_schema, self.source = raw_path, base_schema, source

    def table(self, spark: SparkSession) -> RawTable:
        return RawTable(spark, self.raw_path, self.base_schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                self.table(batch.sparkSession).append(batch, self.source, batch_id)
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table(spark).read()


def file_stream(spark: SparkSession, landing: str, glob: str = "*.json*",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing).select("value", F.col("_metadata.file_path").alias("_source_file"))


def ingest_files(spark: SparkSession, landing: str, raw_path: str, checkpoint: str,
                 base_schema: T.StructType, glob: str = "*.json*", source: str | None = None
                 ) -> EvolvingFileIngest:
    """One stream per landing folder; ``source`` names it in the RAW partitions
    (batch ids restart per stream checkpoint)."""
    handler = EvolvingFileIngest(raw_path, base_schema, source or landing.rstrip("/").rsplit("/", 1)[-1])
    run_available_now(file_stream(spark, landing, glob), handler, checkpoint)
    return handler


class ChangeFeedApply:
    """foreachBatch handler merging change rows into a versioned snapshot."""

    def __init__(self, store: cdc.SnapshotStore, key: list, order: list):
        self.store, self.key, self.order = store, key, order

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store.apply(batch, batch_id, self.key, self.order)

    def current(self, op_col: str = "op", delete_value: str = "D") -> DataFrame | None:
        snap = self.store.latest()
        if snap is None:
            return None
        return snap.where(~F.col(op_col).eqNullSafe(F.lit(delete_value))).drop(op_col)


def apply_change_stream(spark: SparkSession, landing: str, schema: T.StructType, store: cdc.SnapshotStore,
                        key: list, order: list, checkpoint: str, max_files: int | None = None) -> ChangeFeedApply:
    """``max_files`` bounds a micro-batch if given; otherwise a batch takes the whole backlog."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(landing)
    handler = ChangeFeedApply(store, key, order)
    run_available_now(stream, handler, checkpoint)
    return handler
