"""Stable numbers for text identifiers (S1): a distributed dictionary, extended per batch.

Each distinct text gets a long once and keeps it.  Numbers are dense, so they
can be bit positions: a text's hash decides its bucket, a bucket numbers its
texts 0, 1, 2, ... in the order of the batches that bring them (by text within
a batch), and the number is ``place * buckets + bucket``.  No bucket needs to
know another one, so a batch reads and rewrites only the buckets of its new
texts, and no task ranks more than one bucket.  NULL has no number.

The dictionary is a versioned table: a failed or repeated ``extend`` gives no
text a second number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .versions import BucketTable


class IdDictionary:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, keep: int = 2):
        self.table = BucketTable(spark, root, ["id_text"], buckets, keep)

    def extend(self, rows: DataFrame, *columns: str) -> None:
        """Give a number to every text of some columns that has none yet."""
        texts = None
        for c in columns:
            part = rows.select(F.col(c).cast("string").alias("id_text"))
            texts = part if texts is None else texts.unionByName(part)
        new = texts.where(F.col("id_text").isNotNull()).distinct()
        known = self.table.read()
        if known is not None:
            new = new.join(known, "id_text", "left_anti")
        new = new.persist()
        try:
            touched = self.table.touched(new)
            if not touched:
                return
            held = self.table.read(buckets=touched)
            dealt = self.table.with_bucket(new)
            order = Window.partitionBy("_bucket").orderBy("id_text")
            place = F.row_number().over(order) - 1
            if held is not None:
                counts = self.table.with_bucket(held).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_held"))
                dealt = dealt.join(counts, "_bucket", "left")  # one row per bucket
                place = place + F.coalesce("_held", F.lit(0))
            added = dealt.select("id_text", (place.cast("long") * self.table.buckets + F.col("_bucket")).alias("id"))
            self.table.replace(added if held is None else held.unionByName(added), touched)
        finally:
            new.unpersist()

    def encode(self, rows: DataFrame, *columns: str) -> DataFrame:
        """``rows`` with the texts of some columns replaced by their numbers; unknown texts become NULL."""
        known = self.table.read()
        for c in columns:
            if known is None:
                rows = rows.withColumn(c, F.lit(None).cast("long"))
                continue
            pairs = known.select(F.col("id_text").alias(f"_{c}_text"), F.col("id").alias(f"_{c}_id"))
            rows = (rows.join(pairs, F.col(c) == F.col(f"_{c}_text"), "left")
                    .withColumn(c, F.col(f"_{c}_id")).drop(f"_{c}_text", f"_{c}_id"))
        return rows

    def decode(self, rows: DataFrame, *columns: str) -> DataFrame:
        """The inverse of ``encode``."""
        known = self.table.read()
        for c in columns:
            if known is None:
                rows = rows.withColumn(c, F.lit(None).cast("string"))
                continue
            pairs = known.select(F.col("id").alias(f"_{c}_id"), F.col("id_text").alias(f"_{c}_text"))
            rows = (rows.join(pairs, F.col(c) == F.col(f"_{c}_id"), "left")
                    .withColumn(c, F.col(f"_{c}_text")).drop(f"_{c}_text", f"_{c}_id"))
        return rows
