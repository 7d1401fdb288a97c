"""Labelled folds shared by the classifiers.

A document is held out if ``crc32(doc_id as text) mod 5 = 0``.  Models are fitted
on labelled rows of the other folds only, at most ``FIT_ROWS`` of them (those
with the smallest hashes of their id, one row of each id), which bounds what
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def fit_labels(labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, label)`` of the rows to fit on.

    NULL ids and labels are skipped; of several labels of an id the largest counts.
    """
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    one = one.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_each(rows: DataFrame, value: str) -> DataFrame:
    """``(doc_id, label, value)``: of the rows of an id the one with the smallest hash of ``value``."""
    first = F.min(F.struct(F.xxhash64(value).alias("h"), F.col(value).alias("v")))["v"]
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"), first.alias(value))
