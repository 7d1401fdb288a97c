"""Exact ranks and running totals without a one-task window (M5, M7).

Rows are sorted over the cluster (range partitions) and written once with the
number of their part.  Inside a part a window gives ranks and sums; the totals
of the parts before, one row per part, are added to them.  No task sees more
than one part, and the driver sees nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PART, _PLACE = "_sorted_part", "_sorted_place"


def sorted_table(rows: DataFrame, order: list[Column], name: str = "sorted") -> DataFrame:
    """``rows`` in ``order`` as a written table with ``_sorted_part`` and ``_sorted_place`` (order in a part).

    ``order`` should name a row uniquely: equal rows stay in one part.
    """
    out = rows.orderBy(*order).withColumn(_PART, F.spark_partition_id()) \
        .withColumn(_PLACE, F.monotonically_increasing_id())
    return materialize(out, name)


def before(table: DataFrame, **values: Column) -> DataFrame:
    """A sorted table with, per value, its sum over all rows before each row."""
    inside = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy(_PART).agg(*[F.sum(c).alias(f"_{n}") for n, c in values.items()])
    starts = totals.select(_PART, *[F.coalesce(F.sum(f"_{n}").over(parts), F.lit(0)).alias(f"_{n}") for n in values])
    # one row per part
    out = table.join(F.broadcast(starts), _PART)
    return out.select(*[c for c in table.columns if c not in (_PART, _PLACE)],
                      *[(F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n)
                        for n, c in values.items()])


def ranked(rows: DataFrame, order: list[Column], out: str = "rank", name: str = "ranked") -> DataFrame:
    """``rows`` with ``out``: the 0-based position of each in ``order``."""
    return before(sorted_table(rows, order, name), **{out: F.lit(1).cast("long")})


def roc_auc(scored: DataFrame, score: str, label: str, by: str) -> DataFrame:
    """M5: exact area under the ROC curve of ``score`` against a 0/1 ``label``, per value of ``by``.

    The share of (positive, negative) pairs that the score puts in the right
    order, ties counting half.  Rows are reduced to counts per score first, so a
    score that a third of all rows share is one row; positives of each score
    then meet the number of negatives below it.  All sums are whole numbers.
    NULL scores and labels take no part; without positives or negatives the
    area is NULL.  Returns ``by, auc, positives, negatives, distinct_scores``.
    """
    y = F.col(label).cast("long")
    rows = scored.where(F.col(score).isNotNull() & y.isin(0, 1))
    counts = rows.groupBy(by, F.col(score).cast("double").alias("_score")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    table = before(sorted_table(counts, [F.col(by), F.col("_score")], "auc-counts"), _below=F.col("_neg"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    # below counts the groups before as well: their negatives are the least `below` of the group
    each = table.groupBy(by).agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.count(F.lit(1)).alias("distinct_scores"),
        F.min("_below").alias("_first"), F.sum(wide("_pos") * (2 * wide("_below") + wide("_neg"))).alias("_twice"))
    area = (F.col("_twice") - 2 * wide("_first") * wide("positives")).cast("double") / F.nullif(
        2.0 * F.col("positives") * F.col("negatives"), F.lit(0.0))
    return each.select(by, area.alias("auc"), "positives", "negatives", "distinct_scores")


def permuted(rows: DataFrame, column: str, order: list[Column], name: str = "permuted") -> DataFrame:
    """``rows`` with ``column`` taken from the next row in ``order`` (the last takes the first's).

    ``order`` should be a hash that is unrelated to the values, ending in a key.
    """
    table = materialize(ranked(rows, order, "_rank", name), name)
    n = F.lit(max(table.count(), 1))
    moved = table.select(F.pmod(F.col("_rank") - 1, n).alias("_rank"), F.col(column).alias("_moved"))
    return table.join(moved, "_rank").withColumn(column, F.col("_moved")).select(*rows.columns)
