"""Helpers shared by the operators of this subpackage.

* ``fresh`` names a working column that no input column can clash with.
* ``global_order`` gives every row its 0-based position in a total order
  without a single-task window: a range-partitioned sort is written to the
  shared folder, the rows of each sorted part are counted (one row per part),
  and the running totals of those counts are added back.
* ``components`` labels the connected components of an edge list by rounds of
  star contraction, each round a written table.
* ``texts`` and ``slabs`` expose the UTF-8 bytes of an Arrow string column as
  numpy arrays, a bounded number of bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["fresh", "global_order", "components", "texts", "slabs", "materialize", "read"]

_ROW_BITS = 33  # monotonically_increasing_id keeps the row of a part in its low 33 bits


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def global_order(df: DataFrame, order: list[Column], out: str, name: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``out``: the 0-based position of each row in ``order``.

    With ``weight``, ``out`` is instead the sum of that column over the rows
    before.  ``order`` should end in near-unique columns, since the range sort
    cannot split equal keys; rows equal in all of it get neighbouring positions.
    The sorted rows are a written table, so positions never change on a retry.
    """
    part, rows = fresh(df, "_part"), fresh(df, "_rows")
    marked = df.orderBy(*order).withColumn(out, F.monotonically_increasing_id())
    table = materialize(marked, name)
    table = table.withColumn(part, F.shiftright(out, _ROW_BITS))
    place = F.col(out).bitwiseAND((1 << _ROW_BITS) - 1)
    if weight:
        inside = Window.partitionBy(part).orderBy(out).rowsBetween(Window.unboundedPreceding, -1)
        place = F.coalesce(F.sum(weight).over(inside), F.lit(0))
    counts = table.groupBy(part).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias(rows))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(rows))
    # one row per sorted part, so the broadcast is bounded by the partition count
    return (table.withColumn(out, place).join(F.broadcast(starts), part)
            .withColumn(out, F.col(rows) + F.col(out)).drop(part, rows))


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges ``(a, b)``, both long.

    Returns ``(node, root)``, ``root`` the smallest node of the component, for
    every node of an edge.  Alternates the large-star and small-star steps:
    each links a node's neighbours to the smallest of them, so the edge list
    never grows and settles into stars in a logarithmic number of rounds.
    Minima are aggregations with map-side combine; a hub node only meets its
    one minimum in a join, which adaptive execution may split.
    """
    a, b = F.col("a"), F.col("b")
    cur = materialize(edges.select("a", "b").where(a != b)
                      .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
                      f"{name}-edges")
    last = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour of a node goes to the node's minimum
        large = (both.where(b > a).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node's smaller neighbours, and the node, go to the minimum
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = (linked.where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
                 .union(linked.select("a", F.col("m").alias("b"))).distinct())
        cur = materialize(small, f"{name}-edges")
        state = cur.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"),
                        F.bit_xor(F.xxhash64("b", "a")).alias("g")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    nodes = cur.select(a.alias("node"), b.alias("root"))
    return nodes.union(cur.select(b.alias("node"), b.alias("root"))).distinct()


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row offsets (rows + 1) and validity of an Arrow string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    valid = np.asarray(column.is_valid())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), valid
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not valid.all():  # a null may own bytes: give it none
        lengths = np.where(valid, np.diff(off), 0)
        if (lengths != np.diff(off)).any():
            keep = [raw[s:s + n] for s, n in zip(off[:-1], lengths) if n]
            raw = np.concatenate(keep) if keep else np.zeros(0, np.uint8)
            off = np.concatenate(([0], np.cumsum(lengths)))
    return raw[off[0]:off[-1]], off - off[0], valid


def slabs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges ``[a, b)`` of at most ``limit`` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b
