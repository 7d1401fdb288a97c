"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to the same number of cells by equal
depth, the cells are joined into one Hilbert index per row (neighbouring
indices are neighbouring cells in every dimension), the rows are sorted by the
index and the order is cut into runs of equal row count.  Each run then spans
a small box in all dimensions, so file statistics prune on any of them.

Only DataFrame operations: the index is a chain of integer projections, the
positions come from a range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, global_order, materialize

BITS = 8  # cells per dimension: 2 ** BITS


def equal_depth(df: DataFrame, columns: dict[str, Column], bits: int, name: str) -> DataFrame:
    """Add one integer cell column per entry of ``columns``: ``{cell name: key}``.

    Keys are strings whose order is the dimension's order; NULL sorts first.
    The cell of a key is ``floor(rows with a smaller key * 2^bits / rows)``, so
    equal keys share a cell and a hot one takes one.  Statistics are one row per
    distinct key of each dimension; their running totals come from a
    distributed sort of those rows, not from a one-task window.
    """
    total = max(df.count(), 1)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), c.alias("value"))
                               for i, c in enumerate(columns.values())]))
    values = df.select(keys.alias("k")).groupBy("k.dim", "k.value").agg(F.count(F.lit(1)).alias("n"))
    steps = global_order(values, [F.col("dim"), F.col("value").asc_nulls_first()], "before", f"{name}-values", "n")
    step = F.expr(f"cast(floor((before - dim * {total}L) * {1 << bits} / {total}) as bigint)")
    steps = materialize(steps.select("dim", "value", step.alias("cell")), f"{name}-cells")
    for i, (cell, key) in enumerate(columns.items()):
        value = fresh(df, "_value")
        one = steps.where(F.col("dim") == i).select(F.col("value").alias(value), F.col("cell").alias(cell))
        df = df.join(one, key.eqNullSafe(F.col(value)), "left").drop(value)
    return df


def with_hilbert(df: DataFrame, cells: list[str], bits: int, out: str) -> DataFrame:
    """``df`` with ``out``, the Hilbert index of the bigint columns ``cells``.

    Skilling's transform over an array of the cells: a fold over (bit,
    dimension) steps undoes the curve's rotations, a running exclusive-or and a
    last flip give the transposed index, whose bits are then interleaved.  Folds
    bind each intermediate array once, so the expression stays small.
    """
    x, gray, turn = (fresh(df, c) for c in ("_hx", "_hgray", "_hturn"))
    k = len(cells)
    steps = ", ".join(f"struct({1 << b}L AS q, {i} AS i)" for b in range(bits - 1, 0, -1) for i in range(k))
    swap = "if(a[s.i] & s.q != 0, 0L, (a[0] ^ a[s.i]) & (s.q - 1))"
    undo = (f"transform(a, (v, j) -> v ^ if(j = 0, if(a[s.i] & s.q != 0, s.q - 1, {swap}), 0L) "
            f"^ if(j = s.i AND j != 0, {swap}, 0L))")
    axes = ", ".join(f"`{c}`" for c in cells)
    df = df.withColumn(x, F.expr(f"aggregate(array({steps}), array({axes}), (a, s) -> {undo})"
                                 if bits > 1 else f"array({axes})"))
    df = df.withColumn(gray, F.expr(f"transform({x}, (v, i) -> aggregate(slice({x}, 1, i + 1), 0L, (a, e) -> a ^ e))"))
    flips = f"transform(sequence(1, {bits}), b -> shiftleft(1L, b - 1))"
    df = df.withColumn(turn, F.expr(f"aggregate({flips}, 0L, (a, q) -> a ^ if({gray}[{k - 1}] & q != 0, q - 1, 0L))"))
    order = ", ".join(f"struct({b} AS b, {i} AS i)" for b in range(bits - 1, -1, -1) for i in range(k))
    index = f"aggregate(array({order}), 0L, (a, s) -> a * 2 + (shiftright({gray}[s.i] ^ {turn}, s.b) & 1L))"
    return df.withColumn(out, F.expr(index)).drop(x, gray, turn)


def hilbert_shards(df: DataFrame, dimensions: dict[str, Column], ties: list[Column], shards: int = 16,
                   bits: int = BITS, name: str = "hilbert", prefix: str = "") -> DataFrame:
    """Cut ``df`` into ``shards`` runs along the Hilbert order of ``dimensions``.

    Adds ``hilbert`` (index), ``shard`` (0 .. shards - 1), and ``slot`` (0-based
    place within the shard, gapless); with ``prefix`` the names are prefixed.
    Shard row counts differ by at most one: position ``p`` of ``n`` rows goes to
    shard ``floor(p * shards / n)``.  ``ties`` orders rows of one cell and should
    be near-unique; rows equal in all of it are interchangeable.  NULL values of
    a dimension (strings in the dimension's order) form its first cell.  An empty table gives an empty result.  All
    columns of ``df`` are kept; only ``df``'s narrow columns should be passed,
    since the sorted rows are written once.
    """
    hil, shard, slot = f"{prefix}hilbert", f"{prefix}shard", f"{prefix}slot"
    cells = {fresh(df, f"_cell{i}"): v for i, v in enumerate(dimensions.values())}
    quantised = equal_depth(df, cells, bits, name)
    indexed = with_hilbert(quantised, list(cells), bits, hil).drop(*cells)
    at = fresh(indexed, "_at")
    placed = global_order(indexed, [F.col(hil), *ties], at, f"{name}-order")
    n = max(df.count(), 1)
    number = F.expr(f"cast(floor(cast(`{at}` as decimal(38,0)) * {shards} / {n}) as int)")
    first = F.expr(f"cast(ceil(cast(`{shard}` as decimal(38,0)) * {n} / {shards}) as bigint)")
    return (placed.withColumn(shard, number)
            .withColumn(slot, F.col(at) - first).drop(at))


def document_rows(docs: DataFrame, name: str) -> DataFrame:
    """Narrow metadata of ``documents``: ids, size, checksum, lang and source.

    ``size`` is the UTF-8 length of the text plus 1 (NULL: 1), ``text_crc32``
    the CRC-32 of those bytes (NULL and empty text: 0).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    return materialize(narrow, name)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: its place on the curve over source, language and size.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the
    ``hilbert`` index.  The law is ``rows``: shard counts differ by at most one,
    so ``grown_shard`` is NULL.  Documents with equal texts agree in size, and
    fall together where source and language agree too.  Repeated rows each get
    a slot of their own; NULL ids, texts, languages and sources are values.
    """
    rows = document_rows(docs, "hilbert-rows")
    placed = hilbert_shards(rows, {"source": F.col("source"), "lang": F.col("lang"), "size": F.lpad(F.col("size").cast("string"), 20, "0")},
                            [F.col("doc_id").asc_nulls_first(), F.col("text_crc32")], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "hilbert")
