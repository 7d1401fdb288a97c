"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source has a target number of words.  Its documents are dealt by a seeded
hash to shards of bounded size, each shard's words form one stream in hash
order, and the stream is cut into blocks of equal word count.  All blocks of
the mix are given to shards by highest quotients (a shard's exact quota divided
by 1, 3, 5, ...), which yields an integer quota per shard; whole passes over a
shard come first, then a seeded selection of its blocks.  A document's share is
the part of its words that lies in chosen blocks.  The few words by which the
blocks of a source miss its target are settled by cutting blocks.

Only DataFrame operations.  The highest quotients are found by a search for the
threshold quotient: a few aggregations over one row per shard, each trying many
thresholds at once.  Shards keep a hot source from meeting in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, global_order, materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)     # by rank of the source, repeating
SHARE = 1.5             # words of the mix / words of all documents
REPEAT = 2              # no source, block or document is taken more often
BLOCK = 64              # words per block
SHARD_WORDS = 1 << 18   # words and rows of a shard, on average
SHARD_ROWS = 512
STEP = 1_000_000_007    # prime stride of the block selection
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(column: Column, salt: str) -> Column:
    """A non-negative 60-bit hash of the column's text and the salt."""
    key = F.concat(F.lit(f"{salt}|"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``(source, words, n, target)`` from rows ``(source, size)``.

    Sources in code-point order, NULL last, have the weights in turn.  They
    share ``share`` times all words by weight; a target stops at ``repeat``
    times its source's words and the excess is shared out again by weight.
    Each round of that is one aggregate over the source table.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    sources = global_order(sources, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = materialize(sources.withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int"))),
                          "mix-weights")
    goal = share * (sources.agg(F.sum("words")).first()[0] or 0)
    level, stopped = 0.0, -1
    cap = F.col("words") * repeat
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        got = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if not got[1] or got[2] == stopped:
            break
        level, stopped = (goal - (got[0] or 0)) / got[1], got[2]
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.select("source", "words", "n", target.alias("target"))


def highest_quotients(members: DataFrame, seats: int, order: list[str], name: str,
                      tries: int = 32, rounds: int = 6) -> DataFrame:
    """Give ``seats`` to ``members`` by highest quotients ``quota / (2k - 1)``.

    ``members`` has ``quota`` (double, >= 0) and ``limit`` (most seats).  Adds
    ``seats``.  Equal quotients go by ``order``.  The threshold quotient is
    bracketed by aggregations over a grid; the few quotients left inside the
    last bracket are ranked.
    """
    def at(threshold: float) -> Column:
        return F.least(F.col("limit"), F.floor((F.col("quota") / F.lit(threshold) + 1) / 2).cast("long"))

    def given(thresholds: list[float]) -> list[int]:
        got = members.agg(*[F.sum(at(t)).alias(f"t{i}") for i, t in enumerate(thresholds)]).first()
        return [int(x or 0) for x in got]

    top, most = members.agg(F.max("quota"), F.sum(F.when(F.col("quota") > 0, F.col("limit")))).first()
    seats = min(seats, int(most or 0))
    if not top or seats <= 0:
        return members.withColumn("seats", F.lit(0).cast("long"))
    high, low = top * 2.0, min(top, 1.0)      # nobody gets a seat at high
    while given([low])[0] < seats:
        high, low = low, low / 1024
    have = given([high])[0]
    for _ in range(rounds):
        grid = [low * (high / low) ** (i / (tries + 1)) for i in range(1, tries + 1)]
        counts = given(grid)
        above = [(t, c) for t, c in zip(grid, counts) if c < seats]
        below = [t for t, c in zip(grid, counts) if c >= seats]
        if above:
            high, have = above[0]
        low = below[-1] if below else low
        if high <= low * (1 + 1e-15):
            break
    members = members.withColumn("seats", at(high))
    ask = F.sequence(F.col("seats") + 1, at(low))
    close = members.where(at(low) > F.col("seats")).select(*order, "quota", F.explode(ask).alias("k"))
    ranked = global_order(close, [(F.col("quota") / (2 * F.col("k") - 1)).desc(),
                                  *[F.col(c).asc_nulls_last() for c in order], F.col("k")], "place", f"{name}-close")
    more = ranked.where(F.col("place") < seats - have).groupBy(*order).agg(F.count(F.lit(1)).alias("more"))
    same = [members[c].eqNullSafe(more[c]) for c in order]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return (members.join(more, on, "left")
            .select(*[members[c] for c in members.columns if c != "seats"],
                    (F.col("seats") + F.coalesce(F.col("more"), F.lit(0))).alias("seats")))


def _numbered(narrow: DataFrame, n: dict[str, str]) -> DataFrame:
    """``narrow`` with ``copy``: a number from 0 among rows equal in id, source and text.

    Rows are counted within the parts of the written table, so a row that fills
    a third of the table is spread over as many tasks as hold it.
    """
    key = ["doc_id", n["source"], n["digest"]]
    part = F.shiftright(n["row"], 33)
    counts = narrow.groupBy(*key, part.alias(n["part"])).agg(F.count(F.lit(1)).alias("c"))
    each = Window.partitionBy(*key)
    earlier = each.orderBy(n["part"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.col(n["part"]).alias("_kp"),
                           F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"), F.sum("c").over(each).alias("all"))
    same = F.col(n["part"]) == F.col("_kp")
    for i, c in enumerate(key):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*key, n["part"]).orderBy(n["row"])
    held = narrow.withColumn(n["part"], part)
    many = held.join(starts.where(F.col("all") > 1), same).select(
        *narrow.columns, (F.col("before") + F.row_number().over(inside) - 1).alias(n["copy"]))
    one = held.join(starts.where(F.col("all") == 1), same, "left_semi").select(
        *narrow.columns, F.lit(0).cast("long").alias(n["copy"]))
    return one.unionByName(many)


def _place(j: Column, blocks: Column, turn: Column) -> Column:
    """Place of block ``j`` in the seeded permutation of a shard's blocks."""
    count = F.greatest(blocks, F.lit(1))
    return (j * (F.lit(STEP) % count) + turn) % count


def shard_words(members: DataFrame, sources: DataFrame) -> DataFrame:
    """How many words the mix takes of each shard: ``passes`` whole ones, ``full`` blocks and ``rest`` words.

    ``members`` has ``source, shard, z`` (words), ``words`` and ``target`` of the
    source.  Blocks go by highest quotients; a shard's quota is its blocks
    times ``target / words``.  What the blocks of a source miss of its target,
    or exceed it by (rounding, short last blocks), is settled in words, shard
    after shard, so every source's words come to its target rounded.  The
    blocks taken once more are the first in a seeded order; the last of them may
    be taken in part.
    """
    blocks = F.ceil(F.col("z") / BLOCK).cast("long")
    tag = F.concat_ws("|", F.coalesce(F.col("source"), F.lit("null")), F.col("shard").cast("string"))
    quota = F.coalesce(F.col("target") * F.col("blocks") / F.nullif(F.col("words"), F.lit(0)), F.lit(0.0))
    members = materialize(members.withColumn("blocks", blocks).withColumn("limit", F.col("blocks") * REPEAT)
                          .withColumn("quota", quota)
                          .withColumn("turn", F.pmod(seeded(tag, SEED), F.greatest(F.col("blocks"), F.lit(1)))),
                          "mix-members")
    total = members.agg(F.sum("quota")).first()[0] or 0.0
    z, nb, one = F.col("z"), F.col("blocks"), F.greatest(F.col("blocks"), F.lit(1))
    last = _place(nb - 1, nb, F.col("turn"))           # where the short block comes
    short = nb * BLOCK - z
    seats = highest_quotients(members, int(total + 0.5), ["source", "shard"], "mix")
    extra = F.col("seats") % one
    given = (F.floor(F.col("seats") / one) * z + extra * BLOCK - F.when(last < extra, short).otherwise(F.lit(0)))
    seats = materialize(seats.withColumn("given", F.when(nb > 0, given).otherwise(F.lit(0)).cast("long")), "mix-seats")
    missed = seats.groupBy("source").agg((F.floor(F.first("target") + 0.5).cast("long") - F.sum("given")).alias("missed"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    seats = seats.join(missed.withColumnRenamed("source", "_s"), same).drop("_s")
    seats = seats.withColumn("room", F.when(F.col("missed") > 0, z * REPEAT - F.col("given")).otherwise(F.col("given")))
    seats = global_order(seats, [F.col("source").asc_nulls_last(), F.col("shard")], "reached", "mix-settled", "room")
    first = seats.groupBy(F.col("source").alias("_s")).agg(F.min("reached").alias("_first"))
    seats = seats.join(first, same).drop("_s")
    moved = F.greatest(F.lit(0), F.least(F.col("room"), F.abs("missed") - (F.col("reached") - F.col("_first"))))
    take = F.col("given") + F.signum("missed").cast("long") * moved
    rows = seats.withColumn("passes", F.floor(take / F.greatest(z, F.lit(1))).cast("long")) \
        .withColumn("more", (take - F.col("passes") * z).cast("long"))
    more, step = F.col("more"), F.floor(F.col("more") / BLOCK).cast("long")
    tail = BLOCK - short                                # words of the short block
    full = (F.when(step < last, step).when(step == last, step + F.when(more % BLOCK >= tail, 1).otherwise(0))
            .otherwise(F.floor((more + short) / BLOCK).cast("long")))
    rows = rows.withColumn("full", F.when(nb > 0, full).otherwise(F.lit(0)).cast("long"))
    rest = more - (F.col("full") * BLOCK - F.when(last < F.col("full"), short).otherwise(F.lit(0)))
    return rows.select("source", "shard", "blocks", "turn", "passes", "full", rest.cast("long").alias("rest"))


def mixture(docs: DataFrame, keep_all: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Rows of ``docs`` with their block figures; the names of those columns.

    Columns (named freshly): ``size``, ``words`` and ``target`` of the source,
    ``start`` (place of the row's first word in its shard's stream), and of the
    shard ``blocks``, ``turn`` (offset of the selection), ``passes`` (whole passes
    over it), ``full`` (blocks taken once more) and ``rest`` (words of one more).
    With ``keep_all`` all columns of ``docs`` stay, else ``doc_id``.

    Rows are dealt to shards by a hash of id, text and copy number.  Only narrow
    rows are numbered and ordered; texts meet their figures once, by row.
    """
    names = {c: fresh(docs, f"_mix_{c}") for c in (
        "row", "part", "copy", "words", "target", "shard", "size", "digest", "source", "start", "blocks", "turn",
        "passes", "full", "rest", "hash")}
    sized = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep_all else ["doc_id"])],
                        word_count(F.col("text")).alias(names["size"]),
                        F.substring(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")), 1, 16).alias(names["digest"]),
                        F.col("source").cast("string").alias(names["source"]),
                        F.monotonically_increasing_id().alias(names["row"]))
    table = materialize(sized, "mix-rows")
    narrow = table.select("doc_id", *[names[c] for c in ("source", "size", "digest", "row")])
    sources = materialize(source_targets(narrow.select(F.col(names["source"]).alias("source"),
                                                       F.col(names["size"]).alias("size"))), "mix-targets")
    figures = sources.select(F.col("source").alias("_s"), F.col("words").alias(names["words"]), "n",
                             F.col("target").alias(names["target"]))
    same = F.col(names["source"]).eqNullSafe(F.col("_s"))
    shards = F.greatest(F.ceil(F.col(names["words"]) / SHARD_WORDS), F.ceil(F.col("n") / SHARD_ROWS), F.lit(1))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), names["digest"],
                      F.col(names["copy"]).cast("string"))
    dealt = (_numbered(narrow, names).join(figures, same).withColumn(names["hash"], seeded(key, SEED))
             .withColumn(names["shard"], F.pmod(F.col(names["hash"]), shards.cast("long"))))
    dealt = materialize(dealt.drop("_s", "n"), "mix-dealt")
    members = dealt.groupBy(F.col(names["source"]).alias("source"), F.col(names["shard"]).alias("shard")).agg(
        F.sum(names["size"]).alias("z"), F.first(names["words"]).alias("words"), F.first(names["target"]).alias("target"))
    quotas = materialize(shard_words(members, sources), "mix-quotas")
    quotas = quotas.select(F.col("source").alias("_s"), F.col("shard").alias("_h"),
                           *[F.col(c).alias(names[c]) for c in ("blocks", "turn", "passes", "full", "rest")])
    stream = (Window.partitionBy(names["source"], names["shard"])
              .orderBy(names["hash"], F.col("doc_id").asc_nulls_first(), names["digest"], names["copy"])
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn(names["start"], F.coalesce(F.sum(names["size"]).over(stream), F.lit(0)))
    rows = placed.join(quotas, same & (F.col(names["shard"]) == F.col("_h"))).drop("_s", "_h")
    if not keep_all:
        return rows, names
    kept = [names[c] for c in ("row", "start", "blocks", "turn", "passes", "full", "rest")]
    return table.drop(names["digest"], names["source"]).join(rows.select(*kept), names["row"]), names


def _spanned(names: dict[str, str]) -> Column:
    """Numbers of the blocks that a non-empty row's words lie in."""
    start, size = F.col(names["start"]), F.col(names["size"])
    return F.sequence(F.floor(start / BLOCK), F.floor((start + size - 1) / BLOCK))


def _span(j: Column, names: dict[str, str]) -> tuple[Column, Column]:
    """Words of a row, from and to (ends exclusive, counted in its shard), that block ``j`` adds to the mix."""
    start, size = F.col(names["start"]), F.col(names["size"])
    place = _place(j, F.col(names["blocks"]), F.col(names["turn"]))
    most = F.when(place < F.col(names["full"]), F.lit(BLOCK)).when(place == F.col(names["full"]), F.col(names["rest"])) \
        .otherwise(F.lit(0))
    first = F.greatest(start, j * BLOCK)
    return first, F.greatest(first, F.least(start + size, j * BLOCK + most))


def mix_documents(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document.

    One row per row of ``docs``: ``doc_id, size`` (words), ``source_size`` and
    ``target`` of its source, ``taken`` (its words in the mix, repeats
    counted).  The words taken of a source come to its target, rounded.  NULL or
    empty texts have size 0 and nothing taken; a NULL source is a source; NULL
    and repeated ids, and rows repeated whole, are rows of their own and are
    dealt apart.  A very long text is one row of its shard.  An empty table
    gives an empty result.
    """
    rows, names = mixture(docs)
    size = F.col(names["size"])

    def add(acc, j):
        a, b = _span(j, names)
        return acc + (b - a).cast("long")

    some = F.when(size > 0, F.aggregate(_spanned(names), F.lit(0).cast("long"), add)).otherwise(F.lit(0))
    return rows.select("doc_id", size.alias("size"), F.col(names["words"]).alias("source_size"),
                       F.col(names["target"]).alias("target"), (size * F.col(names["passes"]) + some).alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A row appears once for each whole pass over its shard, and once more with
    the words of its chosen extra blocks (joined by spaces, or the unchanged
    text if all its words are chosen).  ``n_chars``, if there, is the length of
    the text given.  Rows without words are never in a mix.  NULLs, repeats and
    empty tables are treated as by ``mix_documents``.
    """
    rows, names = mixture(docs, keep_all=True)
    start, size = F.col(names["start"]), F.col(names["size"])
    words = fresh(rows, "_mix_words")
    rows = rows.where(size > 0)
    spans = F.transform(_spanned(names), lambda j: F.struct(*[c.alias(n) for n, c in zip(("a", "b"), _span(j, names))]))
    rows = rows.withColumn(words, F.filter(spans, lambda s: s["b"] > s["a"]))
    picked = F.col(words)
    taken = F.aggregate(picked, F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])
    every = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))

    def cut(w):
        parts = F.transform(picked, lambda s: F.slice(w, (s["a"] - start + 1).cast("int"), (s["b"] - s["a"]).cast("int")))
        return F.array_join(F.flatten(parts), " ")

    # words are split out once, and only of texts of which a part is taken
    part = F.when(taken == size, F.col("text")).otherwise(F.transform(F.array(every), cut)[0])
    copies = F.array_repeat(F.col("text"), F.col(names["passes"]).cast("int"))
    extra = F.when(F.size(picked) > 0, F.array(part)).otherwise(F.array().cast("array<string>"))
    out = rows.withColumn(words, F.concat(copies, extra))
    text = fresh(out, "_mix_text")
    out = out.withColumn(text, F.explode(words))
    pick = {"text": F.col(text), "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[pick.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
