"""SimHash near-duplicates with pivot distance tables.

A text's fingerprint has, for each of 64 bits, the majority over the XXH64
hashes of its word shingles.  Fingerprints that differ in at most ``MOST_BITS``
bits are linked, and links are followed to components.

Equal fingerprints collapse first, so groups of copies cost one row.  Distinct
ones meet in buckets: the bits outside a bucket's mask are cut into six pieces,
and since at most four bits differ, two pieces at least agree; each of the 15
pairs of pieces is a bucket key.  A bucket above ``BUCKET`` rows is cut again
by the same rule over its remaining bits, so no bucket outgrows a task and no
pair is lost.  Inside a bucket every fingerprint has its Hamming distances to
the reference fingerprints (pivots): rows are ordered by the first, pairs whose
distance to any pivot differs by more than ``MOST_BITS`` are discarded by the
triangle inequality, and the survivors are verified bit by bit.  A bucket
returns links to the smallest member of each of its components, never all
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, fresh, materialize, slabs, texts
from .tokens import SLAB

SHINGLE = 4
MOST_BITS = 4
BUCKET = 1024
PIVOTS = 24
LEAST_FREE = 13


def _fingerprint_rows(data: np.ndarray, off: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprints of rows of UTF-8 text; wordless rows have zero."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        text = b" ".join(data[a:b].tobytes().lower().split())
        if not text:
            counts.append(0)
            continue
        gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        n = len(gaps) + 1
        if n <= shingle:
            hashes.append(digest(text, 42))
            counts.append(1)
            continue
        view, gaps = memoryview(text), gaps.tolist()
        starts = [0] + [g + 1 for g in gaps[:n - shingle]]
        ends = gaps[shingle - 1:] + [len(text)]
        hashes += [digest(view[s:e], 42) for s, e in zip(starts, ends)]
        counts.append(n - shingle + 1)
    counts = np.array(counts, np.int64)
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        major = (2 * ones > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, out: str, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``out``: the fingerprint as a signed long."""
    used = [c for c in docs.columns if c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off, _ = texts(batch.column(len(used)))
            fp = [_fingerprint_rows(data, off[a:b + 1], shingle) for a, b in slabs(off, SLAB)]
            fp = np.concatenate(fp) if fp else np.zeros(0, np.uint64)
            cols = [batch.column(i) for i in range(len(used))] + [pa.array(fp.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=used + [out])

    text = fresh(docs, "_text")
    df = docs.select(*[f"`{c}`" for c in used], F.col("text").cast("string").alias(text))
    schema = ", ".join([f"`{c}` {t}" for c, t in df.dtypes[:-1]] + [f"`{out}` long"])
    return df.mapInArrow(run, schema)


def pieces(mask: int, count: int) -> list[int]:
    """The masks of ``count`` near-equal pieces of the bits outside ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // count for i in range(count + 1)]
    return [sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer(mask: int, most_bits: int = MOST_BITS) -> list[int]:
    """Masks that extend ``mask`` so that rows within ``most_bits`` agree on one."""
    return [_signed(mask | a | b) for a, b in combinations(pieces(mask, most_bits + 2), 2)]


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed pseudo-random sequence."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    return rng.integers(0, 1 << 64, count, dtype=np.uint64)


def link_bucket_rows(group: np.ndarray, fp: np.ndarray, most_bits: int) -> np.ndarray:
    """Index of the smallest linked fingerprint of each row, within its group.

    ``group`` is non-decreasing; ``fp`` are distinct within a group.
    """
    table = np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], group))
    group, fp, table = group[order], fp[order], table[order]
    left, right = [], []
    active, d = np.arange(len(fp)), 1
    while len(active):
        active = active[active + d < len(fp)]
        ok = group[active] == group[active + d]
        ok &= table[active + d, 0] - table[active, 0] <= most_bits
        active = active[ok]
        other = active + d
        same = (np.abs(table[active] - table[other]) <= most_bits).all(axis=1)
        i, j = active[same], other[same]
        same = np.bitwise_count(fp[i] ^ fp[j]) <= most_bits
        left.append(i[same])
        right.append(j[same])
        d += 1
    i, j = np.concatenate(left or [[]]).astype(np.int64), np.concatenate(right or [[]]).astype(np.int64)
    rank = np.empty(len(fp), np.int64)  # by signed fingerprint, so the smallest one is the root
    rank[np.argsort(fp.view(np.int64), kind="stable")] = np.arange(len(fp))
    label = rank.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            break
        label = new
    root = np.empty(len(fp), np.int64)
    root[order] = order[np.argsort(rank, kind="stable")[label]]
    return root


def _link(most_bits: int):
    """A task over rows sorted by bucket: star links of each bucket."""
    def emit(mask, key, fp):
        change = np.concatenate(([False], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])))
        root = link_bucket_rows(np.cumsum(change), fp.view(np.uint64), most_bits)
        apart = root != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[apart]), pa.array(fp[root[apart]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            mask, key, fp = held
            if not len(fp):
                continue
            last = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on
            if cut:
                yield emit(mask[:cut], key[:cut], fp[:cut])
                held = [x[cut:].copy() for x in held]
        if held is not None and len(held[2]):
            yield emit(*held)
    return run


def _cut_again(most_bits: int):
    """Rows ``(fp, mask)`` of large buckets, once for each finer mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, mask = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for m in np.unique(mask).tolist():
                child, rows = finer(m & (1 << 64) - 1, most_bits), fp[mask == m]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(rows, len(child))), pa.array(np.tile(np.array(child, np.int64), len(rows)))],
                    names=["fp", "mask"])
    return run


def links(distinct: DataFrame, most_bits: int = MOST_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` whose components join all ``fp`` within ``most_bits`` bits.

    Cutting ends where ``LEAST_FREE`` bits or fewer are free: such a bucket has
    at most ``2 ** LEAST_FREE`` distinct fingerprints.
    """
    level = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in finer(0, most_bits)])).alias("mask"))
    found = None
    while True:
        level = materialize(level.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-buckets")
        large = materialize(level.where(F.bit_count("mask") < 64 - LEAST_FREE).groupBy("mask", "key").count()
                            .where(F.col("count") > bucket).select("mask", "key"), "simhash-large")
        done = large.isEmpty()
        small = level if done else level.join(large, ["mask", "key"], "left_anti")
        dealt = small.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key")
        got = dealt.mapInArrow(_link(most_bits), "a long, b long")
        found = got if found is None else found.union(got)
        if done:
            return found
        again = level.join(large, ["mask", "key"], "left_semi").select("fp", "mask")
        level = again.mapInArrow(_cut_again(most_bits), "fp long, mask long")


def component_of(rows: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``(fp, root, component_id)`` for each distinct ``fp`` of ``rows`` ``(doc_id, fp)``.

    ``root`` names the component by a fingerprint, ``component_id`` by its
    smallest ``doc_id`` (NULL if it has none).
    """
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    label = components(links(distinct.select("fp"), most_bits), "simhash")
    rooted = distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    NULL, empty and blank texts have fingerprint zero and are linked by it like
    any other.  Texts of fewer words than a shingle are one shingle.  Repeated
    rows share a fingerprint and component.  An empty table gives an empty one.
    """
    rows = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "fp", ["doc_id"], shingle)
    rows = materialize(rows, "simhash-rows")
    out = rows.join(component_of(rows, most_bits), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest ``doc_id``.

    Of rows of a component that share that id one stays, by the hash of its
    text.  Rows without an id stay, one of them, only where no row has one.
    """
    fp, low, root, pick = (fresh(docs, x) for x in ("_fp", "_low", "_root", "_pick"))
    rows = materialize(fingerprints(docs, fp, docs.columns, shingle), "simhash-docs")
    small = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"))
    comp = component_of(small, most_bits).withColumnsRenamed({"fp": fp, "root": root, "component_id": low})
    first = rows.join(comp, fp).where(F.col("doc_id").cast("long").eqNullSafe(F.col(low)))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (first.groupBy(root).agg(F.min_by(whole, F.xxhash64("text")).alias(pick))
            .select(*[F.col(f"{pick}.`{c}`").alias(c) for c in docs.columns]))
