"""Exact substring deduplication with deep-shallow sorted suffixes.

A byte is removed if a ``LENGTH``-byte string over it also starts earlier in the
corpus.  So for each window of ``LENGTH`` bytes one must know whether an equal
window comes earlier: equal windows are neighbours in the sorted order of all
suffixes, cut at ``LENGTH``.

*Partitioning.*  A window's key is the least hash of the ``GRAM``-byte strings in
it, so equal windows share a key, and runs of neighbouring windows share one
too.  Such a run, with its bytes, is the unit that is dealt out; about one in 35
positions starts one.

*Pruning.*  Runs of equal bytes collapse to the earliest one, first within a
batch of documents (before any shuffle), then per key; all windows of the others
are repeats.  Keys with one remaining run, which does not repeat itself, need no
sorting, and only runs of other keys fetch their bytes.

*Sorting.*  The suffixes at all windows of a key are put in order by deep-shallow
sorting: a multikey quicksort, eight bytes a step, to depth ``SHALLOW``; the
groups that still share a longer prefix are ordered by blind tries, which branch
on single bytes and compare whole strings once per insertion.  All windows equal
to an earlier one are marked.

*Skew.*  Keys that hold over 1/``HEAVY`` of all runs are found by a first count
and their runs dealt window by window, keyed by the window itself.  Keys with
over ``BIG`` different runs are sorted that way too, so a task holds at most
``BIG`` runs of a key at once.  Collapsing uses 64-bit hashes of the run beside
its 64-bit key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_order, materialize, slabs, texts
from .tokens import SLAB, inverse, mixed, powers

LENGTH = 100
GRAM = 32
SHALLOW = 32
HEAVY = 4096
BIG = 2000
CUT = 4096          # windows of a run at most

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Runs:
    """Cuts texts into runs of windows with one key; vectorised over a slab of rows."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.span = length - GRAM + 1       # grams of a window
        self._up = self._down = np.zeros(0, np.uint64)

    def _slide(self, x: np.ndarray, func) -> np.ndarray:
        """``func`` over each ``span`` neighbours."""
        width = 1
        while width * 2 <= self.span:
            x = func(x[:-width], x[width:])
            width *= 2
        rest = self.span - width
        return func(x[:len(x) - rest], x[rest:]) if rest else x

    def cut(self, data: np.ndarray, off: np.ndarray):
        """``(key, content, row, start, windows, repeats itself)`` arrays, and the
        content hash of any ``(start, bytes)`` of the slab."""
        n, none = len(data), np.zeros(0, np.int64)
        if n < self.length:
            return (none.astype(np.uint64), none.astype(np.uint64), none, none, none, none.astype(bool)), None
        if len(self._up) < n + 1:
            size = max(n, SLAB) + 1
            self._up, self._down = powers(size), powers(size, inverse(_C[0]))
        word = np.ndarray((n,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,)).copy()
        h = word[:n - 31] * _C[0]
        h ^= word[8:n - 23] * _C[1]
        h += word[16:n - 15] * _C[2]
        h ^= word[24:n - 7] * _C[3]
        h = mixed(h)
        low = self._slide(h, np.minimum)    # one per window
        ends = off[1:]
        last = np.zeros(len(low), bool)     # first window of a row, or first that would cross its end
        heads = off[:-1][np.diff(off) >= self.length]
        last[heads] = True
        over = ends[np.diff(off) >= self.length] - self.length + 1
        last[over[over < len(low)]] = True
        last[1:] |= low[1:] != low[:-1]
        last[0] = True
        start = np.flatnonzero(last)
        size = np.diff(np.append(start, len(low)))
        row = np.searchsorted(off, start, side="right") - 1
        ok = ends[row] - start >= self.length
        start, size, row = start[ok], size[ok], row[ok]
        valid = np.zeros(len(low) + 1, np.int64)
        np.add.at(valid, start, 1)
        np.add.at(valid, start + size, -1)
        # grams that are the least of some window; a run with two of them may repeat itself
        edge = np.zeros(self.span - 1, np.uint64)
        chosen = np.concatenate((edge, np.where(np.cumsum(valid[:-1]) > 0, low, np.uint64(0)), edge))
        place = np.flatnonzero((self._slide(chosen, np.maximum) == h) & (h > 0))
        of = np.searchsorted(off, place, side="right")
        again = np.zeros(len(place), np.int64)
        again[1:] = (h[place[1:]] == h[place[:-1]]) & (of[1:] == of[:-1])
        again = np.cumsum(again)
        if (size > CUT).any():
            parts = -(-size // CUT)
            first = np.repeat(start, parts)
            step = (np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)) * CUT
            size, row = np.minimum(np.repeat(size, parts) - step, CUT), np.repeat(row, parts)
            start = first + step
        a = np.searchsorted(place, start)
        b = np.searchsorted(place, start + size + self.span - 1) - 1
        repeats = (b > a) & (again[np.maximum(b, 0)] - again[np.minimum(a, len(again) - 1)] > 0)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(word) * self._up[:n], out=total[1:])

        def content(s, size_):
            return mixed((total[s + size_ - 7] - total[s]) * self._down[s] + size_.astype(np.uint64) * _C[2])

        return (low[start], content(start, size + self.length - 1), row, start - off[row], size, repeats), content


def heavy_keys(rows: DataFrame, length: int) -> list[int]:
    """Keys of over 1/``HEAVY`` of all runs: at most ``HEAVY`` of them.

    Each batch reports the keys that it holds often, so a key of that share is
    found whatever its spread; what is reported only decides how runs are dealt.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for batch in batches:
            data, off, _ = texts(batch.column(0))
            keys = [runs.cut(data[off[a]:off[b]], off[a:b + 1] - off[a])[0][0] for a, b in slabs(off, SLAB)]
            keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            key, count = np.unique(keys, return_counts=True)
            often = count >= max(2, len(keys) // (4 * HEAVY))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(key[often].view(np.int64), 0)), pa.array(np.append(count[often], 0)),
                 pa.array(np.append(np.zeros(often.sum(), np.int64), len(keys)))], names=["key", "n", "all"])

    counts = rows.select("text").mapInArrow(run, "key long, n long, all long")
    counts = materialize(counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("all").alias("all")), "suffix-keys")
    total = counts.agg(F.sum("all")).first()[0] or 0
    found = counts.where(F.col("n") > max(total // HEAVY, 64)).select("key").collect()
    return sorted(r[0] for r in found)


_ROW = "kind int, key long, content long, rid long, start int, n int"


def _collapse(key, content, rid, start, n):
    """Order of runs, and which are not the first of their key and content."""
    order = np.lexsort((start, rid, content, key))
    k, c = key[order], content[order]
    later = np.zeros(len(order), bool)
    later[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    return order, later


def _joined(rid, start, n):
    """Merge runs of windows that follow one another in a document."""
    order = np.lexsort((start, rid))
    rid, start, n = rid[order], start[order], n[order]
    head = np.ones(len(rid), bool)
    head[1:] = (rid[1:] != rid[:-1]) | (start[1:] != start[:-1] + n[:-1])
    at = np.flatnonzero(head)
    return rid[at], start[at], np.add.reduceat(n, at) if len(at) else n[:0]


def _extract(length: int, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, hot = Runs(length), np.array(heavy.value, np.int64).view(np.uint64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, off, _ = texts(batch.column(1))
            parts = []
            for a, b in slabs(off, SLAB):
                o = off[a:b + 1] - off[a]
                (key, content, row, start, n, again), hashed = runs.cut(data[off[a]:off[b]], o)
                if not len(key):
                    continue
                single = np.isin(key, hot)
                if single.any():  # deal these window by window
                    m, r = n[single], row[single]
                    s = np.repeat(start[single] + o[r], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    r = np.repeat(r, m)
                    c = hashed(s, np.full(len(s), length))
                    keep = ~single
                    key, content = np.append(key[keep], mixed(c ^ _C[1])), np.append(content[keep], c)
                    start, row = np.append(start[keep], s - o[r]), np.append(row[keep], r)
                    n = np.append(n[keep], np.ones(len(s), np.int64))
                    again = np.append(again[keep], np.zeros(len(s), bool))
                parts.append((key.view(np.int64), content.view(np.int64), ids[a + row], start, np.where(again, -n, n)))
            if not parts:
                continue
            key, content, rid, start, n = (np.concatenate(x) for x in zip(*parts))
            order, later = _collapse(key, content, rid, start, n)
            first, rest = order[~later], order[later]
            r, s, m = _joined(rid[rest], start[rest], np.abs(n[rest]))
            spread = mixed((r.astype(np.uint64) << np.uint64(20)) + s.astype(np.uint64)).view(np.int64)
            yield _batch(np.append(np.zeros(len(first), np.int32), np.ones(len(r), np.int32)),
                         np.append(key[first], spread), np.append(content[first], np.zeros(len(r), np.int64)),
                         np.append(rid[first], r), np.append(start[first], s), np.append(n[first], m))
    return run


def _batch(kind, key, content, rid, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), pa.array(key), pa.array(content), pa.array(rid),
         pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
        names=["kind", "key", "content", "rid", "start", "n"])


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, content and place: mark repeats, keep what needs sorting.

    Kind 1: repeats.  Kind 2: runs to sort together under their key.  Kind 3:
    runs of a key with more than ``BIG`` different ones.  Of the key that a batch
    ends in, at most ``BIG`` runs are held for the next.
    """
    held, big = None, False  # big: the held key's runs are out already, but for marking its repeats

    def emit(kind, part):
        key, content, rid, start, n = part
        return _batch(np.full(len(key), kind), key, content, rid, start, np.abs(n))

    def step(cols, last):
        nonlocal held, big
        old = 0 if held is None else len(held[0])
        key, content, rid, start, n = [np.concatenate(x) for x in zip(held, cols)] if old else cols
        if not len(key):
            return
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        rep = new_key.copy()
        rep[1:] |= content[1:] != content[:-1]
        again = np.flatnonzero(~rep)
        if len(again):
            r, s, m = _joined(rid[again], start[again], np.abs(n[again]))
            yield emit(1, (np.zeros(len(r), np.int64), np.zeros(len(r), np.int64), r, s, m))
        at = np.flatnonzero(rep)
        group = np.cumsum(new_key[at]) - 1
        count = np.bincount(group)
        odd = np.bincount(group, n[at] < 0) > 0
        out = at >= old if big else np.ones(len(at), bool)   # not given out yet
        kind = np.where(count > BIG, 3, np.where((count > 1) | odd, 2, 0))
        if big:
            kind[0] = 3
        open_ = np.zeros(len(count), bool)
        if not last:
            open_[-1] = kind[-1] != 3
        for k in (2, 3):
            pick = at[(kind[group] == k) & ~open_[group] & out]
            if len(pick):
                yield emit(k, (key[pick], content[pick], rid[pick], start[pick], n[pick]))
        if last:
            return
        keep = at[group == group[-1]]
        big = bool(kind[-1] == 3)
        keep = keep[-1:] if big else keep
        held = [x[keep].copy() for x in (key, content, rid, start, n)]

    for batch in batches:
        kind, *cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        cols = [c.astype(np.int64) for c in cols]
        done = kind == 1
        if done.any():
            yield emit(1, [c[done] for c in cols])
        yield from step([c[~done] for c in cols], False)
    if held is not None:
        yield from step([np.zeros(0, np.int64)] * 5, True)


def _fetch(length: int):
    """Give runs their bytes; runs of kind 3 go window by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off, _ = texts(batch.column(1))
            ids, raw = batch.column(0).to_pylist(), data.tobytes()
            lists = batch.column(2)
            at = np.asarray(lists.offsets) if len(lists) else np.zeros(1, np.int64)
            items = lists.flatten()
            at = at - at[0]
            key, start, n, kind = (items.field(i).to_pylist() for i in range(4))
            out: list = []

            def flush():
                cols = list(zip(*out)) or [[]] * 5
                out.clear()
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["key", "rid", "start", "n", "piece"])

            for i, rid in enumerate(ids):
                for j in range(int(at[i]), int(at[i + 1])):
                    s = int(off[i]) + start[j]
                    if kind[j] == 2:
                        out.append((key[j], rid, start[j], n[j], raw[s:s + n[j] + length - 1]))
                    else:
                        for w in range(n[j]):
                            piece = raw[s + w:s + w + length]
                            out.append((xxhash.xxh64_intdigest(piece, 7) - (1 << 63), rid, start[j] + w, 1, piece))
                    if len(out) >= 20_000:
                        yield flush()
            if out:
                yield flush()
    return run


# --- deep-shallow sorting ------------------------------------------------

def _prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    if a == b:
        return len(a)
    low, high = 0, len(a)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Sorted order of ``strings`` (one length): classes of equal ones, smallest first.

    An inner node is ``[depth, {byte: child}]``, a leaf ``[-1, members]``.
    Insertion first walks down by single bytes to some leaf, compares with it
    once, and then walks to the place where the strings part.
    """
    root: list = [-1, [0]]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while node[0] >= 0:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        old = strings[node[1][0]]
        p = _prefix(s, old)
        if p == len(s):
            node[1].append(i)
            continue
        above, node, byte = None, root, None
        while 0 <= node[0] < p:
            byte = s[node[0]]
            above, node = node, node[1][byte]
        if node[0] == p:
            node[1][s[p]] = [-1, [i]]
            continue
        split = [p, {old[p]: node, s[p]: [-1, [i]]}]
        if above is None:
            root = split
        else:
            above[1][byte] = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node[0] < 0:
            out.append(node[1])
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def equal_to_earlier(buffer: np.ndarray, pos: np.ndarray, group: np.ndarray, rank: np.ndarray,
                     length: int = LENGTH) -> np.ndarray:
    """Mark suffixes whose first ``length`` bytes equal those of one of lower rank in their group."""
    padded = np.concatenate((buffer, np.zeros(8, np.uint8)))
    words = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    live, cls = np.arange(len(pos)), group
    for depth in range(0, SHALLOW, 8):      # multikey quicksort: eight bytes a step
        value = words[pos[live] + depth].astype(np.uint64)
        order = np.lexsort((value, cls))
        live, cls, value = live[order], cls[order], value[order]
        new = np.ones(len(live), bool)
        new[1:] = (cls[1:] != cls[:-1]) | (value[1:] != value[:-1])
        cls = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        live, cls = live[~alone], cls[~alone]
    later = np.zeros(len(pos), bool)
    if not len(live):
        return later
    raw = buffer.tobytes()
    bounds = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1], [True]))).tolist()
    live_list, at, order = live.tolist(), (pos[live] + SHALLOW).tolist(), rank[live].tolist()
    rest = length - SHALLOW
    for a, b in zip(bounds, bounds[1:]):    # groups with a longer common prefix: blind tries
        for same in blind_trie([raw[p:p + rest] for p in at[a:b]]):
            if len(same) > 1:
                first = min(same, key=lambda i: order[a + i])
                for i in same:
                    if i != first:
                        later[live_list[a + i]] = True
    return later


def _sorted_repeats(key, rid, start, n, pieces, length):
    """``(rid, start, windows)`` of the windows that repeat an earlier one of their key."""
    size = np.array([len(p) for p in pieces], np.int64)
    buffer = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.cumsum(size) - size
    of = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    place = start[of] + step
    rank = np.empty(len(of), np.int64)
    rank[np.lexsort((place, rid[of]))] = np.arange(len(of))
    change = np.concatenate(([0], key[1:] != key[:-1])).cumsum()
    later = equal_to_earlier(buffer, base[of] + step, change[of], rank, length)
    return _joined(rid[of[later]], place[later], np.ones(int(later.sum()), np.int64))


def _sort(length: int, most: int = 4 << 20):
    """Rows sorted by key: sort each key's suffixes, about ``most`` bytes of whole keys at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(cols, pieces):
            r, s, m = _sorted_repeats(*cols, pieces, length)
            return pa.RecordBatch.from_arrays([pa.array(r), pa.array(s.astype(np.int32)), pa.array(m.astype(np.int32))],
                                              names=["rid", "start", "n"])

        cols, pieces, size = None, [], 0
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            got = batch.column(4).to_pylist()
            size += sum(map(len, got))
            cols = new if cols is None else [np.concatenate(x) for x in zip(cols, new)]
            pieces += got
            if size < most or not len(pieces):
                continue
            whole = np.flatnonzero(cols[0] != cols[0][-1])
            if len(whole):
                cut = int(whole[-1]) + 1
                yield emit([c[:cut] for c in cols], pieces[:cut])
                cols, pieces = [c[cut:] for c in cols], pieces[cut:]
                size = sum(map(len, pieces))
        if pieces:
            yield emit(cols, pieces)
    return run


def _finish(length: int):
    """Cut the marked windows' bytes out of each text and describe what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off, _ = texts(batch.column(1))
            raw, out = data.tobytes(), []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                a, b, kept = int(off[i]), int(off[i + 1]), hashlib.sha256()
                count = removed = 0
                done = a
                for s in sorted((x["start"], x["start"] + x["n"] + length - 1) for x in spans or []):
                    s0, s1 = a + s[0], a + s[1]
                    if s0 > done or (s0 == a and not count):
                        kept.update(raw[done:s0])
                        count += 1
                        removed += s1 - s0
                        done = s1
                    elif s1 > done:
                        removed += s1 - done
                        done = s1
                kept.update(raw[done:b])
                out.append((b - a, removed, count, kept.hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def identified_rows(docs: DataFrame) -> DataFrame:
    """``(rid, doc_id, text)`` with unique ``rid`` in the order of ``doc_id``.

    Where ids are unique and not NULL they serve; else rows are numbered by id
    (NULL first) and the hash of their text, so that each counts as a document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    repeated = rows.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if repeated.isEmpty():
        return rows.select(F.col("doc_id").alias("rid"), "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return global_order(rows, order, "rid", "suffix-rows").select("rid", "doc_id", "text")


def repeated_runs(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(rid, start, n)``: runs of windows that also start earlier in the corpus."""
    spark = rows.sparkSession
    heavy = spark.sparkContext.broadcast(heavy_keys(rows, length))
    runs = rows.select("rid", "text").mapInArrow(_extract(length, heavy), _ROW)
    dealt = runs.repartition("key").sortWithinPartitions("key", "content", "rid", "start")
    pruned = materialize(dealt.mapInArrow(_prune, _ROW), "suffix-runs")
    wanted = (pruned.where("kind > 1").groupBy("rid")
              .agg(F.collect_list(F.struct("key", "start", "n", "kind")).alias("runs")))
    fetched = (rows.select("rid", "text").join(wanted, "rid")
               .mapInArrow(_fetch(length), "key long, rid long, start int, n int, piece binary"))
    sorted_ = (fetched.repartition("key").sortWithinPartitions("key")
               .mapInArrow(_sort(length), "rid long, start int, n int"))
    return pruned.where("kind = 1").select("rid", "start", "n").union(sorted_)


def substring_deduplication(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    NULL text is empty; texts under ``length`` bytes lose nothing.  Of rows with
    one id, or none, those with the smaller text hash count as earlier; a row
    repeated whole is a document that repeats an earlier one.
    """
    if length < max(GRAM, SHALLOW):
        raise ValueError(f"length must be at least {max(GRAM, SHALLOW)}")
    rows = identified_rows(docs)
    marked = repeated_runs(rows, length)
    marked = marked.groupBy("rid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return rows.join(marked, "rid", "left").select("doc_id", "text", "spans").mapInArrow(
        _finish(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def brute_force(rows: list[tuple[int, str | None]], length: int = LENGTH) -> list[tuple]:
    """Reference for tests: every window in order, in one dictionary."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
