"""Benchmark decontamination with a broadcast set of normalised n-grams.

The words of every benchmark item give windows of ``WINDOW`` consecutive words
(a shorter item is one window).  The hashes and texts of all windows are
broadcast; each task slides over the words of its documents, looks window
hashes up, verifies every hit against the window's text, and marks the words
inside.  Nothing is shuffled.

The broadcast is bounded: windows beyond ``MAX_BYTES`` of text are dealt into
that many parts by hash, and the documents are scanned once per part, each scan
adding its hits to a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, slabs, texts
from .tokens import SLAB, Tokenizer, ascii_lower, marked

WINDOW = 10
MAX_BYTES = 64 << 20    # text of windows in one broadcast
MOST_HIT = 0.5          # a document with more of its words hit is removed whole


def tokenizer() -> Tokenizer:
    """Words of digits, ASCII letters and all non-ASCII characters, A-Z lower-cased."""
    return Tokenizer(marked((48, 57), (65, 90), (97, 122), (128, 255)), ascii_lower())


def _gram(low: np.ndarray, start, end) -> bytes:
    return b" ".join(low[s:e].tobytes() for s, e in zip(start.tolist(), end.tolist()))


def _roll(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words."""
    out = h[:len(h) - n + 1].copy()
    for i in range(1, n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += h[i:len(h) - n + 1 + i]
    return out ^ (out >> np.uint64(32))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(words, hash, gram, item)`` of the benchmark items.

    NULL and wordless items have none; a NULL id reads ``null``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = tokenizer()
        for batch in batches:
            data, off, _ = texts(batch.column(1))
            ids = ["null" if x is None else x for x in batch.column(0).to_pylist()]
            out = []
            for i in range(len(ids)):
                raw = data[off[i]:off[i + 1]]
                start, end, h, _ = find.words(raw, np.array([0, len(raw)]))
                low, n = find.lower[raw], min(window, len(start))
                if n:
                    for j, g in enumerate(_roll(h, n).view(np.int64).tolist()):
                        out.append((n, g, _gram(low, start[j:j + n], end[j:j + n]), ids[i]))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.string()))],
                names=["words", "hash", "gram", "item"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "words int, hash long, gram binary, item string").distinct()


class _Hits:
    """Looks windows up in one broadcast part."""

    def __init__(self, part):
        self.items = {}
        hashes = {}
        for words, h, gram, item in part:
            self.items.setdefault(gram, []).append(item)
            hashes.setdefault(words, set()).add(h)
        self.sorted = {n: np.sort(np.array(list(hs), np.int64).view(np.uint64)) for n, hs in hashes.items()}
        self.quick = {}
        for n, hs in self.sorted.items():
            bits = np.zeros(1 << 20, bool)
            bits[hs >> np.uint64(44)] = True
            self.quick[n] = bits

    def find(self, low, start, end, h, row):
        """``(first word, words, row, items)`` of each verified window occurrence."""
        for n, known in self.sorted.items():
            if len(h) < n:
                continue
            rolled = _roll(h, n)
            at = np.flatnonzero(self.quick[n][rolled >> np.uint64(44)])
            at = at[row[at] == row[at + n - 1]]
            near = np.minimum(np.searchsorted(known, rolled[at]), len(known) - 1)
            for i in at[known[near] == rolled[at]].tolist():
                items = self.items.get(_gram(low, start[i:i + n], end[i:i + n]))
                if items:
                    yield i, n, int(row[i]), items


def _merge(spans: list) -> list:
    out = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1] = (out[-1][0], s[1], out[-1][2], s[3])
        else:
            out.append(tuple(s))
    return out


_FOUND = pa.struct([("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))),
                    ("items", pa.list_(pa.string())), ("words", pa.int64())])
FOUND = "struct<spans:array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>,items:array<string>,words:bigint>"


def _scan(part, column: int, before: int | None, keep: list[int], names: list[str]):
    """A task: append the hits of ``part`` to those in column ``before``, if any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, hits = tokenizer(), _Hits(part.value)
        for batch in batches:
            data, off, _ = texts(batch.column(column))
            n = batch.num_rows
            spans, items, count = [[] for _ in range(n)], [set() for _ in range(n)], np.zeros(n, np.int64)
            if before is not None:
                for i, x in enumerate(batch.column(before).to_pylist()):
                    spans[i] = [(s["first"], s["last"], s["start"], s["end"]) for s in x["spans"]]
                    items[i] = set(x["items"])
            for a, b in slabs(off, SLAB):
                start, end, h, row = find.words(data, off[a:b + 1])
                base = off[a]
                low = find.lower[data[base:off[b]]]
                count[a:b] = np.bincount(row, minlength=b - a)
                head = np.searchsorted(row, np.arange(b - a))
                for i, k, r, who in hits.find(low, start - base, end - base, h, row):
                    first, zero = i - int(head[r]), int(off[a + r])
                    spans[a + r].append((first, first + k, int(start[i]) - zero, int(end[i + k - 1]) - zero))
                    items[a + r].update(who)
            found = [{"spans": [dict(zip(("first", "last", "start", "end"), s)) for s in _merge(spans[i])],
                      "items": sorted(items[i]), "words": int(count[i])} for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(found, _FOUND)], names=names)
    return run


def scan(docs: DataFrame, benchmark: DataFrame, out: str, keep: list[str] | None = None, text: str = "text",
         window: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` (columns ``keep``) with ``out``: the benchmark hits of each text.

    ``out`` holds ``spans`` (maximal runs of hit words: word range and byte
    range, ends exclusive), ``items`` (ids of items with occurring windows) and
    ``words`` (words of the text).  NULL and empty texts have no words and no
    hits; an empty benchmark gives no hits; all rows stay, repeated ones too.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(benchmark, window), "decon-windows")
    size = windows.agg(F.sum(F.octet_length("gram") + F.octet_length("item") + 24)).first()[0] or 0
    parts = max(1, -(-int(size) // max_bytes))
    dealt = F.pmod(F.col("hash"), F.lit(parts))
    keep = docs.columns if keep is None else keep
    df, before = docs, None
    for p in range(parts):
        held = [tuple(r) for r in windows.where(dealt == p).toLocalIterator()]
        held = [(w, h, bytes(g), i) for w, h, g, i in held]
        last = p == parts - 1
        cols = [c for c in df.columns if c != out]
        kept = [c for c in cols if c in keep] if last else cols
        use = [c for c in cols if c in kept or c == text]
        df = df.select(*[F.col(f"`{c}`") if c != text else F.col(f"`{c}`").cast("string").alias(c) for c in use],
                       *([out] if before else []))
        schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c in kept) + f", `{out}` {FOUND}"
        task = _scan(spark.sparkContext.broadcast(held), use.index(text), len(use) if before else None,
                     [use.index(c) for c in kept], kept + [out])
        df, before = df.mapInArrow(task, schema.lstrip(", ")), out
        if not last:
            df = materialize(df, "decon-scan")
    return df


def _hit_words(found: str):
    zero = F.lit(0).cast("long")
    return F.aggregate(F.col(f"{found}.spans"), zero, lambda acc, s: acc + s["last"] - s["first"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    df = scan(docs.select("doc_id", "text"), benchmark, "found", ["doc_id"])
    hit = _hit_words("found")
    return df.select("doc_id", F.col("found.words").alias("n_words"), hit.alias("n_hit"),
                     F.size("found.items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                     (hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, most_hit: float = MOST_HIT) -> DataFrame:
    """``docs`` without benchmark passages.

    Hit passages are cut out of the text (``n_chars`` follows); a document with
    more than ``most_hit`` of its words hit goes.  Others are unchanged.
    """
    out = fresh(docs, "_found")
    df = scan(docs, benchmark, out)
    df = df.where(_hit_words(out) <= F.col(f"{out}.words") * most_hit)
    raw = F.col("text").cast("binary")
    spans = F.col(f"{out}.spans")

    def piece(i):  # from the end of the span before i (or 0) to its start (or the end)
        a = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(spans, (i - 1).cast("int"))["end"])
        b = F.when(i == F.size(spans), F.octet_length("text").cast("long")).otherwise(F.get(spans, i.cast("int"))["start"])
        return F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string")

    kept = fresh(df, "_kept")
    df = df.withColumn(kept, F.when(F.size(spans) > 0, F.concat_ws("", F.transform(
        F.sequence(F.lit(0), F.size(spans)), piece))))
    new = {"text": F.coalesce(F.col(kept), F.col("text")), "n_chars": F.coalesce(F.length(kept), F.col("n_chars"))}
    return df.select(*[(new[c].cast(t) if c in new else F.col(f"`{c}`")).alias(c) for c, t in docs.dtypes])


def brute_force(texts_: list[str | None], items: list[tuple[str, str | None]], window: int = WINDOW) -> list[tuple]:
    """Reference for tests: the digest columns without ``doc_id``, word by word."""
    import re

    def split(x):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    wins = []
    for item, x in items:
        w = split(x)
        k = min(window, len(w))
        wins += [("null" if item is None else item, w[i:i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for x in texts_:
        w = split(x)
        hit, who = set(), set()
        for item, g in wins:
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    who.add(item)
        out.append((len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)))
    return out
