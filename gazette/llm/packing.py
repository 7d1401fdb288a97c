"""Packing of documents into sequences by vector best fit.

A piece of a document asks for tokens, one document place and attention cost
(the square of its length); a sequence offers a capacity of each.  Pieces go in
order of falling length.  Each takes, of the open sequences that have room in
every capacity, the one that the rule selects: the least weighted norm of what
would be left (``norm``), or the least weighted dot product of the piece with
the room (``dot``).  Without such a sequence a new one is opened.

What a piece asks for follows from its length alone, so the choices are made on
counts: a table of lengths, which has one row per length whatever the corpus,
and classes of equally filled sequences.  Both rules go on filling a sequence
once it is chosen, so a class is filled one sequence after the other and a step
settles any number of equal pieces.  The driver sees the table of lengths and
makes a plan of patterns from it; Spark tokenizes the texts, counts, and gives
each piece its place by its rank among the pieces of its length.  Ranks are
counted within tasks and shifted by the counts of the tasks before: nothing is
sorted, and texts are not shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize

CAPACITY = 1024
END = 2                              # id after each document
WEIGHTS = (1.0, 0.001, 0.001)        # of tokens, documents and attention cost, as shares of the capacity
SLAB = 1 << 22                       # characters tokenized at once; one longer text is a slab of its own
CACHE = 1 << 19                      # distinct chunks whose ids a task remembers
_LONGEST = 64                        # characters of a chunk that is joined with others for a call
_JOIN = 1 << 13                      # chunks joined for a call
_PLACE = 40                          # bits of a rank within a length

# Between two visible characters a space starts a new word of the tokenizer's pattern, which takes one space
# with the word after it, and a line end is a word of its own; so the ids of a text are those of its chunks.
_CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
# A letter and a sign after it never share a word of the pattern.
_STOP = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u047f])([.,;:!?])"


def regular(text: str) -> bool:
    """Whether every space and line end of a text lies between two visible characters."""
    flat = text.replace("\n", " ")
    return flat.isprintable() and "  " not in flat and flat.strip(" ") == flat


def chunks(text: str, plain: bool) -> str | list[str]:
    """Keys of the chunks of a text: a word for the space and the word, ``\\0`` and the chunk for others.

    Those of a regular text (``plain``) are returned joined by spaces, signs still at their words.
    """
    if plain:
        return "\0" + text.replace("\n", " \0\n \0")
    return ["\0" + c for c in _CUT.split(text)]


class Ids:
    """Token ids of texts; each distinct chunk is tokenized once while it is remembered."""

    def __init__(self, model: str, end: int):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_str(model)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end = end
        # many chunks go into one call, cut again at ids that hold a space in front, or at line ends
        tokens = self.model.get_vocab()
        self.spaced, self.line = np.zeros((2, max(tokens.values(), default=0) + 1), bool)
        self.spaced[[i for t, i in tokens.items() if t[0] == "\u0120"]] = True
        line = self.model.encode("\n", add_special_tokens=False).ids
        self.line[line] = len(line) == 1
        self.known: dict[str, int] = {}
        self.ids = np.full(1, end, np.uint32)           # chunk 0 is the end of a document
        self.starts, self.sizes, self.uses = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int64)

    def _forget(self):
        """Keep the chunks that came up most often, at most half of what may be remembered."""
        keep = np.argsort(-self.uses[1:], kind="stable")[:CACHE // 2] + 1
        keep = np.sort(keep[self.uses[keep] > 1])
        place = np.zeros(len(self.uses), np.int64)
        place[keep] = np.arange(1, len(keep) + 1)
        self.known = {k: n for k, n in zip(self.known, place[list(self.known.values())].tolist()) if n}
        keep = np.append(0, keep)
        sizes = self.sizes[keep]
        stops = np.cumsum(sizes)
        self.ids = self.ids[np.repeat(self.starts[keep] - stops + sizes, sizes) + np.arange(stops[-1])]
        self.starts, self.sizes, self.uses = stops - sizes, sizes, self.uses[keep] // 2

    def _add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray):
        base = len(self.starts)
        self.known.update(zip(chunks, range(base, base + len(chunks))))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.uses = np.concatenate((self.uses, np.zeros(len(sizes), np.int64)))
        self.ids = np.concatenate((self.ids, ids))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, keys: list[str], text: str, marks: np.ndarray, held: int) -> list[str]:
        """Learn ``keys`` from one text; ``marks`` are the ids between chunks, or (``held`` = 1) at their start."""
        ids = self._encode([text])[0]
        stops = np.append(np.flatnonzero(marks[ids]), len(ids))
        if len(stops) != len(keys) + held or held and stops[0]:
            return keys  # another kind of tokenizer: one by one
        sizes = np.diff(stops) if held else np.diff(stops, prepend=-1) - 1
        self._add(keys, ids if held else ids[~marks[ids]], sizes)
        return []

    def _learn(self, keys: list[str]):
        alone = [k for k in keys if len(k) > _LONGEST or " " in k or not k.lstrip("\0").isprintable() or k == "\0"]
        plain = list(set(keys).difference(alone))
        spaced = [k for k in plain if k[0] != "\0"]
        first = [k for k in plain if k[0] == "\0"]
        for a in range(0, len(spaced), _JOIN):
            some = spaced[a:a + _JOIN]
            alone += self._joined(some, " " + " ".join(some), self.spaced, 1)
        for a in range(0, len(first), _JOIN):
            some = first[a:a + _JOIN]
            alone += self._joined(some, "\n".join([k[1:] for k in some]), self.line, 0)
        if alone:
            found = self._encode([k[1:] if k[0] == "\0" else " " + k for k in alone])
            self._add(alone, np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))

    def documents(self, texts: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: the ids of all texts, the end id after each, and where each text starts.

        ``plain`` says that all texts are regular.
        """
        if len(self.known) > CACHE:
            self._forget()
        keys = pa.array([chunks(t, plain) for t in texts], pa.large_string() if plain else pa.large_list(pa.large_string()))
        if plain:
            keys = pc.split_pattern(pc.replace_substring_regex(keys, _STOP, "\\1 \0\\2"), " ")
        each = keys.flatten().dictionary_encode()
        distinct = each.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [k for k in distinct if k not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        stops = np.asarray(keys.offsets)[1:] - keys.offsets[0].as_py() + np.arange(1, len(texts) + 1)
        at = np.zeros(stops[-1], np.int64)      # chunk 0 ends a document
        inside = np.ones(len(at), bool)
        inside[stops - 1] = False
        at[inside] = number[each.indices.to_numpy()]
        self.uses += np.bincount(at, minlength=len(self.uses))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends[stops - 1]))


class Vocabulary:
    """A tokenizer file, sent to the workers; each worker process loads it once and keeps its chunks."""

    def __init__(self, model: str):
        self.model, self.made = model, {}

    def __getstate__(self):
        return {"model": self.model, "made": {}}

    def ids(self, end: int) -> Ids:
        if end not in self.made:
            self.made[end] = Ids(self.model, end)
        return self.made[end]


def cut(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(document, piece, start, length)`` of the pieces: all of ``longest`` but perhaps the first."""
    n = np.maximum(-(-lengths // longest), 1)
    doc = np.repeat(np.arange(len(lengths)), n)
    piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    head = lengths - (n - 1) * longest
    start = np.where(piece == 0, 0, head[doc] + (piece - 1) * longest)
    return doc, piece, start, np.where(piece == 0, head[doc], longest)


def _slabs(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str], bool]]:
    """Places and texts of at most ``SLAB`` characters (or one text), regular ones apart from the others."""
    for plain in (True, False):
        places, size = [], 0
        for i, t in enumerate(texts):
            if regular(t) is not plain:
                continue
            if places and size + len(t) > SLAB:
                yield np.array(places), [texts[j] for j in places], plain
                places, size = [], 0
            places.append(i)
            size += len(t)
        if places:
            yield np.array(places), [texts[j] for j in places], plain


def _pieces(model, end: int, longest: int, with_ids: bool, names: list[str]):
    """A task: pieces of each text (the first column), with its part and their ranks by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = model.value.ids(end), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)
        for batch in batches:
            texts = batch.column(0).fill_null("").to_pylist()
            for places, some, plain in _slabs(texts):
                ids, off = encode.documents(some, plain)
                doc, piece, start, size = cut(np.diff(off), longest)
                at = off[doc] + start
                crc = [zlib.crc32(ids[s:s + n]) for s, n in zip(at.tolist(), size.tolist())]
                order = np.argsort(size, kind="stable")
                kinds, head, count = np.unique(size[order], return_index=True, return_counts=True)
                rank = np.empty(len(size), np.int64)
                rank[order] = np.arange(len(size)) - np.repeat(head, count) + seen[size[order]]
                seen[kinds] += count
                cols = [c.take(pa.array(places[doc])) for c in batch.columns[1:]]
                cols += [pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                         pa.array(np.full(len(size), part), pa.int32()), pa.array(rank)]
                if with_ids:  # pieces of a slab lie one after the other
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()),
                                                         pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def best_fit(counts: dict[int, int], capacities: tuple[int, int, int], rule: str = "norm",
             weights: tuple[float, float, float] = WEIGHTS) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(sequences, [(length, pieces of that length in each)])`` of a vector best-fit packing.

    ``counts`` holds the number of pieces of each length.  Ties go to the class
    of sequences that exists longest.
    """
    cap = np.array(capacities, np.float64)
    w = np.array(weights, np.float64)
    left = np.zeros((0, 3), np.int64)     # room of each class
    held: list[list[tuple[int, int]]] = []
    number: list[int] = []
    done = []

    def fill(room, n, pieces, want):
        """``(sequences, pieces in each)`` made of ``n`` sequences of one class, and the pieces spent."""
        t = int((room // want).min())
        full = min(n, pieces // t)
        rest = min(pieces - full * t, t) if full < n else 0
        return [(c, k) for c, k in ((full, t), (1, rest)) if c and k], full * t + rest

    for size in sorted((s for s, c in counts.items() if c), reverse=True):
        pieces, want = counts[size], np.array([size, 1, size * size], np.int64)
        if (want > np.array(capacities)).any():
            raise ValueError(f"a piece of {size} tokens fits no sequence")
        while pieces:
            ok = np.flatnonzero((left >= want).all(axis=1))
            if len(ok):
                after = ((left[ok] - want) / cap) ** 2 @ w if rule == "norm" else (left[ok] / cap) @ (w * (want / cap))
                j = int(ok[np.argmin(after)])
                room, content, n = left[j], held[j], number[j]
            else:
                room, content = np.array(capacities, np.int64), []
                n = -(-pieces // int((room // want).min()))
            made, spent = fill(room, n, pieces, want)
            pieces -= spent
            if len(ok):
                number[j] -= sum(c for c, _ in made)
                if not number[j]:
                    left = np.delete(left, j, axis=0)
                    del held[j], number[j]
            for c, t in made:
                rest, full = room - want * t, content + [(size, t)]
                if (rest > 0).all():
                    left = np.concatenate((left, rest[None]))
                    held.append(full)
                    number.append(c)
                else:
                    done.append((c, full))
    return done + list(zip(number, held))


def _places(plan: list) -> np.ndarray:
    """Rows ``(key, pieces in a sequence, first sequence, offset)`` by length and rank, for lookups."""
    used, out, first = {}, [], 0
    for n, content in plan:
        offset = 0
        for size, t in content:
            out.append(((size << _PLACE) + used.get(size, 0), t, first, offset))
            used[size] = used.get(size, 0) + n * t
            offset += size * t
        first += n
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def _placed(places, names: list[str], size: int, rank: int):
    """A task: the sequence and the offset of each piece; ``size`` and ``rank`` are column places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, t, first, offset = places.value.T
        for batch in batches:
            n = np.asarray(batch.column(size))
            at = (n << _PLACE) + np.asarray(batch.column(rank))
            i = np.searchsorted(key, at, side="right") - 1
            y = at - key[i]
            cols = [c for k, c in enumerate(batch.columns) if k != rank]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(first[i] + y // t[i]), pa.array(offset[i] + y % t[i] * n)],
                                             names=names)
    return run


def vocabulary(path: str | None = None) -> str:
    """A tokenizer file as text, read where the driver runs and sent to the tasks."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pack_documents(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None,
                   capacity: int = CAPACITY, most_docs: int | None = None, most_cost: int | None = None,
                   rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    Returns the columns ``keep`` and ``piece`` (from 0), ``start`` (ids of the
    document before it), ``length``, ``ids_crc32`` (of the little-endian 32-bit
    ids), ``sequence_id``, ``offset`` (place in the sequence, gapless from 0);
    with ``with_ids`` also ``ids``.  A sequence holds at most ``capacity``
    tokens, ``most_docs`` pieces and ``most_cost`` of summed squared lengths
    (by default what ``capacity`` allows anyway).  Only documents longer than a
    sequence may hold are cut, into pieces of that length; the first may be
    shorter.

    A NULL text counts as empty and is one piece of the end id alone.  Rows
    that repeat or share an id are documents each; ids may be NULL.  A very long
    text is tokenized whole.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    most_docs = capacity if most_docs is None else most_docs
    most_cost = capacity * capacity if most_cost is None else most_cost
    longest = min(capacity, isqrt(most_cost))
    if min(longest, most_docs) < 1:
        raise ValueError("a sequence must have room for a piece")
    own = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    taken = docs.select(*keep)
    if {c.lower() for c in keep} & {*own, "ids"}:
        raise ValueError(f"rename kept columns that are called like the results {own}")
    part, rank, before = (fresh(taken, n) for n in ("_part", "_rank", "_before"))
    model = spark.sparkContext.broadcast(Vocabulary(vocabulary(path)))
    kinds = [f"`{c}` {t}" for c, t in taken.dtypes]
    names = [*keep, *own[:4], part, rank] + (["ids"] if with_ids else [])
    kinds += ["piece int", "start long", "length long", "ids_crc32 long", f"{part} int", f"{rank} long"]
    pieces = docs.select(F.col(text).cast("string").alias(fresh(taken, "_text")), *keep).mapInArrow(
        _pieces(model, end, longest, with_ids, names), ", ".join(kinds + (["ids array<int>"] if with_ids else [])))
    pieces = materialize(pieces, "packing-pieces")
    counts = materialize(pieces.groupBy(part, "length").agg(F.count(F.lit(1)).alias(before)), "packing-counts")
    table = counts.groupBy("length").agg(F.sum(before).alias("n")).collect()  # one row per length: at most `longest`
    plan = best_fit({r["length"]: r["n"] for r in table}, (capacity, most_docs, most_cost), rule, weights)
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    ranked = pieces.join(starts, [part, "length"]).withColumn(rank, F.col(rank) + F.col(before))
    cols = [*keep, *own[:4]] + (["ids"] if with_ids else []) + [rank]
    ranked = ranked.select(*cols)
    out = [f"`{c}` {t}" for c, t in ranked.dtypes if c != rank] + ["sequence_id long", "offset long"]
    task = _placed(spark.sparkContext.broadcast(_places(plan)), [c for c in cols if c != rank] + own[4:],
                   cols.index("length"), cols.index(rank))
    return ranked.mapInArrow(task, ", ".join(out))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, lengths)`` of pieces packed with their ids: one row per sequence."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("held"))
    return rows.select("sequence_id", F.flatten("held.ids").alias("ids"),
                       F.transform("held", lambda h: F.size(h["ids"])).alias("lengths"))


def packed_documents(docs: DataFrame) -> DataFrame:
    """All documents packed into sequences of at most ``CAPACITY`` tokens, by ``doc_id``."""
    return pack_documents(docs, ["doc_id"])
