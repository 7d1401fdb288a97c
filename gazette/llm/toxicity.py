"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

1. A lexicon is learned from labelled texts: words and word beginnings (stems)
   whose rate in toxic texts is many times that in clean ones, with the log of
   that ratio as weight.  A term needs as many texts as chance does not explain,
   however large the sample.
2. Its whole words form a trie.  The Levenshtein automaton of a text's word is
   run through the trie, so all terms within the allowed distance come out of
   one walk.  Words met in clean labelled texts are never taken for
   misspellings.  Of a term one edit away the beginning or the ending is intact
   (two edits: a third of it); an index of such parts tells which words can
   match, and the walk follows only branches that lead to terms with a part of
   the word.
3. Every hit is weighed by the window around it: quotation marks on both sides
   or a reporting word before it speak for quotation, an address to a person
   for abuse.  The windows' sums, the share of the text and the number of
   different terms are the features.
4. Boosted lookup tables turn the features into a probability.

Texts are read in place by vectorised steps; Python walks only candidates.  The
sample is bounded by ``FIT_ROWS``, and the lexicon holds every term of it that
passes the tests.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, slabs, texts
from .labelled import fit_labels, held_out, one_each
from .quality import additive_score, fit_additive
from .tokens import SLAB, Tokenizer, ascii_lower, marked

FEATURES = ("abuse", "share", "window", "terms", "misspelled", "quoted", "log_words")
THRESHOLD = 0.5
FIT_ROWS = 10_000       # labelled texts to learn from
STEM = (4, 8)           # characters of a stem
LEAST_RATIO = 8.0       # of a term's rates in toxic and clean texts
LEAST_TEXTS = 4         # toxic texts with the term
LEAST_SURPRISE = 13.8   # nats: odds of one in a million that chance puts the term's texts among the toxic
PER_TEXT = 5            # occurrences counted per text when learning
NEAR, WIDE = 8, 15      # words before a hit that are read; words of a window to either side
MISSPELLED, QUOTED, REPORTED, ADDRESSED = 0.4, 0.25, 0.6, 1.2
CACHE = 200_000

# Quotation marks, reporting words and words of address.
QUOTES = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("»", "«"), ("‘", "’"), ("‹", "›"))
REPORTING = frozenset("said says say called calls wrote writes quote quoted quotes term word reported claimed "
                      "sagte sagt nannte schrieb zitat wort dit disait écrit appelé mot dijo dice llamó "
                      "escribió palabra".split())
ADDRESS = frozenset("you your yours u du dich dein ihr euch tu toi vous ton tú ti usted vosotros".split())


def tokenizer() -> Tokenizer:
    return Tokenizer(marked((48, 57), (65, 90), (97, 122), (128, 255)), ascii_lower())


def _lowered(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    parts = [raw[a:b].decode("utf-8", "replace").lower().encode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return (np.frombuffer(b"".join(parts), np.uint8),
            np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))))


def allowed(length: int) -> int:
    """Edits that a term of so many characters may differ by."""
    return 0 if length < 4 else 1 if length < 12 else 2


# --- the automaton -------------------------------------------------------

def build_trie(terms: list[str]) -> dict:
    """Nodes are dicts by character; ``""`` holds the term that ends there, ``None`` a bit set of the terms below."""
    root: dict = {None: 0}
    for i, t in enumerate(terms):
        node = root
        for ch in t:
            node[None] |= 1 << i
            node = node.setdefault(ch, {None: 0})
        node[None] |= 1 << i
        node[""] = t
    return root


def within(word: str, trie: dict, k: int, only: int = -1) -> list[tuple[str, int]]:
    """Terms of ``trie`` within ``k`` edits of ``word``, with their distances.

    The Levenshtein automaton of the word and the trie are walked together.  Its
    states are pairs (characters of the word read, edits made), held as one bit
    set of characters per number of edits; a branch ends when no state is left, or
    when none of the terms in the bit set ``only`` lies below.
    """
    n, found = len(word), []
    masks: dict = {}
    for i, ch in enumerate(word):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << n + 1) - 1
    todo = [(trie, tuple((1 << e + 1) - 1 & full for e in range(k + 1)))]
    while todo:
        node, state = todo.pop()
        for ch, below in node.items():
            if ch is None:
                continue
            if ch == "":
                ends = next((e for e, bits in enumerate(state) if bits >> n & 1), None)
                if ends is not None:
                    found.append((below, ends))
                continue
            if not below[None] & only:
                continue
            mask = masks.get(ch, 0)
            new = [(state[0] & mask) << 1]
            for e in range(1, k + 1):  # read; extra term character; another character; skipped one
                new.append(((state[e] & mask) << 1 | state[e - 1] | state[e - 1] << 1 | new[-1] << 1) & full)
            if new[-1]:
                todo.append((below, tuple(new)))
    return found


# --- learning the lexicon ------------------------------------------------

def term_counts(fit: DataFrame) -> DataFrame:
    """``(term, stem, toxic, clean, toxic_texts, clean_texts)`` from rows ``(label, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}

        def flush():
            rows = [(t, s, *c) for (t, s), c in total.items()]
            total.clear()
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)],
                names=["term", "stem", "toxic", "clean", "toxic_texts", "clean_texts"])

        find = tokenizer()
        for batch in batches:
            data, off, _ = texts(batch.column(1))
            for i, label in enumerate(batch.column(0).to_pylist()):
                low, o = _lowered(data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                raw = low.tobytes()
                start, end, _, _ = find.words(low, o)
                counts: Counter = Counter()
                for w, c in Counter(raw[s:e].decode() for s, e in zip(start.tolist(), end.tolist())).items():
                    counts[w, False] += c
                    for m in range(STEM[0], min(STEM[1], len(w) - 1) + 1):
                        counts[w[:m], True] += c
                for key, c in counts.items():
                    got = total.setdefault(key, [0, 0, 0, 0])
                    got[0 if label else 1] += min(c, PER_TEXT)
                    got[2 if label else 3] += 1
                if len(total) > CACHE:
                    yield flush()
        yield flush()

    counts = fit.select("label", "text").mapInArrow(
        run, "term string, stem boolean, toxic long, clean long, toxic_texts long, clean_texts long")
    names = ("toxic", "clean", "toxic_texts", "clean_texts")
    return counts.groupBy("term", "stem").agg(*[F.sum(c).alias(c) for c in names])


def surprise(toxic: Column, clean: Column, share: float) -> Column:
    """Nats by which ``toxic`` of ``toxic + clean`` texts exceed their ``share`` (Chernoff's bound of the tail)."""
    n = F.greatest(toxic + clean, F.lit(1))
    nats = F.when(toxic > 0, toxic * F.log(toxic / (n * share))).otherwise(0.0)
    nats = nats + F.when(clean > 0, clean * F.log(clean / (n * (1 - share)))).otherwise(0.0)
    return F.when(toxic > n * share, nats).otherwise(0.0)


def learn_lexicon(fit: DataFrame) -> dict:
    """``words`` and ``stems`` with weights, and ``known``: clean words near a term."""
    size = fit.groupBy("label").agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).collect()
    size = {r[0]: (r[1], max(float(r[2] or 0), 1.0)) for r in size}
    if not size.get(0) or not size.get(1):
        return {"words": {}, "stems": {}, "known": []}
    counts = materialize(term_counts(fit), "toxic-terms")
    share = size[1][0] / (size[0][0] + size[1][0])
    rate = ((F.col("toxic") + 0.1) / size[1][1]) / ((F.col("clean") + 0.1) / size[0][1])
    near = counts.where((F.col("toxic_texts") >= LEAST_TEXTS) & (
        surprise(F.col("toxic_texts"), F.col("clean_texts"), share) >= LEAST_SURPRISE))
    near = near.withColumn("ratio", rate).where(F.col("ratio") >= LEAST_RATIO)
    rows = near.orderBy(F.desc("toxic_texts"), F.desc("ratio"), "term", "stem").collect()  # terms of a bounded sample

    def weight(toxic: float, clean: float) -> float:
        return float(np.log(((max(toxic, 0) + 0.1) / size[1][1]) / ((max(clean, 0) + 0.1) / size[0][1])))

    words = {r.term: r for r in rows if not r.stem}
    stems: dict = {}
    for r in sorted((r for r in rows if r.stem), key=lambda r: (len(r.term), r.term)):
        if any(r.term.startswith(s) for s in stems):
            continue
        inside = [w for t, w in words.items() if t.startswith(r.term)]
        toxic, clean = r.toxic - sum(w.toxic for w in inside), r.clean - sum(w.clean for w in inside)
        rest = r.toxic_texts - max([w.toxic_texts for w in inside], default=0)
        if rest >= max(LEAST_TEXTS, LEAST_SURPRISE / -np.log(share)) and weight(toxic, clean) >= np.log(LEAST_RATIO):
            stems[r.term] = weight(toxic, clean)
    plain = {t: weight(r.toxic, r.clean) for t, r in words.items()}
    # the ratio weighs clean use: quoted terms are looked for misspelled too
    spelled = sorted(t for t in plain if allowed(len(t)))
    lexicon = {"words": plain, "stems": dict(sorted(stems.items())), "spelled": spelled, "known": []}

    def clean_near(batches):
        finder = Finder(lexicon)
        for batch in batches:
            data, off, _ = texts(batch.column(0))
            at = finder.candidates(data, off[:-1], off[1:]) if len(data) else []
            near = [data[off[i]:off[i + 1]].tobytes().decode() for i in at]
            got = [w for w in near if finder.near(w)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], names=["term"])

    seen = counts.where(~F.col("stem") & (F.col("clean_texts") > 0) & (F.length("term") >= 3)).select("term")
    # words within two edits of a bounded lexicon, from a bounded sample
    known = [r[0] for r in seen.mapInArrow(clean_near, "term string").collect()] if spelled else []
    return lexicon | {"known": known}


def near_terms(word: str, trie: dict, only: int = -1) -> list[tuple[str, int]]:
    """Terms that ``word`` misspells: within the edits allowed for the term, not equal."""
    k = allowed(len(word) + 1)
    return [(t, d) for t, d in within(word, trie, k, only) if 0 < d <= allowed(len(t))] if k else []


# --- scoring -------------------------------------------------------------

class Finder:
    """Finds the lexicon's terms in slabs of lower-cased text."""

    def __init__(self, lexicon: dict):
        self.words, self.stems = lexicon["words"], lexicon["stems"]
        self.known = set(lexicon["known"])
        spelled = lexicon.get("spelled", [])
        self.trie = build_trie(spelled)
        bits = {t: 1 << i for i, t in enumerate(spelled)}
        self.lengths = sorted({len(s) for s in self.stems})
        # a word of these bytes and this length may match: a term's first four bytes,
        # or for a misspelling one part intact of its edits + 1 parts
        self.heads, self.tails, self.middle = {}, {}, []
        # the same parts whole, with a bit set of their terms, by length in characters of words that may hold them
        self.parts: dict = {}
        for t in self.words:
            raw = t.encode()
            self._mark(self.heads, raw[:4], len(raw), len(raw))
        for t in self.stems:
            self._mark(self.heads, t.encode()[:4], 0, 63)
        for t in spelled:
            k, raw = allowed(len(t)), t.encode()
            # an edit changes four bytes at most: the longest character of UTF-8
            part, low, high = len(t) // (k + 1), len(raw) - 4 * k, len(raw) + 4 * k
            self._mark(self.heads, t[:part].encode()[:4], low, high)
            self._mark(self.tails, t[part if k == 1 else len(t) - part:].encode()[-4:], low, high)
            if k == 2:
                self.middle.append((t[part:len(t) - part].encode()[:4], low, high))
            cuts = [(0, part), (part, len(t))] if k == 1 else [(0, part), (part, len(t) - part), (len(t) - part, len(t))]
            for a, b in cuts:
                for shift in {0} if a == 0 else range(-k, k + 1):
                    table = self.parts.setdefault((a + shift, b + shift), {})
                    for n in range(len(t) - k, len(t) + k + 1):
                        table[t[a:b], n] = table.get((t[a:b], n), 0) | bits[t]
        self.cache: dict = {}

    @staticmethod
    def _key(raw: bytes) -> int:
        return (int.from_bytes(raw, "little") * 0x9E3779B1 & 0xFFFFFFFF) >> 16

    def _mark(self, tables: dict, raw: bytes, low: int, high: int) -> None:
        """Allow byte lengths ``low .. high`` (63 stands for all above) for words with ``raw``."""
        table = tables.setdefault(len(raw), np.zeros(1 << 16, np.uint64))
        bits = 0
        for n in range(min(max(low, 0), 63), min(high, 63) + 1):
            bits |= 1 << n
        table[self._key(raw)] |= np.uint64(bits)

    def near(self, text: str) -> list[tuple[str, int]]:
        """``near_terms`` of a word: the trie walked along terms of which it holds a part at its place."""
        n, terms = len(text), 0
        for (a, b), table in self.parts.items():
            if b <= n:
                terms |= table.get((text[a:b], n), 0)
        return near_terms(text, self.trie, terms) if terms else []

    def lookup(self, word: bytes) -> tuple[str, float, bool] | None:
        """``(term, weight, misspelled)`` of a word, if any."""
        if word in self.cache:
            return self.cache[word]
        text, got = word.decode("utf-8", "replace"), None
        if text in self.words:
            got = (text, self.words[text], False)
        else:
            stem = next((text[:m] for m in self.lengths if text[:m] in self.stems and len(text) > m), None)
            if stem:
                got = (stem, self.stems[stem], False)
            elif text not in self.known and len(text) >= 3:
                near = self.near(text)
                if near:
                    term, d = min(near, key=lambda x: (x[1], -self.words[x[0]], x[0]))
                    got = (term, self.words[term] * MISSPELLED, True)
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = got
        return got

    def candidates(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words that may match, by their first or last bytes or a middle part, and their length."""
        size = np.minimum(end - start, 63).astype(np.uint64)
        ok = np.zeros(len(start), np.uint64)
        pad = np.concatenate((low, np.zeros(4, np.uint8))).astype(np.uint32)
        for tables, last in ((self.heads, False), (self.tails, True)):
            for m, table in tables.items():
                at = np.maximum(end - m, 0) if last else start
                code = pad[at]
                for i in range(1, m):
                    code = code | pad[at + i] << np.uint32(8 * i)
                found = table[(code * np.uint32(0x9E3779B1)) >> np.uint32(16)]
                ok |= np.where(end - start >= m, found, np.uint64(0))
        some = (ok >> size & np.uint64(1)).astype(bool)
        if self.middle:
            raw = low.tobytes()
            for part, least, most in set(self.middle):
                found, at = [], raw.find(part)
                while at >= 0:
                    found.append(at)
                    at = raw.find(part, at + 1)
                w = np.maximum(np.searchsorted(start, np.array(found, np.int64), side="right") - 1, 0)
                some[w[(least <= end[w] - start[w]) & (end[w] - start[w] <= most)]] = True
        return np.flatnonzero(some)


def _context(raw: bytes, start, end, i: int, first: int, last: int, find) -> float:
    """Factor of a hit: below 1 for quotation, above 1 for an address."""
    a, b = max(first, i - NEAR), min(last, i + NEAR + 1)
    before = raw[start[a]:start[i]].decode("utf-8", "replace")
    after = raw[end[i]:end[b - 1]].decode("utf-8", "replace")
    factor = 1.0
    if any(before.count(x) > (before.count(y) if x != y else before.count(x) // 2 * 2) and y in after for x, y in QUOTES):
        factor *= QUOTED
    near = {raw[start[j]:end[j]].decode("utf-8", "replace") for j in range(a, b) if j != i}
    if any(raw[start[j]:end[j]].decode("utf-8", "replace") in REPORTING for j in range(a, i)):
        factor *= REPORTED
    return factor * ADDRESSED if near & ADDRESS else factor


def text_features(data: np.ndarray, off: np.ndarray, find: Tokenizer, finder: Finder) -> np.ndarray:
    low, off = _lowered(data, off)
    n = len(off) - 1
    out = np.zeros((n, len(FEATURES)))
    start, end, _, row = find.words(low, off)
    words = np.bincount(row, minlength=n)
    out[:, 6] = np.log1p(words)
    if not len(start):
        return out
    heads = np.searchsorted(row, np.arange(n + 1))
    raw, hits = low.tobytes(), {}
    for i in finder.candidates(low, start, end).tolist():
        got = finder.lookup(raw[start[i]:end[i]])
        if got:
            r = int(row[i])
            f = _context(raw, start, end, i, int(heads[r]), int(heads[r + 1]), find)
            hits.setdefault(r, []).append((i, got[0], got[1], f, got[2]))
    for r, found in hits.items():
        at = np.array([h[0] for h in found])
        value = np.array([h[2] * h[3] for h in found])
        run = np.concatenate(([0], np.cumsum(value)))
        window = run[np.searchsorted(at, at + WIDE, side="right")] - run[np.searchsorted(at, at - WIDE)]
        plain = sum(h[2] for h in found)
        out[r, :6] = (value.sum(), value.sum() / words[r], window.max(), len({h[1] for h in found}),
                      sum(h[2] for h in found if h[4]), max(plain - value.sum(), 0.0))
    return out


def features(docs: DataFrame, keep: list[str], lexicon: dict) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``x``: the features of the text."""
    used = [c for c in docs.columns if c in keep]
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, finder, width = tokenizer(), Finder(shared.value), len(FEATURES)
        for batch in batches:
            data, off, _ = texts(batch.column(len(used)))
            x = [text_features(data[off[a]:off[b]], off[a:b + 1] - off[a], find, finder) for a, b in slabs(off, SLAB)]
            x = np.concatenate(x) if x else np.zeros((0, width))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(used))] + [rows], names=used + ["x"])

    text = fresh(docs, "_text")
    df = docs.select(*[f"`{c}`" for c in used], F.col("text").cast("string").alias(text))
    return df.mapInArrow(run, ", ".join([f"`{c}` {t}" for c, t in df.dtypes[:-1]] + ["x array<double>"]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted`` and the features' ``abuse``.

    ``score`` is the probability of label 1 from the text alone.  NULL, empty
    and wordless texts have no hits and are scored like clean ones.  Without
    labels of both kinds every score is the smoothed share of label 1.
    Repeated rows are scored alike; an empty table gives an empty result.
    """
    ids = fit_labels(labels, "toxic", FIT_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most FIT_ROWS ids, so the broadcast is bounded
    fit = rows.join(F.broadcast(ids), "doc_id")
    fit = materialize(one_each(fit, "text").select("label", "text"), "toxic-fit")
    lexicon = learn_lexicon(fit)
    sample = features(fit, ["label"], lexicon).toPandas()
    x = np.array(sample["x"].tolist()).reshape(len(sample), len(FEATURES))
    model = fit_additive(x, sample["label"].to_numpy(np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(additive_score(shared.value, x)),
                                              pa.array(x[:, 0])], names=["doc_id", "score", "abuse"])

    out = features(rows, ["doc_id"], lexicon).mapInArrow(run, "doc_id long, score double, abuse double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "abuse")
