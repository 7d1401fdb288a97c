"""Quality classifier: a generalised additive model with pairwise interactions.

Each document becomes a row of numbers about its text alone.  Every feature is
cut into quantile bins and has a lookup table of one value per bin, learned by
cyclic boosting: round after round each feature in turn gets a shallow tree on
its own bins, fitted to what the others leave over.  Pairs of features whose
interaction explains most of the rest get tables over two coarser bins, learned
the same way.  A score is the sum of table entries, taken for many rows at once.

Texts are read once; features are a written table.  The fit runs on a bounded
sample (``labelled.FIT_ROWS``), the tables are a few thousand numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slabs, texts
from .labelled import fit_labels, held_out, one_each
from .tokens import SLAB, Tokenizer, ascii_lower, marked

FEATURES = ("log_bytes", "log_words", "word_bytes", "letters", "upper", "digits", "symbols", "marks", "blanks",
            "line_words", "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "short_words",
            "title_words", "plain_words")
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS, ROUNDS, RATE = 32, 8, 6, 150, 0.1

SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~!"
MARKS = b".,;:?'\"()-"


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def text_features(data: np.ndarray, off: np.ndarray, find: Tokenizer) -> np.ndarray:
    """One row of ``FEATURES`` per text; a wordless text has zeros but its sizes."""
    n = len(off) - 1
    size = np.diff(off).astype(np.float64)
    row = np.repeat(np.arange(n), np.diff(off))

    def share(table: np.ndarray) -> np.ndarray:
        return np.bincount(row[table[data]], minlength=n) / np.maximum(size, 1)

    start, end, h, of = find.words(data, off)
    words = np.bincount(of, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)

    def distinct(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((keys, rows))
        r, k = rows[order], keys[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
        at = np.flatnonzero(new)
        runs, top = np.diff(np.append(at, len(r))), np.zeros(n)
        np.maximum.at(top, r[at], runs)
        return np.bincount(r[at], minlength=n).astype(np.float64), top

    kinds, top = distinct(of, h)
    together = of[1:] == of[:-1]
    pair = (h[:-1] * np.uint64(31) + h[1:])[together]
    pairs, _ = distinct(of[1:][together], pair)
    breaks = np.bincount(row[data == 10], minlength=n)
    # a line's key is the sum of its word hashes
    line = np.cumsum(np.concatenate(([0], (data == 10).astype(np.int64))))[start] + of if len(start) else of
    if len(start):
        first = np.concatenate(([True], (line[1:] != line[:-1]) | (of[1:] != of[:-1])))
        at = np.flatnonzero(first)
        lines, _ = distinct(of[at], np.add.reduceat(h, at))
        filled = np.bincount(of[at], minlength=n)
    else:
        lines, filled = np.zeros(n), np.zeros(n)
    length = end - start
    head = data[start] if len(start) else np.zeros(0, np.uint8)
    second = data[np.minimum(start + 1, len(data) - 1)] if len(start) else head
    title = (head >= 65) & (head <= 90) & ~((second >= 65) & (second <= 90))
    after = np.where(end < off[of + 1], data[np.minimum(end, max(len(data) - 1, 0))], 32) if len(start) else head
    plain = np.isin(after, np.frombuffer(b" \n.,", np.uint8))

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(of[mask], minlength=n) / some

    return np.stack([
        np.log1p(size), np.log1p(words), np.bincount(of, weights=length, minlength=n) / some,
        share(marked((65, 90), (97, 122), (128, 255))), share(marked((65, 90))), share(marked((48, 57))),
        share(_class(SYMBOLS)), share(_class(MARKS)), share(_class(b" \t\r\n\v\f")), words / (breaks + 1),
        kinds / some, top / some, pairs / np.maximum(words - 1, 1), lines / np.maximum(filled, 1),
        of_words(length <= 3), of_words(title), of_words(plain)], axis=1)


def feature_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the features of each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Tokenizer(marked((48, 57), (65, 90), (97, 122), (128, 255)), ascii_lower())
        width = len(FEATURES)
        for batch in batches:
            data, off, _ = texts(batch.column(1))
            x = [text_features(data[off[a]:off[b]], off[a:b + 1] - off[a], find) for a, b in slabs(off, SLAB)]
            x = np.concatenate(x) if x else np.zeros((0, width))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["doc_id", "x"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, x array<double>")


def additive_score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probabilities from a model of plain arrays: ``base``, and per feature
    ``cuts`` (bin edges), ``tables`` (a value per bin), ``coarse`` (edges for
    pairs); ``pairs`` holds ``(feature, feature, grid of values)``."""
    total = np.full(len(x), model["base"])
    for i, (cut, table) in enumerate(zip(model["cuts"], model["tables"])):
        total += table[np.searchsorted(cut, x[:, i], side="right")]
    for i, j, table in model["pairs"]:
        at = [np.searchsorted(model["coarse"][k], x[:, k], side="right") for k in (i, j)]
        total += table[at[0], at[1]]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(grad: np.ndarray, weight: np.ndarray, leaves: int = 3, prior: float = 5.0) -> np.ndarray:
    """Values of a shallow regression tree on ordered bins: best splits first."""
    parts = [(0, len(grad))]
    g, w = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(weight)))

    def fit(a, b):
        return (g[b] - g[a]) ** 2 / (w[b] - w[a] + prior)

    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = fit(a, k) + fit(k, b) - fit(a, b)
                if gain.max() > best[0]:
                    best = (gain.max(), p, int(k[gain.argmax()]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + prior)
    return out


def _pair_tree(grad: np.ndarray, weight: np.ndarray, prior: float = 5.0) -> tuple[np.ndarray, float]:
    """Values and gain of the best cross-shaped cut of a grid into four parts."""
    g, w = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (grad, weight))
    best, where = -1.0, None
    for a in range(1, grad.shape[0]):
        for b in range(1, grad.shape[1]):
            cells = [(0, a, 0, b), (0, a, b, -1), (a, -1, 0, b), (a, -1, b, -1)]
            gain = 0.0
            for r0, r1, c0, c1 in cells:
                s = g[r1, c1] - g[r0, c1] - g[r1, c0] + g[r0, c0]
                n = w[r1, c1] - w[r0, c1] - w[r1, c0] + w[r0, c0]
                gain += s * s / (n + prior)
            if gain > best:
                best, where = gain, (a, b)
    out = np.zeros(grad.shape)
    if where:
        a, b = where
        for rows, cols in ((slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)),
                           (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))):
            out[rows, cols] = grad[rows, cols].sum() / (weight[rows, cols].sum() + prior)
    return out, best


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> dict:
    """Cyclic boosting of the logistic loss; without both labels, a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return {"base": base, "cuts": [], "tables": [], "coarse": [], "pairs": []}
    cuts = [_edges(v, BINS) for v in x.T]
    bins = [np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), base)

    def slope():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, b in enumerate(bins):
            g, w = slope()
            step = rate * _tree(np.bincount(b, g, len(tables[i])), np.bincount(b, w, len(tables[i])))
            tables[i] += step
            total += step[b]
    coarse = [_edges(v, PAIR_BINS) for v in x.T]
    low = [np.searchsorted(c, v, side="right") for c, v in zip(coarse, x.T)]

    def grid(i, j, values):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(low[i] * shape[1] + low[j], values, shape[0] * shape[1]).reshape(shape)

    g, w = slope()
    ranked = sorted(combinations(range(len(bins)), 2),
                    key=lambda p: -_pair_tree(grid(*p, g), grid(*p, w))[1])[:PAIRS]
    pairs = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for i, j in ranked]
    for _ in range(rounds // 3):
        for i, j, table in pairs:
            g, w = slope()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, w))[0]
            table += step
            total += step[low[i], low[j]]
    return {"base": base, "cuts": cuts, "tables": tables, "coarse": coarse, "pairs": pairs}


def score_rows(rows: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, score)`` of feature rows, by additions of bin values."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(additive_score(shared.value, x))],
                                             names=["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``score`` is the probability of label 1, from the text alone.  NULL, empty
    and wordless texts are scored by their sizes.  Without labels of both kinds
    every score is the share of label 1, smoothed.  Repeated rows are scored
    alike; an empty table gives an empty result.
    """
    rows = materialize(feature_rows(docs), "quality-features")
    fit = one_each(rows.join(fit_labels(labels, "quality"), "doc_id"), "x").select("x", "label").toPandas()
    x = np.array(fit["x"].tolist()).reshape(len(fit), len(FEATURES))
    model = fit_additive(x, fit["label"].to_numpy(np.float64))
    out = score_rows(rows, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
