"""Language identification by Bayesian evidence fusion.

Four kinds of evidence per row: the text, the language its markup declares, the
suffix of its address, and its host.

1. The languages are those that at least ``LEAST_SUPPORT`` rows declare.  Byte
   trigrams of all texts are counted by declared language (partial counts in
   each task, one sum).  Hashed to ``2 ** HASH_BITS`` cells, the model has one
   bounded row per language and one for ``OTHER``, and is broadcast.
2. Each row gets a log likelihood per class; it counts as at most ``EVIDENCE``
   independent trigrams, since neighbours overlap.  ``OTHER`` takes every
   trigram at ``MARGIN`` below its likeliest language, so it wins where no
   language holds most of the trigrams.  Blocks of ``BLOCK`` trigrams that it
   wins (keys, tables, quotations) are left out if the rest is large enough.
3. Posteriors from the text alone are summed by declared language, by suffix,
   by host and by domain.  They give ``P(declared | language)``,
   ``P(suffix | language)`` and host priors smoothed towards the domain's, which
   are smoothed towards the whole corpus.  A row's own part is taken out of the
   sums it meets again.
4. All factors multiply to the final posterior.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, slabs, texts
from .tokens import SLAB, ascii_lower, marked

OTHER = "other"       # the class of rows that fit no language
LEAST_SUPPORT = 5     # rows that declare a language, for it to be a class
MOST_LANGUAGES = 256  # classes at most: bounds the model; the most declared ones
UNSEEN = 0.1          # share of a language's probability spread evenly over all trigrams
MARGIN = 1.5          # nats that OTHER is below the likeliest language of a trigram
FLOOR = 1.0           # least probability of a trigram in OTHER, in even shares
BLOCK = 32            # trigrams judged together
LEAST_FIT = 0.25      # share of a text in blocks of some language, to judge it by these alone
HASH_BITS = 16
EVIDENCE = 150.0      # trigrams that a text's evidence counts for at most
STRENGTH = 5.0        # rows that a smoothing prior counts for
LEAST_POSTERIOR = 0.5

_HIDDEN = re.compile(rb"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;")


def _trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around a letter, and the row of each."""
    letter = marked((65, 90), (97, 122), (128, 255))
    lower = np.where(letter, ascii_lower(), 32).astype(np.uint32)
    rows = np.arange(len(off) - 1)
    # a blank before and after every row keeps trigrams inside it
    out = np.full(len(data) + 2 * len(rows) + 2, 32, np.uint32)
    row_of = np.repeat(rows, np.diff(off))
    at = np.arange(len(data)) + 2 * row_of + 1
    out[at] = lower[data]
    keep = letter[data]
    at = at[keep]
    code = (out[at - 1] << np.uint32(16)) | (out[at] << np.uint32(8)) | out[at + 1]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)
    return code.astype(np.int64), row_of[keep]


def _visible(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of rows of markup without tags, scripts, styles and comments."""
    raw = data.tobytes()
    parts = [_HIDDEN.sub(b" ", raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return (np.frombuffer(b"".join(parts), np.uint8),
            np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))))


def _pieces(batch: pa.RecordBatch, column: int, html: bool):
    data, off, _ = texts(batch.column(column))
    for a, b in slabs(off, SLAB):
        d, o = data[off[a]:off[b]], off[a:b + 1] - off[a]
        yield a, b, *(_visible(d, o) if html else (d, o))


def trigram_counts(rows: DataFrame, languages, html: bool) -> DataFrame:
    """``(language, cell, n)`` over all rows that declare one of ``languages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << HASH_BITS), np.int64)
        index = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            lang = np.array([index.get(x, -1) for x in batch.column(1).to_pylist()], np.int64)
            for a, b, data, off in _pieces(batch, 0, html):
                code, row = _trigrams(data, off)
                own = lang[a:b][row]
                known = own >= 0
                total += np.bincount(own[known] * (1 << HASH_BITS) + code[known],
                                     minlength=total.size).reshape(total.shape)
        lang, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(cell.astype(np.int32)),
                                          pa.array(total[lang, cell])], names=["language", "cell", "n"])

    counts = rows.select("text", "declared").mapInArrow(run, "language int, cell int, n long")
    return counts.groupBy("language", "cell").agg(F.sum("n").alias("n"))


def declared_languages(rows: DataFrame, support: int = LEAST_SUPPORT) -> list[str]:
    """Values of ``declared`` that at least ``support`` rows have, sorted."""
    counts = rows.where(F.col("declared").isNotNull()).groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    most = counts.where(F.col("n") >= support).orderBy(F.desc("n"), "declared").limit(MOST_LANGUAGES)
    return sorted(r[0] for r in most.collect())


def trigram_model(rows: DataFrame, languages, html: bool) -> np.ndarray:
    """Log probabilities, one row per language and one of ``OTHER``: at most
    ``(languages + 1) * 2^HASH_BITS`` numbers."""
    even = 1.0 / (1 << HASH_BITS)
    counts = np.zeros((len(languages), 1 << HASH_BITS))
    for r in trigram_counts(rows, languages, html).toLocalIterator():
        counts[r[0], r[1]] = r[2]
    # unseen trigrams cost the same in all languages
    share = (1 - UNSEEN) * counts / np.maximum(counts.sum(axis=1, keepdims=True), 1) + UNSEEN * even
    other = np.maximum(share.max(axis=0, initial=0.0) * np.exp(-MARGIN), FLOOR * even)
    return np.log(np.concatenate([share, other[None, :]])).astype(np.float32)


def _sums(code: np.ndarray, row: np.ndarray, n: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of each row, and log likelihoods of at most ``EVIDENCE`` of them."""
    count = np.bincount(row, minlength=n)
    blocks = -(-count // BLOCK)
    first = np.cumsum(blocks) - blocks
    block = first[row] + (np.arange(len(row)) - (np.cumsum(count) - count)[row]) // BLOCK
    total, row_of = int(blocks.sum()), np.repeat(np.arange(n), blocks)
    size = np.bincount(block, minlength=total)
    part = np.stack([np.bincount(block, weights=t[code], minlength=total) for t in table], axis=1)
    fits = part[:, :-1].max(axis=1, initial=-np.inf) > part[:, -1]
    fitted = np.bincount(row_of, weights=size * fits, minlength=n)
    told = (fitted > 0) & (fitted >= LEAST_FIT * count)
    used = fits | ~told[row_of]
    taken = np.bincount(row_of, weights=size * used, minlength=n)
    sums = np.stack([np.bincount(row_of, weights=p * used, minlength=n) for p in part.T], axis=1)
    # blocks that fit different languages are a text of several, not of another one
    best = sums[:, :-1].max(axis=1, initial=-np.inf) - MARGIN * taken
    sums[:, -1] = np.where(told, np.minimum(sums[:, -1], best), sums[:, -1])
    return count.astype(np.float64), sums * (np.minimum(taken, EVIDENCE) / np.maximum(taken, 1))[:, None]


def text_evidence(rows: DataFrame, keep: list[str], model: np.ndarray, html: bool, text: str, out: str) -> DataFrame:
    """Columns ``keep`` with ``out``: the trigram count and the log likelihoods."""
    used = [c for c in rows.columns if c in keep]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.astype(np.float64)
        for batch in batches:
            n, found = batch.num_rows, []
            for a, b, data, off in _pieces(batch, len(used), html):
                code, row = _trigrams(data, off)
                count, sums = _sums(code, row, b - a, table)
                found.append(np.concatenate([count[:, None], sums], axis=1))
            flat = np.concatenate(found) if found else np.zeros((0, 1 + len(table)))
            width = flat.shape[1]
            column = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(used))] + [column], names=used + [out])

    body = fresh(rows, "_body")
    df = rows.select(*[f"`{c}`" for c in used], F.col(f"`{text}`").cast("string").alias(body))
    schema = ", ".join([f"`{c}` {t}" for c, t in df.dtypes[:-1]] + [f"`{out}` array<double>"])
    return df.mapInArrow(run, schema)


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often it is used inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _softmax(logs: Column) -> Column:
    def shares(parts: Column) -> Column:
        return _bound(_sum(parts), lambda total: F.transform(parts, lambda x: x / total))

    return _bound(logs, lambda xs: _bound(F.array_max(xs), lambda top: _bound(
        F.transform(xs, lambda x: F.exp(x - top)), shares)))


def domain(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+\.[^.]+|[^.]+)$", 1)


def suffix(host: Column) -> Column:
    return F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), F.lit(""))


def declared_language(value: Column) -> Column:
    """``en`` of ``EN-gb``; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.lower(value), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", 1), F.lit(""))


def fuse(rows: DataFrame, text: str, declared: str, host: str, html: bool = False, prefix: str = "",
         languages=None, support: int = LEAST_SUPPORT) -> DataFrame:
    """``rows`` with ``language`` and ``posterior`` from all evidence, and ``letters``.

    ``languages`` are those that at least ``support`` rows declare, if not given;
    ``language`` is one of them or ``OTHER``.  If there are none, ``language``
    and ``posterior`` are NULL.

    ``text``, ``declared`` and ``host`` name columns; names of the results take
    ``prefix``.  Missing evidence (NULL or unknown) is a factor of one.  With no
    evidence at all the corpus decides.  Ties go to the first language.
    """
    lang, post, count = (f"{prefix}{c}" for c in ("language", "posterior", "letters"))
    plain = rows.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{declared}`").alias("declared"))
    known = declared_languages(plain, support) if languages is None else list(languages)
    model = trigram_model(plain, known, html)
    classes = [*known, OTHER]
    k = len(classes)
    ll = fresh(rows, "_ll")
    scored = text_evidence(rows, rows.columns, model, html, text, ll)
    logs, seen = F.slice(F.col(ll), 2, k), F.get(F.col(ll), F.lit(0)) > 0

    narrow = text_evidence(rows, [declared, host], model, html, text, ll)
    narrow = narrow.where(seen).select(F.col(f"`{declared}`").alias("declared"), F.col(f"`{host}`").alias("host"),
                                       _softmax(logs).alias("p"))
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"p{i}") for i in range(k)]
    again = [F.sum(f"p{i}").alias(f"p{i}") for i in range(k)]
    # one row per (host, declared): every other sum is taken over these
    cells = materialize(narrow.groupBy("host", "declared").agg(*sums), "lang-cells")
    whole = [(x or 0.0) + 1.0 for x in cells.agg(*again).first()]
    total = sum(whole)

    # the sums of each row's host, domain, suffix and declared language, without its own part
    own = fresh(scored, "_own")
    df = scored.withColumn(own, F.transform(_softmax(logs), lambda x: F.when(seen, x).otherwise(0.0)))
    h, cell_host, tags = F.col(f"`{host}`"), F.col("host"), {}
    for what, of_cell, of_row in (("host", cell_host, h), ("domain", domain(cell_host), domain(h)),
                                  ("suffix", suffix(cell_host), suffix(h)),
                                  ("declared", F.col("declared"), F.col(f"`{declared}`"))):
        key, tag = fresh(df, f"_key_{what}"), fresh(df, f"_{what}_p")
        table = (cells.select(of_cell.alias(key), *[f"p{i}" for i in range(k)]).where(F.col(key).isNotNull())
                 .groupBy(key).agg(*again).select(key, F.array(*[f"p{i}" for i in range(k)]).alias(tag)))
        df = df.join(table, of_row == F.col(key), "left").drop(key)
        df = df.withColumn(tag, F.zip_with(F.coalesce(F.col(tag), F.array(*[F.lit(0.0)] * k)), F.col(own),
                                           lambda t, x: F.greatest(t - x, F.lit(0.0))))
        tags[what] = F.col(tag)
    # host prior, smoothed towards the domain's, that towards the corpus
    prior = fresh(df, "_prior")
    base = F.array(*[F.lit(w / total) for w in whole])

    def smoothed(counts: Column, towards: Column) -> Column:
        return _bound(_sum(counts), lambda all_: F.zip_with(
            counts, towards, lambda c, t: (c + STRENGTH * t) / (all_ + STRENGTH)))

    df = df.withColumn(prior, smoothed(tags["domain"], base))
    df = df.withColumn(prior, smoothed(tags["host"], F.col(prior)))
    sizes = F.array(*[F.lit(w) for w in whole])

    def factor(what: str) -> Column:
        # P(value | language), smoothed towards the value's share of the corpus
        return _bound((_sum(tags[what]) + 1.0) / (total + 1.0), lambda share: F.zip_with(
            tags[what], sizes, lambda t, z: F.log((t + STRENGTH * share) / (z + STRENGTH))))

    final, told = fresh(df, "_final"), fresh(df, "_told_by")
    text_part = F.transform(logs, lambda x: F.when(seen, x).otherwise(0.0))
    df = df.withColumn(told, F.zip_with(factor("declared"), factor("suffix"), lambda a, b: a + b))
    df = df.withColumn(final, F.zip_with(F.zip_with(text_part, F.col(prior), lambda x, p: x + F.log(p)), F.col(told),
                                         lambda x, y: x + y))
    df = df.withColumn(final, _softmax(F.col(final)))
    best = F.array_max(final)
    found = F.get(F.array(*[F.lit(x) for x in classes]), (F.array_position(final, best) - 1).cast("int"))
    if not known:  # nothing declared, nothing learned: the language is unknown, not another one
        found, best = F.lit(None).cast("string"), F.lit(None).cast("double")
    return df.select(*[f"`{c}`" for c in rows.columns], found.alias(lang), best.alias(post),
                     F.get(F.col(ll), F.lit(0)).cast("long").alias(count))


def _told(language: str, posterior: str, letters: str) -> Column:
    sure = (F.col(language) != OTHER) & (F.col(posterior) >= LEAST_POSTERIOR)
    return (F.col(letters) > 0) & F.coalesce(sure, F.lit(False))


def page_languages(pages: DataFrame, languages=None, support: int = LEAST_SUPPORT) -> DataFrame:
    """One row per page: ``page_id, host, suffix, declared, language, posterior, letters, accepted``.

    Accepted pages have visible letters, a language that is not ``OTHER`` and a
    posterior of at least ``LEAST_POSTERIOR``; if no page declares a language none is accepted.  NULL
    or empty markup and addresses are missing evidence; very long pages are read whole.  Repeated rows
    give repeated results, an empty table an empty one.  Other columns are not read.
    """
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", 1)
    rows = pages.select("page_id", F.nullif(host, F.lit("")).alias("host"),
                        declared_language(declared).alias("declared"), "html")
    out = fuse(rows, "html", "declared", "host", html=True, languages=languages, support=support)
    return out.select("page_id", "host", suffix(F.col("host")).alias("suffix"), "declared", "language", "posterior",
                      "letters", _told("language", "posterior", "letters").alias("accepted"))


def identified(docs: DataFrame, languages=None, support: int = LEAST_SUPPORT) -> DataFrame:
    """``docs`` whose language can be told.

    ``lang`` is the declared language and ``source`` the host.  Documents
    without letters, that fit no language better than ``OTHER``, or whose best
    posterior is under ``LEAST_POSTERIOR``, go.  A language that too few rows
    declare for a model of its own is taken at its word: documents that declare
    it and fit none of the others stay.  If no document declares a language
    nothing can be learned, and all documents with letters stay.  NULL
    texts have no letters; NULL ``lang`` and ``source`` are missing evidence;
    very long texts are read whole; repeated rows are judged alike; an empty
    table stays empty.
    """
    lang, host = fresh(docs, "_declared"), fresh(docs, "_host")
    rows = docs.withColumns({lang: declared_language(F.col("lang").cast("string")),
                             host: F.lower(F.col("source").cast("string"))})
    known = declared_languages(rows.select(F.col(lang).alias("declared")), support) if languages is None else list(languages)
    out = fuse(rows, "text", lang, host, prefix=fresh(rows, "_id_"), languages=known)
    found, _, letters = out.columns[-3:]
    unknown = F.col(found).isNull()
    rare = (F.col(found) == OTHER) & F.col(lang).isNotNull() & ~F.col(lang).isin(*known)
    kept = _told(*out.columns[-3:]) | ((F.col(letters) > 0) & F.coalesce(unknown | rare, F.lit(False)))
    return out.where(kept).select(*[f"`{c}`" for c in docs.columns])
