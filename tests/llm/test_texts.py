"""Decontamination, SimHash, suffixes: equal to brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from gazette.llm import language, simhash, suffixes
from gazette.llm.common import components
from gazette.llm.decontaminate import brute_force, contamination, decontaminated, scan

from .conftest import LINE, got, words


@pytest.fixture(scope="module")
def bench(spark, rows):
    rng = random.Random(1)
    items = [(1, LINE), (2, "One short ITEM"), (3, None), (4, ""), (5, words(rng, 25)), (6, "one"),
             (7, " ".join(rows[3][1].split()[4:20])), (7, LINE.upper()), (None, "at all")]
    return spark.createDataFrame(items, "item_id long, text string")


def test_contamination_equals_brute_force(docs, rows, bench):
    items = [(None if r.item_id is None else str(r.item_id), r.text) for r in bench.collect()]
    want = sorted(((r[0], *x) for r, x in zip(rows, brute_force([r[1] for r in rows], items))), key=repr)
    assert got(contamination(docs, bench)) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


def test_contamination_in_several_parts_is_the_same(docs, bench):
    whole = got(scan(docs.select("doc_id", "text"), bench, "f", ["doc_id"]))
    assert got(scan(docs.select("doc_id", "text"), bench, "f", ["doc_id"], max_bytes=400)) == whole


def test_decontaminated_cuts_passages_and_keeps_the_rest(docs, rows, bench, no_docs):
    out = decontaminated(docs, bench)
    assert out.dtypes == docs.dtypes
    items = [(None if r.item_id is None else str(r.item_id), r.text) for r in bench.collect()]
    marks = brute_force([r[1] for r in rows], items)
    kept = Counter(tuple(r) for r in out.collect())
    clean = Counter(tuple(r) for r, m in zip(rows, marks) if m[1] == 0)
    assert not clean - kept
    dropped = sum(1 for m in marks if m[1] > 0.5 * m[0])
    assert sum(kept.values()) == len(rows) - dropped and dropped
    assert not any(t and LINE.strip() in t for _, t, *_ in kept)
    assert all(n == len(t) for _, t, _, _, n, _, _ in kept if t is not None)
    assert decontaminated(no_docs, bench).count() == 0
    assert decontaminated(docs, bench.where("false")).count() == len(rows)


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates_equal_brute_force(docs, rows, no_docs):
    fps = [plain_fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    want = sorted(((r[0], f"{fps[i]:016x}", low.get(find(i))) for i, r in enumerate(rows)), key=repr)
    assert got(simhash.near_duplicates(docs)) == want
    kept = simhash.deduplicated(docs)
    assert kept.dtypes == docs.dtypes
    assert kept.count() == len({find(i) for i in range(len(rows))})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicated(no_docs).count() == 0


def test_links_lose_no_pair_when_buckets_are_cut_again(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:3]:
        for _ in range(60):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {f: find(f) for f in fps}
    for bucket in (1024, 25):
        label = {r.node: r.root for r in components(simhash.links(df, bucket=bucket), "t").collect()}
        assert {f: label.get(f, f) for f in fps} == want


def test_components_of_long_chains_and_none(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long"), "t").collect()}
    assert out == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_substrings_equal_brute_force(spark, docs, rows, no_docs):
    clean = [(i, r[1]) for i, r in enumerate(rows)]
    clean += [(1000 + i, "ab" * (60 + i) + LINE[i:] * 3) for i in range(8)]
    clean += [(1100, LINE * 4), (1101, "é" * 300), (1102, "x" + "é" * 70), (1103, LINE[:99])]
    df = spark.createDataFrame(clean, "doc_id long, text string").repartition(4)
    assert got(suffixes.substring_deduplication(df)) == sorted(suffixes.brute_force(clean), key=repr)
    assert suffixes.substring_deduplication(no_docs).count() == 0


def test_substrings_of_repeated_and_missing_ids(docs, rows):
    out = suffixes.substring_deduplication(docs)
    assert out.count() == len(rows)
    same = [r for r in out.collect() if r.doc_id == rows[5][0]]
    assert len(same) == 3 and sorted(r.n_removed for r in same)[1:] == [same[0].n_bytes] * 2


def test_substrings_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HEAVY", 8)
    monkeypatch.setattr(suffixes, "BIG", 3)
    rng = random.Random(2)
    clean = [(i, words(rng, 12) + LINE + words(rng, 12)) for i in range(120)]
    df = spark.createDataFrame(clean, "doc_id long, text string").repartition(3)
    assert got(suffixes.substring_deduplication(df)) == sorted(suffixes.brute_force(clean), key=repr)


def test_deep_shallow_order():
    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab") for _ in range(8)) for _ in range(300)]
    order = suffixes.blind_trie(strings)
    assert sorted(i for c in order for i in c) == list(range(300))
    assert [strings[c[0]] for c in order] == sorted(set(strings))
    text = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(200)) * 2, np.uint8)
    pos = np.arange(301)
    later = suffixes.equal_to_earlier(text, pos, np.zeros(301, np.int64), pos)
    seen, raw = set(), text.tobytes()
    for p in range(301):
        assert later[p] == (raw[p:p + 100] in seen)
        seen.add(raw[p:p + 100])


def _letters(text):
    import re
    return len(re.findall(rb"[A-Za-z\x80-\xff]", (text or "").encode()))


def test_corpus_without_declared_languages_is_kept(spark, docs, rows):
    bare = docs.withColumn("lang", language.F.lit(None).cast("string"))
    kept = language.identified(bare)
    assert kept.dtypes == bare.dtypes
    assert kept.count() == sum(1 for r in rows if _letters(r[1]) > 0)


def test_rare_language_is_taken_at_its_word(spark):
    rng = random.Random(9)
    en = [(i, " ".join(rng.choice(["the", "house", "water", "with", "river", "and", "bread"]) for _ in range(60)), "en", "s")
          for i in range(60)]
    el = [(100, "το σπίτι και το νερό με το ψωμί στο ποτάμι " * 4, "el", "s"), (101, "το σπίτι και το νερό " * 8, None, "s")]
    df = spark.createDataFrame(en + el, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in language.identified(df).collect()}
    assert kept == {r[0] for r in en} | {100}


def test_softmax_equals_numpy(spark):
    import numpy as np
    rng = random.Random(2)
    data = [([rng.uniform(-900, 0) for _ in range(k)],) for k in (1, 2, 5, 40)]
    got = [r[0] for r in spark.createDataFrame(data, "x array<double>").select(language._softmax(language.F.col("x"))).collect()]
    for (x,), p in zip(data, got):
        e = np.exp(np.array(x) - max(x))
        assert np.allclose(p, e / e.sum(), rtol=1e-12)


def test_fusion_equals_a_plain_loop(spark, docs, rows):
    """All factors of ``fuse`` restated row by row from the text likelihoods."""
    import numpy as np
    F = language.F
    base = docs.select("doc_id", "text", "lang", F.lower("source").alias("host"))
    known = ["de", "en", "es", "fr"]
    out = [r.asDict() for r in language.fuse(base, "text", "lang", "host", languages=known).collect()]
    model = language.trigram_model(base.select("text", F.col("lang").alias("declared")), known, False)
    ll = language.text_evidence(base, base.columns, model, False, "text", "ll").collect()
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    has = [r.ll[0] > 0 for r in ll]
    own = [soft(np.array(r.ll[1:])) if s else np.zeros(5) for r, s in zip(ll, has)]
    whole = sum(own) + 1.0
    total, want = whole.sum(), []
    dom = lambda h: None if h is None else ".".join(h.split(".")[-2:])
    for i, r in enumerate(ll):
        def part(key):
            v = key(r)
            if v is None:
                return np.zeros(5)
            return np.maximum(sum((own[j] for j, o in enumerate(ll) if key(o) == v), np.zeros(5)) - own[i], 0)
        prior = whole / total
        for c in (part(lambda o: dom(o.host)), part(lambda o: o.host)):
            prior = (c + language.STRENGTH * prior) / (c.sum() + language.STRENGTH)
        logs = np.log(prior) + (np.array(r.ll[1:]) if has[i] else 0)
        for c in (part(lambda o: o.lang), np.zeros(5)):
            share = (c.sum() + 1) / (total + 1)
            logs = logs + np.log((c + language.STRENGTH * share) / (whole + language.STRENGTH))
        p = soft(logs)
        best = (known + ["other"])[int(p.argmax())]
        want.append((repr(r.doc_id), repr(r.text), best, round(float(p.max()), 6), int(r.ll[0])))
    assert sorted((repr(r["doc_id"]), repr(r["text"]), r["language"], round(r["posterior"], 6), r["letters"])
                  for r in out) == sorted(want)
