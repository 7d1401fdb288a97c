"""Hard negatives, packing and clustering against plain brute force."""

import random
import zlib
from collections import Counter
from math import floor, isfinite

import numpy as np
import pytest

from gazette.llm import centroids, negatives, packing

from .conftest import got, words

SCHEMA = "vec_id long, embedding array<float>, label int, score long, anchor int, _part string"


@pytest.fixture(scope="module")
def vectors():
    """Ties, equal vectors, repeated rows and ids, NULLs, non-finite parts, other lengths."""
    rng = random.Random(11)
    out = [(i, [float(np.float32(rng.gauss(0.05, 0.2))) for _ in range(64)], i % 4) for i in range(260)]
    hot = out[9][1]
    out += [(1000 + i, hot, i % 3) for i in range(120)]
    out += [(2000, [0.0] * 64, 1), (2100, [0.0] * 64, 1), (2200, None, 1), (2300, hot, None), (None, hot, 2),
            (None, out[4][1], 1), (2400, [float("nan")] * 64, 0), (2500, [float("inf")] + [0.0] * 63, 0),
            (2600, [None] + [0.5] * 63, 0), (2700, [0.5] * 63, 0), (2701, [0.25] * 63, 0), (2702, [0.5] * 63, 1),
            (2800, [], 0), (2801, [], 1), (-100, [-3.0] * 64, 1), (-101, [300.0] + [-1e-9] * 63, -5)]
    return out + [out[0], out[0], out[7], (100, out[3][1], 2)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2, "x") for i, v, y in rows], SCHEMA).repartition(5)


def test_subset_sums_and_bit_planes():
    rng = np.random.default_rng(1)
    for dim in (1, 7, 8, 20, 64):
        a, c = rng.integers(-300, 300, (9, dim)), rng.integers(-70, 40, (50, dim))
        assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c)) == c @ a.T).all()
    assert negatives.subset_sums(np.array([[1, 2, 4, 8, 16, 32, 64, 128]]))[0, :, 0].tolist() == list(range(256))


def brute_negatives(rows):
    ok = [(i, y, [floor(256 * float(x)) for x in v]) for i, v, y in rows
          if y is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    ok = [(i, int(np.fmod(y + 1, 10)) if i is not None and i % 7 == 0 else y, v) for i, y, v in ok]
    place = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for i, y, v in {(i, y, tuple(v)) for i, y, v in ok if i is not None and i % 100 == 0}:
        meet = [(j, z, sum(a * b for a, b in zip(v, w))) for j, z, w in ok if len(w) == len(v)]
        pos = sorted(((j, s) for j, z, s in meet if z == y and j != i), key=place)[:5]
        for n, (pid, p) in enumerate(pos):
            neg = sorted(((j, s) for j, z, s in meet if z != y and 30 * p <= 100 * s <= 90 * p), key=place)[:10]
            out += [(i, pid, k + 1, j, p, s, n + 1) for k, (j, s) in enumerate(neg)]
    return sorted(out, key=repr)


def test_hard_negatives_equal_brute_force(spark, vectors, monkeypatch):
    want = brute_negatives(vectors)
    assert len(want) > 100 and len({r[0] for r in want}) > 4
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    df = frame(spark, vectors)
    assert got(negatives.mined_negatives(df).select(*names)) == want
    small = negatives.hard_negatives(negatives.labelled_vectors(df), negatives.F.col("vec_id") % 100 == 0, part_bytes=2000)
    assert got(small.select(*names)) == want
    assert negatives.mined_negatives(frame(spark, [])).count() == 0


def test_best_search_equals_all_distances():
    rng = np.random.default_rng(5)
    for dim, k, spread in ((64, 16, 10), (3, 40, 4), (1, 5, 3), (8, 1, 9)):
        c, x = rng.integers(-spread, spread, (k, dim)) + 3, rng.integers(-spread, spread, (400, dim))
        c[-1] = c[0]
        c[k // 2:] += rng.integers(0, 40, (k - k // 2, 1))
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        search = centroids.Centroids(c)
        who, dist = search.nearest(x)
        assert (who == d.argmin(1)).all() and (dist == d.min(1)).all()
        assert search.exact < len(x) * k or k == 1
    with pytest.raises(OverflowError):
        centroids.Centroids(np.full((2, 64), 1 << 30))


def brute_clusters(rows, clusters=16, rounds=3):
    import hashlib
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = [(i, v) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:clusters]
    whole = lambda v: [floor(64 * x) for x in v]
    table, q = [whole(v) for _, v in first], [whole(v) for _, v in kept]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(table)) for v in q]

    for _ in range(rounds):
        at = assign()
        for j in range(len(table)):
            mine = [v for v, (_, k) in zip(q, at) if k == j]
            if mine:
                table[j] = [sum(c) // len(mine) for c in zip(*mine)]
    at = assign()
    inside = Counter()
    for d, j in at:
        inside[j] += d
    return sorted([(i, j, d, inside[j], sum(inside.values()), sha(",".join(map(str, table[j]))))
                   for (i, _), (d, j) in zip(kept, at)], key=repr)


def test_clusters_equal_brute_force(spark, vectors):
    assert got(centroids.cluster_vectors(frame(spark, vectors))) == brute_clusters(vectors)
    few = [vectors[3], vectors[3], vectors[5], (None, vectors[6][1], None), (9, None, 1)]
    assert got(centroids.cluster_vectors(frame(spark, few))) == brute_clusters(few)
    assert centroids.cluster_vectors(frame(spark, [])).count() == 0


def brute_fit(lengths, caps, rule, weights):
    """One piece after the other, one sequence after the other."""
    bins = []
    for n in sorted(lengths, reverse=True):
        want = np.array([n, 1, n * n])
        fits = [b for b in bins if (b >= want).all()]
        key = {"norm": lambda b: float(((b - want) / caps) ** 2 @ weights),
               "dot": lambda b: float((b / caps) @ (np.array(weights) * (want / caps)))}[rule]
        if fits:
            best = min(fits, key=key)
        else:
            best = np.array(caps)
            bins.append(best)
        best -= want
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(64, 64, 64 * 64), (64, 3, 64 * 64), (64, 9, 1500), (1, 1, 1)])
def test_plan_equals_piecewise_best_fit(rule, caps):
    rng = random.Random(str(caps))
    for weights in ((1.0, 0.001, 0.001), (1.0, 0.7, 0.4)):
        top = min(caps[0], int(caps[2] ** 0.5))
        lengths = [min(top, 1 + int(rng.expovariate(0.06))) for _ in range(300)]
        plan = packing.best_fit(Counter(lengths), caps, rule, weights)
        filled = Counter()
        for n, content in plan:
            for size, t in content:
                filled[size] += n * t
            used = np.array([[s * t, t, s * s * t] for s, t in content]).sum(axis=0)
            assert (used <= caps).all()
        assert filled == Counter(lengths)
        bins = brute_fit(lengths, caps, rule, weights)
        assert sum(n for n, _ in plan) == len(bins)
        room = Counter()
        for n, content in plan:
            room[tuple((np.array(caps) - np.array([[s * t, t, s * s * t] for s, t in content]).sum(axis=0)).tolist())] += n
        assert room == Counter(tuple(b.tolist()) for b in bins)
    with pytest.raises(ValueError):
        packing.best_fit({caps[0] + 1: 1}, caps)


def plain_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_chunked_ids_equal_whole_texts(monkeypatch):
    rng = random.Random(2)
    bits = ["a", "foo", "Bar", " ", " ", "  ", "\n", "\t", "'s", "'", "'ll", "!", "12", "é", "中文", " ", "　",
            "​", "\x1c", "\x85", "᠎", "😀", "_", "-", "<|endoftext|>", "\r\n", "é", "\0", "x" * 90]
    monkeypatch.setattr(packing, "CACHE", 300)  # so chunks are forgotten on the way
    own = packing.Vocabulary(packing.vocabulary()).ids(2)
    for _ in range(60):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(15)]
        texts += [words(rng, 30) + "\n" + words(rng, 5), ""]
        want = plain_ids(texts)
        places = []
        for at, some, plain in packing._slabs(texts):
            ids, off = own.documents(some, plain)
            assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [want[i] for i in at]
            places += at.tolist()
        assert sorted(places) == list(range(len(texts)))


def check_packing(spark, rows, packed, capacity, most_docs=None, most_cost=None):
    pieces = [r.asDict() for r in packed.collect()]
    ids = {}
    for (i, text, *_), v in zip(rows, plain_ids([r[1] for r in rows])):
        ids.setdefault((i, len(v)), []).append(v)
    longest = min(capacity, int((most_cost or capacity ** 2) ** 0.5))
    want = Counter()
    for (i, _), many in ids.items():
        for v in many:
            head = len(v) - (-(-len(v) // longest) - 1) * longest
            at = [0] + list(range(head, len(v), longest)) + [len(v)]
            want.update((i, k, a, b - a, zlib.crc32(np.array(v[a:b], "<u4").tobytes()))
                        for k, (a, b) in enumerate(zip(at, at[1:])))
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == want
    held = {}
    for p in pieces:
        held.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in held.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= capacity and len(spans) <= (most_docs or capacity)
        assert sum(n * n for _, n in spans) <= (most_cost or capacity ** 2)
    return len(held), [p["length"] for p in pieces]


def test_packing_round_trip_and_best_fit(spark, rows, docs, no_docs):
    n, lengths = check_packing(spark, rows, packing.packed_documents(docs), 1024)
    caps = (1024, 1024, 1024 * 1024)
    assert n == len(brute_fit(lengths, caps, "norm", packing.WEIGHTS)) and n <= -(-sum(lengths) // 1024) * 1.1 + 1
    assert packing.packed_documents(no_docs).count() == 0


def test_packing_under_every_constraint(spark, rows, docs):
    for rule in ("norm", "dot"):
        out = packing.pack_documents(docs, ["doc_id", "SHARD", "_part"], capacity=300, most_docs=3, most_cost=250 * 250,
                                     rule=rule, weights=(1.0, 0.5, 0.5), with_ids=True)
        n, lengths = check_packing(spark, rows, out, 300, 3, 250 * 250)
        assert n == len(brute_fit(lengths, (300, 3, 250 * 250), rule, (1.0, 0.5, 0.5)))
    whole = {tuple(r["ids"]) for r in packing.sequences(out).collect()}
    assert sum(map(len, whole)) <= sum(lengths) and all(len(w) <= 300 for w in whole)
    assert sorted(out.columns[:3]) == ["SHARD", "_part", "doc_id"]
    with pytest.raises(ValueError):
        packing.pack_documents(docs.withColumn("piece", packing.F.lit(1)), ["piece"])
