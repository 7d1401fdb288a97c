import zlib
from collections import Counter, defaultdict

import duckdb

from gazette.llm.mixing import highest_quotients, mix_documents, mixed_rows, mixture, source_targets
from gazette.llm.oracle import MIX
from gazette.llm.shards import shard_documents, with_hilbert

from .conftest import got


def test_hilbert_index_is_a_walk_through_all_cells(spark):
    cells = [(x, y, z) for x in range(8) for y in range(8) for z in range(8)]
    df = with_hilbert(spark.createDataFrame(cells, "a long, b long, c long"), ["a", "b", "c"], 3, "at")
    path = [tuple(r[:3]) for r in sorted(df.collect(), key=lambda r: r.at)]
    assert sorted(r.at for r in df.collect()) == list(range(512))
    assert all(sum(abs(p - q) for p, q in zip(u, v)) == 1 for u, v in zip(path, path[1:]))


def test_shards_take_every_row_once(docs, rows):
    out = shard_documents(docs).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    order = [r.hilbert for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}


def test_shards_agree_between_runs_and_of_nothing(docs, no_docs):
    assert got(shard_documents(docs)) == got(shard_documents(docs))
    assert shard_documents(no_docs).count() == 0


def test_targets_stop_at_the_cap(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50), ("z", 0)], "source string, size long")
    t = {r.source: r.target for r in source_targets(rows).collect()}
    # weights 3 1 2 3 1 for a b c z NULL: a and z stop, the rest share by weight
    assert t["a"] == 20 and t["z"] == 0
    assert abs(sum(t.values()) - 1.5 * 1160) < 1e-6
    assert all(t[k] <= 2 * v for k, v in (("a", 10), ("b", 100), ("c", 1000), (None, 50)))


def test_highest_quotients_against_a_plain_ranking(spark):
    import random

    rng = random.Random(3)
    members = [(f"m{i}", rng.choice([0.0, 0.2, 0.3, rng.random() * 40, 7.5]), rng.randint(0, 60)) for i in range(60)]
    df = spark.createDataFrame(members, "m string, quota double, limit long")
    seats = int(sum(min(q, n) for _, q, n in members))
    quotients = sorted((-q / (2 * k - 1), m, k) for m, q, n in members if q > 0 for k in range(1, n + 1))[:seats]
    want = Counter(m for _, m, _ in quotients)
    assert {r.m: r.seats for r in highest_quotients(df, seats, ["m"], "t").collect() if r.seats} == dict(want)


def test_mix_equals_the_literal_apportionment(docs, rows, tmp_path):
    docs.select("doc_id", "text", "source").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    res = con.execute(MIX)
    cols = [c[0] for c in res.description]
    want = sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in res.fetchall()), key=repr)
    have = mix_documents(docs).select(*cols).collect()
    assert sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in have), key=repr) == want
    by = defaultdict(int)
    for r in have:
        assert r.taken <= 2 * r["size"]
        by[r.source_size, r.target] += r.taken
    assert got(mix_documents(docs)) == got(mix_documents(docs))


def test_mixed_rows_hold_what_the_mix_takes(docs, no_docs):
    taken = sum(r.taken for r in mix_documents(docs).collect())
    out = mixed_rows(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sum(len(r.text.split()) for r in rows) == taken
    assert all(r.n_chars == len(r.text) for r in rows)
    assert mixed_rows(no_docs).count() == 0 and mix_documents(no_docs).count() == 0


def _targets(sources):
    """Targets by plain water filling: ``{source: (words, target)}``."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, full = 1.5 * sum(sources.values()), set()
    while True:
        left = goal - sum(2 * sources[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and share and weight[s] * left / share >= 2 * sources[s]}
        if not more:
            return {s: (sources[s], 2.0 * sources[s] if s in full else weight[s] * left / share) for s in order}
        full |= more


def _check_mix(spark, rows, out):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = _targets(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r.taken <= 2 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    for words, target in want.values():
        same = [v for v in want.values() if v == (words, target)]
        assert abs(taken[words, round(target, 6)] - len(same) * target) <= len(same)


def test_small_sources_reach_their_targets(spark):
    rows, k = [], 0
    for n in list(range(1, 64, 4)) + [63, 64, 65, 130, 700]:       # one document of n words
        rows.append((k := k + 1, " ".join(["w"] * n), f"s{n:03}"))
    rows += [(k := k + 1, "one", "many") for _ in range(600)]       # 600 documents of one word
    rows += [(k := k + 1, " ".join(["x"] * 7), "sevens") for _ in range(900)]
    rows += [(k := k + 1, t, None) for t in (None, "", "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mix_documents(df).collect()
    assert len(out) == len(rows)
    _check_mix(spark, rows, out)
    text = defaultdict(int)
    for r in mixed_rows(df).collect():
        text[r.doc_id] += len(r.text.split())
    assert text == {r.doc_id: r.taken for r in out if r.taken}


def test_repeated_rows_and_null_ids_are_spread(spark):
    rows = [(None, f"text {i} of nobody", "hot") for i in range(1500)] + [(5, "the same row again", "hot")] * 3000
    rows += [(i, "a b c d e f", "other") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    placed, names = mixture(df)
    shards = Counter(r[0] for r in placed.where("doc_id = 5 or doc_id is null").select(names["shard"]).collect())
    assert len(shards) == 9 and max(shards.values()) < 2 * 4500 / 9
    out = placed.collect()
    copies = sorted(r[names["copy"]] for r in out if r.doc_id == 5 and r[names["source"]] == "hot")
    assert copies == list(range(3000))
    mixed = got(mix_documents(df).select("doc_id", "size", "source_size", "target", "taken"))
    again = spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(3)
    assert mixed == got(mix_documents(again).select("doc_id", "size", "source_size", "target", "taken"))
    taken = Counter()
    for _, _, source_size, target, words in mixed:
        taken[source_size, target] += words
    assert all(abs(words - target) <= 1 for (_, target), words in taken.items()) and len(taken) == 2
