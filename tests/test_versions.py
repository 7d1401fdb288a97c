"""Versioned tables, the RAW schema log, bitmap states and the id dictionary."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMOKE, rows
from gazette.operators import aggregates, cdc
from gazette.operators.evolve import SchemaConflict
from gazette.plans.context import Context
from gazette.session import scratch_path
from gazette.sources import raw_table, versions
from gazette.sources.dictionary import IdDictionary
from gazette.streaming import bitmaps

CH = "id long, v string, op string, seq long"


def changes(spark, *data):
    return spark.createDataFrame(list(data), CH)


def test_reader_opened_before_a_batch_keeps_its_state(spark):
    store = cdc.SnapshotStore(spark, scratch_path(spark, "iso"), buckets=4)
    store.apply(changes(spark, *[(i, "old", "I", i) for i in range(40)]), 0, ["id"], ["seq"])
    before = store.latest()
    store.apply(changes(spark, *[(i, "new", "U", 100 + i) for i in range(40)]), 1, ["id"], ["seq"])
    assert {r.v for r in before.collect()} == {"old"} and before.count() == 40
    assert {r.v for r in store.latest().collect()} == {"new"}


def test_reader_during_a_batch_sees_the_old_state_whole(spark, monkeypatch):
    store = cdc.SnapshotStore(spark, scratch_path(spark, "iso2"), buckets=4)
    key = (["id"], ["seq"])
    store.apply(changes(spark, *[(i, "old", "I", i) for i in range(40)]), 0, *key)
    publish, seen = versions.Versions.publish, []

    def look_then_fail(self, number, manifest):  # all files of the batch are written by now
        seen.append({r.v for r in store.latest().collect()})
        raise RuntimeError("driver lost")

    batch = changes(spark, *[(i, "new", "U", 100 + i) for i in range(30)])
    monkeypatch.setattr(versions.Versions, "publish", look_then_fail)
    with pytest.raises(RuntimeError):
        store.apply(batch, 1, *key)
    monkeypatch.setattr(versions.Versions, "publish", publish)
    assert seen == [{"old"}] and {r.v for r in store.latest().collect()} == {"old"}
    store.apply(batch, 1, *key)  # the retry
    assert sorted(r.v for r in store.latest().collect()) == ["new"] * 30 + ["old"] * 10


def test_one_file_per_touched_bucket_and_old_versions_go(spark):
    root = scratch_path(spark, "files")
    store = cdc.SnapshotStore(spark, root, buckets=8, keep=2)
    count = lambda: len(glob.glob(f"{root}/state/*/*/*.parquet"))
    store.apply(changes(spark, *[(i, "a", "I", i) for i in range(200)]).repartition(7), 0, ["id"], ["seq"])
    assert count() == 8
    for n in range(1, 6):
        had = count()
        store.apply(changes(spark, (n, f"v{n}", "U", 1000 + n)), n, ["id"], ["seq"])
        assert count() <= had + 1
    table = store.table(["id"])
    assert len(table.versions.numbers()) == 2 and count() <= 8 + 1
    assert table.read(table.versions.numbers()[0]).where("v = 'v5'").count() == 0  # the older version still reads
    assert store.latest().count() == 200
    with pytest.raises(versions.Conflict):
        table.versions.publish(table.versions.numbers()[-1], {})


def test_empty_first_batch_has_a_schema(spark):
    store = cdc.SnapshotStore(spark, scratch_path(spark, "empty"), buckets=4)
    assert store.latest() is None
    store.apply(changes(spark), 0, ["id"], ["seq"])
    assert store.latest().count() == 0 and store.latest().columns == ["id", "v", "op", "seq"]


BASE = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def raw(spark, name):
    return raw_table.RawTable(spark, scratch_path(spark, name), BASE)


def lines(spark, *objects):
    return spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objects], "value string")


def kinds(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def test_whole_numbers_keep_all_digits(spark):
    t = raw(spark, "digits")
    t.append(lines(spark, {"id": "a", "big": 9007199254740993, "SCORE": 5}), "s", 0)
    t.append(lines(spark, {"id": "b", "n": 3, "score": 5.5, "big": 12345678901234567890}), "s", 1)
    out = t.read()
    assert kinds(out) == {"id": "string", "n": "bigint", "big": "decimal(38,0)", "score": "double"}
    assert sorted((r.id, int(r.big), r.score) for r in out.collect()) == [
        ("a", 9007199254740993, 5.0), ("b", 12345678901234567890, 5.5)]
    t.append(lines(spark, {"id": "c", "big": 0.25}), "s", 2)
    assert sorted(str(r.big) for r in t.read().collect()) == [
        "0.25", "12345678901234567890.00", "9007199254740993.00"]
    t.append(lines(spark, '{"id": "d", "big": 1e300}', '{"id": "e", "score": 1e300}'), "s", 3)
    out = {r.id: r for r in t.read().collect()}
    assert out["d"].big == "1e300" or float(out["d"].big) == 1e300
    assert out["a"].big == "9007199254740993" and out["e"].score == 1e300


@pytest.mark.parametrize("facts, want", [
    ((1, 0, False, True, True), "bigint"), ((20, 0, False, False, False), "decimal(38,0)"),
    ((39, 0, False, False, False), "string"), ((3, 2, False, True, True), "double"),
    ((17, 2, False, True, False), "decimal(19,2)"), ((30, 20, False, False, False), "string"),
    ((17, 0, True, True, False), "string"), ((3, 0, True, True, True), "double")])
def test_number_types(facts, want):
    assert raw_table.number_type(dict(zip(("whole", "fraction", "exponent", "long", "double"), facts))) == want


def test_flags_texts_and_nested_fields(spark):
    t = raw(spark, "kinds")
    t.append(lines(spark, {"id": "a", "ok": True, "tag": "12", "geo": {"c": [1, 2]}, "void": None}, ""), "s", 0)
    t.append(lines(spark, {"ID": "b", "OK": False, "geo": {"c": "x"}, "void": 7}), "s", 1)
    out = t.read().withColumn("geo", F.to_json("geo"))
    assert kinds(t.read())["geo"] == "variant" and kinds(out)["ok"] == "boolean"
    assert rows(out, "id", "ok", "tag", "geo", "void") == sorted([
        ("a", True, "12", '{"c":[1,2]}', None), ("b", False, None, '{"c":"x"}', 7)], key=repr)


@pytest.mark.parametrize("bad", [{"id": "x", "n": 1.5}, {"id": "x", "n": "z"}, {"id": "x", "late": "text"},
                                 {"id": "x", "n": 99999999999999999999}])
def test_type_changes_are_refused_before_anything_is_written(spark, bad):
    t = raw(spark, "refuse")
    t.append(lines(spark, {"id": "a", "n": 1, "late": 4}), "s", 0)
    for _ in range(2):
        with pytest.raises(SchemaConflict):
            t.append(lines(spark, bad), "s", 1)
    assert rows(t.read()) == [("a", 1, 4)] and len(t.log.numbers()) == 1
    with pytest.raises(SchemaConflict):
        t.append(lines(spark, {"q": 1}, {"q": "one"}), "s", 2)
    with pytest.raises(SchemaConflict):
        t.append(lines(spark, "[1]"), "s", 2)


def test_replayed_batch_and_schema_without_footers(spark):
    t = raw(spark, "replay")
    for _ in range(2):
        t.append(lines(spark, {"id": "a", "x": 1}), "s", 0)
    t.append(lines(spark, {"id": "b"}), "other", 0)
    assert rows(t.read()) == sorted([("a", None, 1), ("b", None, None)], key=repr)
    assert len(t.log.numbers()) == 1                       # one schema change, one file
    for f in glob.glob(f"{t.path}/_source=*/*/*.parquet"):
        os.remove(f)                                       # the schema does not come from files
        open(f, "w").write("no parquet")
    assert kinds(t.read()) == {"id": "string", "n": "bigint", "x": "bigint"}


def test_engagement_bitmaps_replay_late_and_nulls(spark):
    ev = Context(spark, SMOKE).events
    odd = (ev.withColumn("section", F.when(F.pmod("event_id", F.lit(7)) == 0, None).otherwise(F.col("section")))
             .withColumn("user_pseudo_id", F.when(F.pmod("event_id", F.lit(11)) == 0, None).otherwise(F.col("user_pseudo_id")))
             .withColumn("event_date", F.when(F.pmod("event_id", F.lit(45)) == 0, None).otherwise(F.col("event_date"))))
    h = bitmaps.EngagementState(spark, scratch_path(spark, "t-bits"), buckets=4)
    late = odd.where(F.pmod("event_id", F.lit(3)) == 0)
    h(odd.where(F.pmod("event_id", F.lit(3)) != 0), 0)
    first = h.read()
    held = rows(first)
    h(odd.where(F.lit(False)), 1)
    h(late, 2)          # late events for all days
    h(late, 2)          # replay of a published batch
    want = aggregates.reader_engagement(odd)
    assert rows(h.read().select(*want.columns)) == rows(want)
    assert rows(first) == held       # the reader of the first version is not disturbed
    size = h.size()
    assert size["pairs"] == want.agg(F.sum("unique_readers")).first()[0] and size["bytes"] > 0


def test_bitmaps_merge_ids_of_any_size(spark):
    h = bitmaps.DistinctState(spark, scratch_path(spark, "t-ids"), ["g"], {"n": F.count(F.lit(1))}, reader="r", buckets=3)
    ids = [0, 1, -1, 32768, 32769, -32768, 2**62, -2**62, 5, 5, None]
    for k in range(3):
        h(spark.createDataFrame([("a", i) for i in ids] + [("b", k)], "g string, r long"), k)
    assert rows(h.totals()) == [("a", 9, 33), ("b", 3, 3)]


def test_performance_bitmaps_dimension_edits_are_stored(spark):
    ctx = Context(spark, SMOKE)
    root = scratch_path(spark, "t-perf-bits")
    h = bitmaps.PerformanceState(spark, root, buckets=4)
    h.set_articles(ctx.articles)
    assert h.read().where("unique_readers = 0").count() == ctx.articles.count()
    ev = ctx.events
    h(ev.where(F.pmod("event_id", F.lit(4)) != 0), 0)
    h(ev.where(F.pmod("event_id", F.lit(4)) == 0), 1)
    h(ev.where(F.pmod("event_id", F.lit(8)) == 0), 2)    # only readers that are known
    both = ev.unionByName(ev.where(F.pmod("event_id", F.lit(8)) == 0))
    assert rows(h.read()) == rows(aggregates.article_performance(ctx.articles, both))
    edited = ctx.articles.orderBy("article_id").limit(3).withColumn("title", F.lit("Edited"))
    h.set_articles(edited)
    again = bitmaps.PerformanceState(spark, root, buckets=4)  # another driver
    out = again.read()
    assert out.where("title = 'Edited'").count() == 3 and out.count() == ctx.articles.count()
    with pytest.raises(ValueError):
        bitmaps.PerformanceState(spark, root, buckets=5).read()


def test_dictionary_is_stable_dense_and_invertible(spark):
    root = scratch_path(spark, "t-dict")
    d = IdDictionary(spark, root, buckets=4)
    one = spark.createDataFrame([(f"u{i}", f"art-{i % 7}") for i in range(300)] + [(None, "art-1"), ("u1", None)],
                                "u string, a string")
    assert d.encode(one, "u").where("u is not null").count() == 0
    d.extend(one, "u", "a")
    first = dict(rows(d.table.read()))
    d.extend(one, "u", "a")      # nothing new: no new version
    assert d.table.versions.numbers() == [0]
    more = spark.createDataFrame([(f"u{i}", "art-x") for i in range(250, 600)], "u string, a string")
    d.extend(more, "u", "a")
    both = dict(rows(d.table.read()))
    assert all(both[k] == v for k, v in first.items()) and len(both) == 600 + 8
    assert len(set(both.values())) == len(both) and max(both.values()) < 4 * len(both)
    back = IdDictionary(spark, root, buckets=4)
    coded = back.encode(one, "u", "a")
    assert kinds(coded) == {"u": "bigint", "a": "bigint"}
    assert rows(back.decode(coded, "u", "a")) == rows(one)
