import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from conftest import rows
from gazette.operators import evolve, nested
from gazette.sources import json_loader

SCHEMA = T.StructType([T.StructField("event_name", T.StringType()), T.StructField("n", T.LongType())])


def write_lines(lines, name="part.json"):
    d = tempfile.mkdtemp(prefix="gz-in-")
    with open(os.path.join(d, name), "w") as f:
        for l in lines:
            f.write((l if isinstance(l, str) else json.dumps(l)) + "\n")
    return d


def test_case_insensitive_keys(spark):
    d = write_lines([{"EVENT_NAME": "a", "N": 1}, {"event_name": "b", "n": 2}, {"Event_Name": "c"}])
    got = rows(json_loader.load_ndjson(spark, d, SCHEMA))
    assert got == sorted([("a", 1), ("b", 2), ("c", None)], key=repr)
    strict = rows(json_loader.load_ndjson(spark, d, SCHEMA, case_insensitive=False))
    assert strict == sorted([(None, None), ("b", 2), (None, None)], key=repr)


def test_bad_value_aborts(spark):
    d = write_lines([{"event_name": "a", "n": "x1"}])
    with pytest.raises(Exception):
        json_loader.load_ndjson(spark, d, SCHEMA).collect()


def test_evolving_union_adds_and_widens(spark):
    old = spark.createDataFrame([("a", 1)], "event_name string, n int")
    new = spark.createDataFrame([("b", 2, "granted")], "EVENT_NAME string, n long, consent_state string")
    u = evolve.evolving_union(old, new)
    assert [f.name for f in u.schema.fields] == ["event_name", "n", "consent_state"]
    assert dict((f.name, f.dataType.simpleString()) for f in u.schema.fields)["n"] == "bigint"
    assert rows(u) == [("a", 1, None), ("b", 2, "granted")]


def test_evolving_union_refuses_conflict(spark):
    old = spark.createDataFrame([("a", 1)], "event_name string, n long")
    new = spark.createDataFrame([("b", "x")], "event_name string, n string")
    with pytest.raises(evolve.SchemaConflict):
        evolve.evolving_union(old, new)


def test_append_evolving_table(spark):
    path = tempfile.mkdtemp(prefix="gz-tbl-") + "/t"
    evolve.append_evolving(spark, spark.createDataFrame([("a", 1)], "event_name string, n long"), path)
    evolve.append_evolving(spark, spark.createDataFrame([("b", 2, 0.5)], "event_name string, n long, s double"), path)
    got = rows(evolve.read_evolving(spark, path), "event_name", "n", "s")
    assert got == [("a", 1, None), ("b", 2, 0.5)]
    with pytest.raises(evolve.SchemaConflict):
        evolve.append_evolving(spark, spark.createDataFrame([("c", "z")], "event_name string, n string"), path)


def test_field_presence(spark):
    df = spark.createDataFrame([("b1", "x", None), ("b2", "y", 1)], "batch string, a string, c long")
    got = rows(evolve.field_presence(df, "batch"))
    assert got == [("b1", "a", 1), ("b1", "c", 0), ("b2", "a", 1), ("b2", "c", 1)]


def test_variant_unwrap_and_flatten(spark):
    d = write_lines([
        {"raw_event": {"user_pseudo_id": "u1", "geo": {"country": "FR", "city": "Lyon"},
                       "device": {"category": "mobile"}, "traffic_source": {"source": "google"},
                       "event_params": [{"key": "article_section", "value": "Sport"},
                                        {"key": "page_title", "value": "T"}]}},
        {"raw_event": {"user_pseudo_id": "u2", "geo": {"country": "BE"}, "event_params": []}},
        {"raw_event": {"user_pseudo_id": "u3", "geo": {"country": "FR"}}},
    ])
    v = json_loader.load_variant(spark, d, "raw_event", unwrap_key="raw_event")
    proj = rows(nested.nested_projection(v), "user_id", "country", "city")
    assert proj == [("u1", "FR", "Lyon"), ("u3", "FR", None)]
    assert rows(nested.params_exploded(v)) == [("u1", "article_section", "Sport")]
    assert len(nested.params_exploded(v, key=None).collect()) == 2


def test_ledger_makes_reload_a_noop(spark):
    d = write_lines([{"event_name": "a", "n": 1}, {"event_name": "b", "n": 2}])
    ledger = tempfile.mkdtemp(prefix="gz-ledger-") + "/ledger"
    rows1, files1 = json_loader.load_once(spark, d, SCHEMA, ledger)
    assert rows1.count() == 2 and len(files1) == 1
    json_loader.record_file_list(spark, files1, ledger)
    rows2, files2 = json_loader.load_once(spark, d, SCHEMA, ledger)
    assert files2 == [] and rows2.count() == 0
