"""Errors are raised, not read as absence; masks hold whatever a column's case."""

import pytest

from gazette.operators import churn, evolve, masking
from gazette.session import scratch_path
from gazette.sources import json_loader
from gazette.streaming.ingest import EvolvingFileIngest
from gazette.streaming.refresh import EngagementIncremental
from pyspark.sql import types as T


def test_masks_match_any_case_and_need_their_columns(spark):
    df = spark.createDataFrame([("a@x.y", "Ann", "0612")], "EMAIL string, Full_Name string, phone string")
    row = masking.secured(df, masking.SUBSCRIBER_POLICIES, "ANALYST").first()
    assert row.EMAIL == "****@x.y" and row.Full_Name != "Ann" and row.phone.endswith("12") and row.phone != "0612"
    with pytest.raises(ValueError):
        masking.secured(df.drop("phone"), masking.SUBSCRIBER_POLICIES, "ANALYST")


def _corrupt(path):
    import os

    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("not parquet")


def test_corrupt_ledger_raises(spark, tmp_path):
    _corrupt(str(tmp_path / "ledger"))
    files = spark.createDataFrame([("f",)], "_source_file string")
    with pytest.raises(Exception):
        json_loader.new_files(spark, files, str(tmp_path / "ledger")).collect()
    assert json_loader.new_files(spark, files, str(tmp_path / "none")).count() == 1


def test_malformed_variant_line_aborts(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        json_loader.load_variant(spark, str(tmp_path)).collect()


def _land(spark, tmp_path, name, *lines):
    path = tmp_path / f"{name}.json"
    path.write_text("\n".join(lines))
    return spark.createDataFrame([(x, str(path)) for x in lines], "value string, _source_file string")


def test_streamed_numbers_may_become_fractional(spark, tmp_path):
    base = T.StructType([T.StructField("id", T.StringType())])
    sink = EvolvingFileIngest(str(tmp_path / "raw"), base)
    sink(_land(spark, tmp_path, "one", '{"id": "a", "score": 5}'), 0)
    sink(_land(spark, tmp_path, "two", '{"id": "b", "score": 5.5}'), 1)
    assert sorted(r.score for r in sink.read(spark).collect()) == [5.0, 5.5]


def test_streamed_type_change_is_refused_and_the_table_stays_readable(spark, tmp_path):
    base = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    sink = EvolvingFileIngest(str(tmp_path / "raw"), base)
    sink(_land(spark, tmp_path, "one", '{"id": "a", "n": 5}'), 0)
    with pytest.raises(evolve.SchemaConflict):
        sink(_land(spark, tmp_path, "two", '{"id": "b", "n": 5.5}'), 1)
    assert [r.n for r in sink.read(spark).collect()] == [5]


def test_empty_micro_batch_between_two(spark):
    schema = ("event_date date, section string, publication string, user_pseudo_id long, event_name string, "
              "engagement_time_sec long")
    import datetime as dt

    day = dt.date(2024, 1, 1)
    sink = EngagementIncremental(scratch_path(spark, "empty-batch"))
    sink(spark.createDataFrame([(day, "s", "p", 1, "page_view", 10)], schema), 0)
    sink(spark.createDataFrame([], schema), 1)
    sink(spark.createDataFrame([(day, "s", "p", 2, "page_view", 20)], schema), 2)
    assert [(r.unique_readers, r.page_views) for r in sink.read(spark).collect()] == [(2, 2)]


def test_model_does_not_depend_on_the_input_layout(spark):
    import __spark_entry__  # noqa: F401  (registers the plans)
    from gazette.plans.churn import _features

    rows = churn.stratified_split(_features(spark, "/root/testdata/sf0.001"), "churned").cache()
    scores = []
    for parts in (1, 4, 8):
        model = churn.train(rows.repartition(parts), max_iter=3)
        scores.append(sorted((r.user_id, r.churn_probability) for r in churn.score(model, rows).collect()))
    rows.unpersist()
    assert scores[0] == scores[1] == scores[2]
