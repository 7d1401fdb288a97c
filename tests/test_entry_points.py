import os

from pyspark.sql import functions as F

from conftest import SMOKE
from gazette.operators import churn
from gazette.plans import export as plans_export
from gazette.plans.context import Context


def test_refresh_all_chain(spark):
    out = plans_export.refresh_all(spark, SMOKE)
    root = out["root"]
    for sub in ("reader_engagement", "article_performance", "portable/article_metrics"):
        assert spark.read.parquet(f"{root}/{sub}").count() > 0
    m = out["model"].query(["article_count"], ["section"])
    assert m.groupBy().sum("article_count").first()[0] == spark.read.parquet(f"{root}/article_performance").count()
    # export is partitioned by section -> pruning shows in the plan
    plan = spark.read.parquet(f"{root}/portable/article_metrics").where(F.col("section") == "Sport") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(section" in plan


def test_build_marts(spark):
    out = plans_export.build_marts(spark, SMOKE)
    assert spark.table("stg_sessions").count() > 0
    for t in out["tables"]:
        assert spark.read.parquet(f"{out['root']}/{t}").count() > 0


def test_model_save_load_roundtrip(spark, tmp_path):
    feats = churn.churn_features(Context(spark, SMOKE).subscribers, "2024-02-29")
    split = churn.stratified_split(feats, "churned", 0.2, 42)
    model = churn.train(split, max_iter=3, max_depth=3)
    path = churn.save_model(model, str(tmp_path / "churn_model"))
    assert os.path.isdir(path)
    again = churn.load_model(path)
    a = churn.score(model, feats).select("user_id", "churn_probability").collect()
    b = churn.score(again, feats).select("user_id", "churn_probability").collect()
    assert sorted(a) == sorted(b)
