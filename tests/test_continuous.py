"""Session state, sketches of closed days, exact ranks, trained trees in SQL, the file ledger."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMOKE, rows
from gazette.functions.sql_functions import register_tree_function
from gazette.operators import churn, ranking
from gazette.operators import sessions as S
from gazette.plans.churn import _features
from gazette.plans.context import Context
from gazette.session import scratch_path
from gazette.sources import json_loader
from gazette.streaming import native, session_state

EVENT = ("user_pseudo_id long, event_timestamp timestamp_ntz, event_name string, article_id long, section string, "
         "engagement_time_sec long, device_category string, traffic_source string")


def events(spark, *data):
    """``(user, "HH:MM:SS", article)`` events of one day."""
    full = [(u, None if t is None else f"2024-01-01 {t}", "page_view", a, f"s{(a or 0) % 3}", 5, "m", "t") for u, t, a in data]
    return spark.createDataFrame(full, EVENT.replace("timestamp_ntz", "string")).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def kept(spark, gap=30, buckets=3):
    return session_state.SessionState(spark, scratch_path(spark, "t-sessions"), gap, buckets)


def test_late_event_joins_two_sessions_and_shifts_numbers(spark):
    h = kept(spark)
    first = [(1, "10:00:59", 1), (1, "10:31:00", 2), (1, "11:10:00", 3), (1, "12:00:00", 4), (2, "09:00:00", 1),
             (None, "08:00:00", 7), (None, "08:20:00", 7)]
    late = [(1, "11:30:30", 5), (1, "10:31:00", 6), (None, "08:45:00", 8), (3, "00:00:00", None), (1, "08:00:00", 9),
            (1, None, 11), (3, None, 12)]
    h(events(spark, *first), 0)
    before = h.read()
    assert rows(before) == rows(S.sessions(events(spark, *first), 30, method="window"))
    want = rows(before)
    h(events(spark, *late), 1)
    h(events(spark, *late), 1)                     # replay of a published batch
    h(events(spark), 2)
    assert rows(h.read()) == rows(S.sessions(events(spark, *first, *late), 30, method="window"))
    assert rows(before) == want                    # an open reader keeps its version


def test_random_batches_in_any_order_equal_the_batch_rule(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}:{rng.randint(0, 59):02}",
             rng.choice([None, 1, 2, 3])) for _ in range(160)]
    h = kept(spark, gap=17)
    for k in range(4):
        h(events(spark, *data[k::4]), k)
    assert rows(h.read()) == rows(S.sessions(events(spark, *data), 17, method="window"))


def test_session_order_works_on_narrow_rows(spark):
    plan = session_state.merged(session_state.minutes(events(spark, (1, "10:00:00", 1))), 30)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in text.splitlines() if "Window [" in line)
    assert "articles" not in window and "sections" not in window


def test_session_state_rewrites_only_touched_buckets(spark):
    h = kept(spark, buckets=8)
    h(events(spark, *[(u, "10:00:00", u) for u in range(40)]), 0)
    parts = h.table.manifest()["parts"]
    h(events(spark, (5, "10:10:00", 1)), 1)
    after = h.table.manifest()["parts"]
    assert sum(after[b] != parts[b] for b in parts) == 1 and h.read().count() == 40


def test_day_sketches_merge_like_one_sketch(spark):
    ev = Context(spark, SMOKE).events
    days = ev.groupBy(F.col("event_date").alias("day"), "section").agg(
        F.count("*").alias("page_views"), F.lit(0).alias("paywall_hits"), F.lit(0).alias("subscribe_clicks"),
        F.hll_sketch_agg("user_pseudo_id", native.SKETCH_BITS).alias("readers_sketch"))
    weeks = native.merged_windows(days).select("week", "section", "page_views",
                                               F.hll_sketch_estimate("readers_sketch").alias("n"))
    want = ev.groupBy(F.date_trunc("week", "event_date").cast("date").alias("week"), "section").agg(
        F.count("*").alias("page_views"), F.hll_sketch_estimate(F.hll_sketch_agg("user_pseudo_id", native.SKETCH_BITS)).alias("n"))
    assert rows(weeks) == rows(want)


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_roc_auc_equals_all_pairs(spark):
    rng = random.Random(6)
    data = [(g, rng.choice([0.5, rng.random(), -1.0]), rng.randint(0, 1)) for g in ("a", "b", "c") for _ in range(60)]
    data += [("d", 0.3, 1)] * 5 + [("e", 0.1, 0), ("e", None, 1), ("e", 0.4, None), ("f", 2.0, 1), ("f", 1.0, 0)]
    got = {r.g: r for r in ranking.roc_auc(spark.createDataFrame(data, "g string, s double, y int"), "s", "y", "g").collect()}
    for g in "abcdef":
        want = brute_auc([(s, y) for h, s, y in data if h == g and s is not None and y is not None])
        assert got[g].auc == (pytest.approx(want) if want is not None else None), g
    assert (got["d"].positives, got["d"].negatives, got["d"].distinct_scores) == (5, 0, 1)
    assert ranking.roc_auc(spark.createDataFrame([], "g string, s double, y int"), "s", "y", "g").count() == 0


def test_ranks_and_shift(spark):
    df = spark.createDataFrame([(i, i * 37 % 101) for i in range(100)], "k long, v long").repartition(6)
    assert [r.k for r in sorted(ranking.ranked(df, [F.col("v").desc()]).collect(), key=lambda r: r["rank"])] == \
        sorted(range(100), key=lambda i: -(i * 37 % 101))
    moved = {r.k: r.v for r in ranking.permuted(df, "v", [F.col("k")]).collect()}
    assert moved == {i: (i + 1) % 100 * 37 % 101 for i in range(100)}
    assert ranking.permuted(df.limit(0), "v", [F.col("k")]).count() == 0


def test_importance_is_zero_for_unused_features(spark):
    score = churn.churn_rule_score("days_since_login", "articles_read_30d", "paywall_bounces_30d")
    feats = churn.model_inputs(_features(spark, SMOKE))
    out = {r.feature: r for r in churn.permutation_importance(feats, score, churn.FEATURES).collect()}
    assert out["tenure_months"].importance == pytest.approx(0) and out["days_since_login"].importance > 0.01
    as_frame = churn.permutation_importance(feats, lambda df: df.withColumn("score", score), ["days_since_login"])
    assert as_frame.first().importance == pytest.approx(out["days_since_login"].importance)


def test_trees_in_sql_equal_the_model(spark):
    feats = _features(spark, SMOKE)
    odd = feats.withColumn("articles_read_30d", F.when(F.col("user_id") % 5 != 0, F.col("articles_read_30d"))) \
        .withColumn("avg_session_sec", F.when(F.col("user_id") % 7 != 0, F.col("avg_session_sec")))
    model = churn.train(churn.stratified_split(feats, "churned", 0.2, 42), max_iter=6, max_depth=4)
    nodes = churn.tree_nodes(model)
    assert len(nodes["root"]) == len(nodes["weight"]) == 6 and nodes["depth"] <= 4
    register_tree_function(spark, nodes, "tree_probe")
    churn.score(model, odd, as_served=True).createOrReplaceTempView("tree_scored")
    got = spark.sql("""SELECT m.churn_probability AS a, t.churn_probability AS b, m.risk_segment AS s, t.risk_segment AS r
FROM tree_scored m, LATERAL tree_probe(days_since_login, articles_read_30d, tenure_months, CAST(avg_session_sec AS DOUBLE),
                                       paywall_bounces_30d) t""").collect()
    assert len(got) == feats.count()
    assert all(abs(r.a - r.b) < 0.00011 and r.s == r.r for r in got) and len({r.a for r in got}) > 5


BASE = T.StructType([T.StructField("n", T.LongType())])


def test_ledger_loads_each_of_ten_thousand_files_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(10_000):
        (landing / f"f{i}.json").write_text(f'{{"n": {i}}}\n' if i % 10 == 0 else "\n")
    (landing / "skip.txt").write_text('{"n": -1}')
    ledger = json_loader.FileLedger(spark, str(tmp_path / "ledger"))

    def load():
        new = ledger.pending(str(landing), "*.json")
        lines = ledger.lines(str(landing), new, "*.json")
        out = [] if lines is None else sorted(r.n for r in json_loader.parse_lines(lines, BASE).collect())
        ledger.record(new)
        return out

    assert load() == list(range(0, 10_000, 10))
    assert load() == []
    (landing / "late.json").write_text('{"n": 7}')
    import os
    os.utime(landing / "late.json", (1, 1))        # a new file with an old time is new all the same
    assert load() == [7]
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 10_001


def test_sessions_of_a_user_with_half_of_all_events(spark):
    ev = Context(spark, SMOKE).actions
    hot = ev.select(*[c for c in ev.columns if c not in ("user_pseudo_id", "article_id")],
                    F.when(F.pmod("event_id", F.lit(2)) == 0, 7).otherwise(F.col("user_pseudo_id")).cast("long").alias("user_pseudo_id"),
                    F.when(F.pmod("event_id", F.lit(2)) == 0, F.col("event_id") + 10_000).otherwise(F.col("article_id"))
                    .alias("article_id"))
    many = hot.unionByName(hot.where("user_pseudo_id = 7").withColumn("article_id", F.col("article_id") + 500_000)) \
        .unionByName(hot.where("user_pseudo_id = 7").withColumn("article_id", F.col("article_id") + 900_000))
    assert many.where("user_pseudo_id = 7").agg(F.count_distinct("article_id")).first()[0] > 1000
    out = S.sessions(many, 30)
    assert rows(out) == rows(S.sessions(many, 30, method="window"))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(line for line in plan if "Window [" in line)
    assert "articles" not in window and "sections" not in window and "article_id" not in window


def test_split_keeps_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(90)], "user_id long, churned int")
    out = churn.stratified_split(df, "churned", 0.2, 42, buckets_bits=3)
    counts = {(r.churned, r.split): r.n for r in out.groupBy("churned", "split").agg(F.count("*").alias("n")).collect()}
    assert out.count() == 90 and all(counts[y, "test"] == 6 and counts[y, "train"] == 24 for y in (None, 0, 1))
    assert churn.train_partitions(0) == churn.train_partitions(2_000_000) == 8 and churn.train_partitions(10**9) == 4000


def test_null_score_inputs_count_as_zero(spark):
    df = spark.createDataFrame([(1, 0, None, 0, 10, "x"), (2, 0, 0, None, None, "x"), (3, 0, 0, 0, 0, "x")],
                               "user_id long, churned int, days_since_login long, articles_read_30d long, "
                               "paywall_bounces_30d long, subscription_type string")
    got = {r.user_id: r.churn_score for r in churn.rule_scores(df).collect()}
    assert got[1] is not None and got[2] == got[3]


def test_at_risk_needs_no_join(spark):
    feats = churn.churn_features(Context(spark, SMOKE).subscribers, "2024-02-29", keep=["ltv_estimated_eur"])
    scored = churn.rule_scores(feats, keep=["subscription_type", "ltv_estimated_eur"], digits=4)
    top = churn.at_risk_topn(scored.withColumnRenamed("churn_score", "churn_probability"), None, 10)
    assert "Join" not in top._jdf.queryExecution().optimizedPlan().toString()
    assert top.columns[:3] == ["user_id", "subscription_type", "ltv_estimated_eur"]


def test_configure_keeps_what_the_user_set(spark):
    from gazette.session import configure

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "7m")
        configure(spark)
        assert spark.conf.get(key) == "7m"
    finally:
        spark.conf.set(key, before)
