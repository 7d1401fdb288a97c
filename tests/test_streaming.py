"""Continuous-table handlers: replay idempotence, late data, dimension edits."""

from pyspark.sql import functions as F

from conftest import SMOKE, rows
from gazette.operators import aggregates
from gazette.operators import sessions as S
from gazette.plans.context import Context
from gazette.session import scratch_path
from gazette.streaming import refresh


def test_engagement_refresh_replay_and_late_data(spark):
    ev = Context(spark, SMOKE).events
    h = refresh.EngagementRefresh(scratch_path(spark, "t-raw"), scratch_path(spark, "t-out"))
    late = ev.where(F.pmod("event_id", F.lit(10)) == 0)
    first = ev.where(F.pmod("event_id", F.lit(10)) != 0)
    h(first, 0)
    h(late, 1)          # late events for every old day
    h(late, 1)          # replay of the same batch id
    got = rows(spark.read.parquet(h.out_path).select(*aggregates.reader_engagement(ev).columns))
    assert got == rows(aggregates.reader_engagement(ev))


def test_performance_refresh_dimension_change(spark):
    ctx = Context(spark, SMOKE)
    h = refresh.PerformanceRefresh(scratch_path(spark, "t-raw2"), scratch_path(spark, "t-perf"), ctx.articles)
    h.initialize(spark)
    h(ctx.events, 0)
    assert rows(h.read(spark)) == rows(aggregates.article_performance(ctx.articles, ctx.events))
    some = ctx.articles.orderBy("article_id").limit(3).withColumn("title", F.lit("Edited"))
    h.apply_dimension_change(spark, some)
    out = h.read(spark)
    assert out.where(F.col("title") == "Edited").count() == 3
    assert out.count() == ctx.articles.count()


def test_bucket_sessionize_windows_over_buckets_not_events(spark):
    ev = Context(spark, SMOKE).events
    plan = S.sessionize(ev, 30)._jdf.queryExecution().optimizedPlan().toString()
    # the window's input is the (user, minute) de-duplication, not raw events
    win = plan[plan.index("Window"):]
    assert "Aggregate [user_pseudo_id" in win


def test_hot_user_sessions_match_window_form(spark):
    # one user with many events, others sparse: both methods agree
    hot = Context(spark, SMOKE).events.withColumn(
        "user_pseudo_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(7)).otherwise(F.col("user_pseudo_id")))
    assert rows(S.sessions(hot, 30, method="buckets")) == rows(S.sessions(hot, 30, method="window"))


def test_incremental_performance_replay_and_late(spark):
    ctx = Context(spark, SMOKE)
    ev = ctx.events
    h = refresh.PerformanceIncremental(scratch_path(spark, "t-inc"), ctx.articles)
    h.publish(spark)
    assert h.read(spark).count() == ctx.articles.count()        # initialized: every article, zero stats
    h(ev.where(F.pmod("event_id", F.lit(4)) != 0), 0)
    h(ev.where(F.pmod("event_id", F.lit(4)) == 0), 1)            # late events of all days
    h(ev.where(F.pmod("event_id", F.lit(4)) == 0), 1)            # replayed batch id
    h(ev.where(F.pmod("event_id", F.lit(8)) == 0), 2)            # duplicate readers only: no new pairs
    want = aggregates.article_performance(ctx.articles, ev.unionByName(ev.where(F.pmod("event_id", F.lit(8)) == 0)))
    assert rows(h.read(spark)) == rows(want)


def test_daily_windows_append_mode_emits_only_final_days(spark):
    from gazette.streaming import native

    ctx = Context(spark, SMOKE)
    landing, per_group = refresh.stage_typed_events(ctx.events, spark, late_every=None)
    stream = spark.readStream.schema(ctx.events.schema).option("maxFilesPerTrigger", 2 * per_group).parquet(landing)
    out = native.run_to_table(native.daily_windows(stream), scratch_path(spark, "t-win"), mode="append")
    batch = (ctx.events.groupBy(F.col("event_date").alias("day"), "section")
             .agg(F.count("*").alias("page_views")))
    got = {(r.day, r.section): r.page_views for r in out.collect()}
    want = {(r.day, r.section): r.page_views for r in batch.collect()}
    assert got and len(got) < len(want)              # the open (last) days stay in state
    assert all(want[k] == v for k, v in got.items())  # finalized windows are exact
    assert "approx_unique_readers" in out.columns


def test_incremental_performance_dimension_change(spark):
    ctx = Context(spark, SMOKE)
    h = refresh.PerformanceIncremental(scratch_path(spark, "t-inc-dim"), ctx.articles)
    h(ctx.events, 0)
    edited = ctx.articles.orderBy("article_id").limit(2).withColumn("section", F.lit("Sciences"))
    h.apply_dimension_change(spark, edited)
    out = h.read(spark)
    ids = [r.article_id for r in edited.collect()]
    assert {r.section for r in out.where(F.col("article_id").isin(ids)).collect()} == {"Sciences"}
    base = {r.article_id: r.unique_readers for r in aggregates.article_performance(ctx.articles, ctx.events).collect()}
    assert {r.article_id: r.unique_readers for r in out.collect()} == base


def test_engagement_refresh_null_day_group(spark):
    ev = Context(spark, SMOKE).events
    with_null = ev.withColumn("event_date", F.when(F.pmod("event_id", F.lit(50)) == 0, F.lit(None).cast("date"))
                              .otherwise(F.col("event_date")))
    h = refresh.EngagementRefresh(scratch_path(spark, "t-raw-n"), scratch_path(spark, "t-out-n"))
    h(with_null.where(F.pmod("event_id", F.lit(2)) == 0), 0)
    h(with_null.where(F.pmod("event_id", F.lit(2)) == 1), 1)
    cols = aggregates.reader_engagement(with_null).columns
    assert rows(spark.read.parquet(h.out_path).select(*cols)) == rows(aggregates.reader_engagement(with_null))


def test_incremental_engagement_replay_late_and_null_groups(spark):
    ev = Context(spark, SMOKE).events
    odd = (ev.withColumn("section", F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("section")))
             .withColumn("event_date", F.when(F.pmod("event_id", F.lit(45)) == 0, F.lit(None).cast("date"))
                         .otherwise(F.col("event_date"))))
    h = refresh.EngagementIncremental(scratch_path(spark, "t-eng-inc"))
    h(odd.where(F.pmod("event_id", F.lit(3)) != 0), 0)
    h(odd.where(F.pmod("event_id", F.lit(3)) == 0), 1)        # late events for all days
    h(odd.where(F.pmod("event_id", F.lit(3)) == 0), 1)        # replay
    want = aggregates.reader_engagement(odd)
    assert rows(h.read(spark).select(*want.columns)) == rows(want)


def test_incremental_publication_keeps_open_readers_and_edits(spark):
    import glob

    ctx = Context(spark, SMOKE)
    root = scratch_path(spark, "t-inc-pub")
    h = refresh.PerformanceIncremental(root, ctx.articles)
    h.publish(spark)
    h(ctx.events.where(F.pmod("event_id", F.lit(3)) == 0), 0)
    before = h.read(spark)
    want = rows(before)
    edited = ctx.articles.orderBy("article_id").limit(2).withColumn("title", F.lit("Edited"))
    h.apply_dimension_change(spark, edited)
    assert rows(before) == want                              # the open reader's table is whole
    again = refresh.PerformanceIncremental(root, None)       # another driver knows the edit
    again(ctx.events.where(F.pmod("event_id", F.lit(3)) == 1), 1)
    assert again.read(spark).where("title = 'Edited'").count() == 2
    assert again.read(spark).count() == ctx.articles.count()
    assert len(glob.glob(f"{root}/out/v=*")) == 2 and len(glob.glob(f"{root}/articles/v=*")) == 1


def test_replay_takes_as_many_batches_as_pieces(spark, monkeypatch):
    from gazette.operators import cdc
    from gazette.plans import streams

    applied = []
    apply = cdc.SnapshotStore.apply
    monkeypatch.setattr(cdc.SnapshotStore, "apply",
                        lambda self, batch, batch_id, *a: (applied.append(batch_id), apply(self, batch, batch_id, *a))[1])
    feed = spark.range(400).selectExpr("id % 40 AS k", "id AS seq", "if(id % 7 = 0, 'D', 'U') AS op").repartition(12)
    got = streams._replayed(spark, feed, "replay-test", ["k"], ["seq"], "seq", 1)
    assert len(applied) == 4                                            # not one for every four files
    last = {i % 40: i for i in range(400)}
    assert sorted((r.k, r.seq) for r in got.collect()) == sorted((k, i) for k, i in last.items() if i % 7)
