"""Micro-batch latency of the continuous tables vs the reference's freshness targets.

    python tools/freshness.py [/root/testdata/sf0.1]

Runs each stream over the staged landing files (several micro-batches, late
events included) and reports per-batch trigger durations from the
streaming query progress.
"""

import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def durations(q):
    return [p["durationMs"].get("triggerExecution", 0) / 1000 for p in q.recentProgress
            if p.get("numInputRows", 0) > 0]


def main():
    from gazette.operators import cdc
    from gazette.plans.context import Context
    from gazette.session import get_spark, input_bytes, scratch_path
    from gazette.sources import staging
    from gazette.streaming import refresh
    from gazette.streaming import ingest as st_ingest

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    ctx = Context(spark, sf)
    landing, per_group = refresh.stage_typed_events(ctx.events, spark)
    out = {}

    def stream():
        return spark.readStream.schema(ctx.events.schema).option("maxFilesPerTrigger", per_group).parquet(landing)

    h = refresh.EngagementRefresh(scratch_path(spark, "f-raw"), scratch_path(spark, "f-eng"))
    out["reader_engagement (target 300 s)"] = durations(refresh.run_available_now(stream(), h, scratch_path(spark, "f-c1")))
    h = refresh.PerformanceRefresh(scratch_path(spark, "f-raw2"), scratch_path(spark, "f-perf"), ctx.articles)
    h.initialize(spark)
    out["article_performance recompute (target 600 s)"] = durations(
        refresh.run_available_now(stream(), h, scratch_path(spark, "f-c2")))
    h = refresh.PerformanceIncremental(scratch_path(spark, "f-inc"), ctx.articles,
                                       buckets=cdc.buckets_for(input_bytes(spark, f"{sf}/events.parquet")))
    h.publish(spark)
    out["article_performance incremental (target 600 s)"] = durations(
        refresh.run_available_now(stream(), h, scratch_path(spark, "f-c3")))
    feed, feed_files = staging.stage_change_feed(spark, sf)
    nb = cdc.buckets_for(input_bytes(spark, f"{sf}/orders.parquet"))
    store = cdc.SnapshotStore(spark, scratch_path(spark, "f-cdc"), buckets=nb)
    s = spark.readStream.schema(ctx.change_feed.schema).option("maxFilesPerTrigger", max(1, feed_files // 8)).parquet(feed)
    q = refresh.run_available_now(s, st_ingest.ChangeFeedApply(store, ["article_id"], ["change_ts", "change_seq"]),
                                  scratch_path(spark, "f-c4"))
    out["cms change visible (target 5 s)"] = durations(q)
    report = {k: {"batches": len(v), "median_s": round(statistics.median(v), 2), "max_s": round(max(v), 2)}
              for k, v in out.items() if v}
    print(json.dumps({"sf": sf, "micro_batch_latency": report}, indent=1))
    spark.stop()


if __name__ == "__main__":
    main()
