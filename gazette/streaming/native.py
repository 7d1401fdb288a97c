"""Spark-native streaming variants.

* ``native_sessions``: ``session_window`` with a watermark.  Boundary rule
  differs from the batch sessions (C6): events merge while the *elapsed* gap
  is <= ``gap`` (exactly 30 minutes merges), while C6 splits when the
  minute-boundary difference exceeds 30.  Session end = last event + gap.
* ``daily_windows``: tumbling one-day windows per section with a watermark;
  distinct readers are approximate (exact distinct is refused on streams).
  With ``sketch`` each closed day carries its HyperLogLog sketch of readers, so
  days merge into longer spans later (``merged_windows``) without the events.

Watermarks need TIMESTAMP (not NTZ): with the session time zone pinned to
UTC the cast keeps the wall clock, and results are cast back to NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ts(df: DataFrame, col: str = "event_timestamp") -> DataFrame:
    return df.withColumn("_ts", F.col(col).cast("timestamp"))


def native_sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    ev = F.col("event_name")
    agg = (_ts(events).withWatermark("_ts", watermark)
           .groupBy("user_pseudo_id", F.session_window("_ts", gap).alias("w"))
           .agg(F.count("*").alias("total_events"),
                F.sum("engagement_time_sec").alias("total_engagement_sec"),
                F.count_if(ev == "paywall_hit").alias("paywall_hits")))
    return agg.select("user_pseudo_id",
                      F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("session_end"),
                      "total_events", "total_engagement_sec", "paywall_hits")


SKETCH_BITS = 14  # 2^14 registers: a relative standard error of 0.8 %


def daily_windows(events: DataFrame, watermark: str = "1 day", approx_readers: bool = True,
                  sketch: bool = False) -> DataFrame:
    ev = F.col("event_name")
    aggs = [F.count("*").alias("page_views"),
            F.count_if(ev == "paywall_hit").alias("paywall_hits"),
            F.count_if(ev == "subscribe_click").alias("subscribe_clicks")]
    if approx_readers:
        aggs.append(F.approx_count_distinct("user_pseudo_id").alias("approx_unique_readers"))
    if sketch:
        aggs.append(F.hll_sketch_agg("user_pseudo_id", SKETCH_BITS).alias("readers_sketch"))
    agg = (_ts(events).withWatermark("_ts", watermark)
           .groupBy(F.window("_ts", "1 day").alias("w"), "section").agg(*aggs))
    return agg.select(F.col("w.start").cast("timestamp_ntz").cast("date").alias("day"), "section",
                      *[a for a in agg.columns if a not in ("w", "section")])


def merged_windows(days: DataFrame, unit: str = "week") -> DataFrame:
    """Closed days with sketches merged into weeks (or any ``date_trunc`` unit) per section."""
    return (days.groupBy(F.date_trunc(unit, "day").cast("date").alias(unit), "section")
            .agg(F.count(F.lit(1)).alias("days"), F.sum("page_views").alias("page_views"),
                 F.sum("paywall_hits").alias("paywall_hits"), F.sum("subscribe_clicks").alias("subscribe_clicks"),
                 F.hll_union_agg("readers_sketch").alias("readers_sketch")))


def run_to_table(agg: DataFrame, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming aggregate to completion and return its final rows.

    ``append``: finalized windows only (production form).  ``complete``:
    the whole result table of the last micro-batch (used to check the
    aggregate against its batch definition).
    """
    spark = agg.sparkSession
    final: dict = {}

    def handler(batch: DataFrame, batch_id: int) -> None:
        path = f"{checkpoint}/out/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        final["path"] = path if mode == "complete" else f"{checkpoint}/out"

    q = (agg.writeStream.outputMode(mode).foreachBatch(handler)
         .option("checkpointLocation", f"{checkpoint}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    if "path" not in final:
        return spark.createDataFrame([], agg.schema)
    df = spark.read.parquet(final["path"])
    return df.drop("batch") if "batch" in df.columns else df
