"""Continuously refreshed aggregates (CURATED): C4 and C5.

Both are declarative group-bys; Spark does the partial (map-side) aggregation
before the shuffle, so a hot group never moves more than one partial row per
task.  ``COUNT(DISTINCT)`` becomes a two-level aggregate on
``(group, user)``, also partial.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DEEP_READ_SCROLL_PCT, PERFORMANCE_TIERS
from ..functions.rules import pct_or_null, tier

ENGAGEMENT_KEYS = ["day", "section", "publication"]


def engagement_aggs():
    ev = F.col("event_name")
    return [
        F.count_distinct("user_pseudo_id").alias("unique_readers"),
        F.count("*").alias("page_views"),  # all events, not only page_view (kept as defined)
        F.round(F.avg("engagement_time_sec"), 1).alias("avg_engagement_sec"),
        F.count_if(ev == "paywall_hit").alias("paywall_hits"),
        F.count_if(ev == "subscribe_click").alias("subscribe_clicks"),
    ]


def reader_engagement(events: DataFrame) -> DataFrame:
    """C4: daily engagement by section and publication (NULL keys are groups).

    conversion_rate_pct = round(subscribe_clicks / nullif(paywall_hits, 0) * 100, 1).
    """
    agg = (events.withColumn("day", F.col("event_date"))
           .groupBy(*ENGAGEMENT_KEYS).agg(*engagement_aggs()))
    return agg.withColumn("conversion_rate_pct", pct_or_null("subscribe_clicks", "paywall_hits"))


def article_event_stats(events: DataFrame) -> DataFrame:
    """Per-article event statistics (the eager pre-aggregate of C5)."""
    ev = F.col("event_name")
    return (events.where(F.col("article_id").isNotNull())
            .groupBy("article_id")
            .agg(F.count_distinct("user_pseudo_id").alias("unique_readers"),
                 F.round(F.avg("engagement_time_sec"), 1).alias("avg_read_time_sec"),
                 F.count_if(F.col("scroll_pct") >= DEEP_READ_SCROLL_PCT).alias("deep_reads"),
                 F.count_if(ev == "share").alias("shares"),
                 F.count_if(ev == "paywall_hit").alias("paywall_hits"),
                 F.count_if(ev == "subscribe_click").alias("conversions")))


def article_performance(articles: DataFrame, events: DataFrame,
                        tiers=PERFORMANCE_TIERS, strict: bool = False) -> DataFrame:
    """One row per article, even with no events.

    The reference joins articles to raw events and groups by seven article
    columns (fan-out before aggregation).  Here events are aggregated per
    article first and left-joined to the dimension: same result, the join
    sees one row per article instead of one per event.  No events -> counts
    0, average NULL, tier computed on 0.
    """
    stats = article_event_stats(events)
    j = articles.select("article_id", "title", "author", "section", "publication",
                        "published_at", "paywall_type").join(stats, "article_id", "left")
    zero = F.lit(0).cast("long")
    readers = F.coalesce("unique_readers", zero)
    return j.select(
        "article_id", "title", "author", "section", "publication", "published_at", "paywall_type",
        readers.alias("unique_readers"),
        "avg_read_time_sec",
        F.coalesce("deep_reads", zero).alias("deep_reads"),
        F.coalesce("shares", zero).alias("shares"),
        F.coalesce("paywall_hits", zero).alias("paywall_hits"),
        F.coalesce("conversions", zero).alias("conversions"),
        tier(readers, tiers, strict).alias("performance_tier"),
    )
