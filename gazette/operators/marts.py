"""MARTS: content analytics (C7), subscriber journey (C8) and demo reports.

The marts read the typed events directly (as the reference's models read the
RAW tables) and are pure functions with an explicit ``as_of`` date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CONTENT_TIERS, DEEP_READ_SCROLL_PCT
from ..functions.dates import boundary_diff
from ..functions.rules import pct_or_zero, tier

ARTICLE_COLUMNS = ["article_id", "title", "author", "section", "publication", "published_at",
                   "word_count", "paywall_type"]


def content_article_stats(events: DataFrame) -> DataFrame:
    ev = F.col("event_name")
    return (events.where(F.col("article_id").isNotNull())
            .groupBy("article_id")
            .agg(F.count_distinct("user_pseudo_id").alias("unique_readers"),
                 F.count("*").alias("total_events"),
                 F.avg("engagement_time_sec").alias("avg_engagement_sec"),
                 F.count_if((ev == "scroll") & (F.col("scroll_pct") >= DEEP_READ_SCROLL_PCT)).alias("deep_reads"),
                 F.count_if(ev == "share").alias("shares"),
                 F.count_if(ev == "paywall_hit").alias("paywall_hits"),
                 F.count_if(ev == "subscribe_click").alias("conversions"),
                 F.min("event_timestamp").alias("first_read"),
                 F.max("event_timestamp").alias("last_read")))


def content_analytics(articles: DataFrame, events: DataFrame, tiers=CONTENT_TIERS,
                      strict: bool = True) -> DataFrame:
    """Every article with reader, funnel and lifecycle metrics.

    Missing stats -> 0 for counts and for the average; conversion pct 0 when
    there were no paywall hits; lifespan / time-to-first-read are hour-boundary
    differences from publication (negative allowed, NULL without events).
    """
    stats = content_article_stats(events)
    j = articles.select(*ARTICLE_COLUMNS).join(stats, "article_id", "left")
    zero = F.lit(0).cast("long")
    readers = F.coalesce("unique_readers", zero)
    return j.select(
        *ARTICLE_COLUMNS,
        readers.alias("unique_readers"),
        F.coalesce("total_events", zero).alias("total_events"),
        F.coalesce("avg_engagement_sec", F.lit(0.0)).alias("avg_engagement_sec"),
        F.coalesce("deep_reads", zero).alias("deep_reads"),
        F.coalesce("shares", zero).alias("shares"),
        F.coalesce("paywall_hits", zero).alias("paywall_hits"),
        F.coalesce("conversions", zero).alias("conversions"),
        pct_or_zero("conversions", "paywall_hits").alias("conversion_rate_pct"),
        boundary_diff("hour", "published_at", "last_read").alias("lifespan_hours"),
        boundary_diff("hour", "published_at", "first_read").alias("time_to_first_read_hours"),
        tier(readers, tiers, strict).alias("performance_tier"),
    )


def tier_summary(content: DataFrame) -> DataFrame:
    """C14: articles and mean conversion per tier, most populated first."""
    return (content.groupBy("performance_tier")
            .agg(F.count("*").alias("articles"),
                 F.round(F.avg("conversion_rate_pct"), 4).alias("avg_conversion"))
            .orderBy(F.desc("articles"), F.asc("performance_tier")))


JOURNEY_KEYS = ["user_id", "subscription_type", "subscription_start", "churn_flag",
                "ltv_estimated_eur"]


def subscriber_journey(events: DataFrame, subscribers: DataFrame, as_of) -> DataFrame:
    """Pre-subscription, onboarding and recent behaviour per subscriber.

    Events are first compacted to ``(user, day, article, section)`` grain (all
    journey metrics are day-resolution), then inner-joined to subscribers; the
    five distinct counts run over the compacted rows, so Catalyst's
    distinct-aggregate expansion multiplies far fewer rows.  Subscribers with
    no events are absent (inner join).
    """
    ev = F.col("event_name")
    compact = (events.groupBy(F.col("user_pseudo_id"), F.col("event_date"), "article_id", "section")
               .agg(F.count("*").alias("n"),
                    F.count_if(ev == "page_view").alias("n_pv"),
                    F.sum("engagement_time_sec").alias("eng_sum"),
                    F.count("engagement_time_sec").alias("eng_cnt")))
    subs = subscribers.select(F.col("user_id"), "subscription_type",
                              F.col("start_date").alias("subscription_start"), "churn_flag",
                              "ltv_estimated_eur")
    j = compact.join(subs, compact.user_pseudo_id == subs.user_id, "inner")
    as_of_d = F.lit(str(as_of)).cast("date")
    d = F.datediff(F.col("event_date"), F.col("subscription_start"))
    horizon = F.datediff(as_of_d, F.col("subscription_start")) - F.lit(30)
    pre, first, last = d < 0, d.between(0, 30), d >= horizon
    n = F.col("n")
    zero = F.lit(0).cast("long")
    agg = j.groupBy(*JOURNEY_KEYS).agg(
        F.sum(F.when(pre, n).otherwise(zero)).alias("events_before_sub"),
        F.sum(F.when(pre, F.col("n_pv")).otherwise(zero)).alias("pages_before_sub"),
        F.count_distinct(F.when(pre, F.col("section"))).alias("sections_explored_pre"),
        (F.sum(F.when(pre, F.col("eng_sum")))
         / F.nullif(F.sum(F.when(pre, F.col("eng_cnt"))), zero)).alias("avg_engagement_pre"),
        F.sum(F.when(first, n).otherwise(zero)).alias("events_first_30d"),
        F.count_distinct(F.when(first, F.col("article_id"))).alias("articles_first_30d"),
        F.sum(F.when(last, n).otherwise(zero)).alias("events_last_30d"),
        F.count_distinct(F.when(last, F.col("article_id"))).alias("articles_last_30d"),
        F.sum(n).alias("total_events"),
        F.count_distinct("article_id").alias("total_articles_read"),
        F.count_distinct("section").alias("sections_engaged"),
    )
    first_n, last_n = F.col("events_first_30d"), F.col("events_last_30d")
    trend = (F.when(first_n > 0, F.round((last_n - first_n) / F.nullif(first_n, zero) * F.lit(100), 1))
             .otherwise(F.lit(0.0)))
    out = agg.withColumn("engagement_trend_pct", trend)
    stage = (F.when(F.col("churn_flag") == F.lit(True), "CHURNED")
             .when(last_n == 0, "AT_RISK")
             .when(F.col("engagement_trend_pct") < -50, "DECLINING")
             .when(F.col("engagement_trend_pct") > 50, "GROWING")
             .otherwise("STABLE"))
    return out.withColumn("journey_stage", stage)


def recent_engagement_topn(engagement: DataFrame, as_of, days: int = 7, n: int = 10) -> DataFrame:
    """Last-``days`` engagement rows with most unique readers (total order)."""
    as_of_d = F.lit(str(as_of)).cast("date")
    return (engagement.where(F.col("day") >= F.date_sub(as_of_d, days))
            .orderBy(F.desc("unique_readers"), F.desc("page_views"), F.asc("day"),
                     F.asc_nulls_last("section"), F.asc_nulls_last("publication"))
            .limit(n))
