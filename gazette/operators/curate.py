"""CURATED layer: synthesized article / author dimensions and typed events.

* ``articles_dim``  (C1): one row per distinct non-NULL article id seen in the
  raw feed; attributes are pure functions of the id (hash buckets), so the
  same id always yields the same row.
* ``authors_dim``   (C2): authors actually assigned, with their article count.
* ``typed_events``  (C3): text timestamps parsed, event date added, the
  article's publication attached by a LEFT join (unmatched rows kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import bucket, pick
from ..functions.constants import (
    AUTHORS, PAYWALL_HARD, PAYWALL_NONE, PUBLICATIONS, SECTIONS, SENIORITY,
)
from ..functions.dates import add_hours, as_of_ts, parse_raw_ts

TYPED_EVENT_COLUMNS = [
    "event_name", "event_timestamp", "event_date", "user_pseudo_id", "article_id",
    "section", "publication", "device_category", "browser", "os", "country", "city",
    "traffic_source", "traffic_medium", "engagement_time_sec", "scroll_pct",
]


def article_ids(raw: DataFrame, extra_ids: list | None = None) -> DataFrame:
    """Distinct non-NULL article ids of the feed (+ optional catalogue-only ids)."""
    ids = raw.where(F.col("article_id").isNotNull()).select("article_id")
    if extra_ids:
        extra = raw.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(i).cast(raw.schema["article_id"].dataType) for i in extra_ids])).alias("article_id"))
        ids = ids.unionByName(extra)
    return ids.distinct()


def article_attributes(ids: DataFrame, as_of: str) -> DataFrame:
    """Hash-derived article attributes for a frame with an ``article_id`` column."""
    aid = F.col("article_id")
    sec = pick(SECTIONS, bucket(aid, 9))
    pw = bucket(aid, 10, "pw")
    paywall = (F.when(pw.isin(*PAYWALL_HARD), "hard")
               .when(pw.isin(*PAYWALL_NONE), "none")
               .otherwise("soft"))
    return ids.select(
        aid,
        F.concat(F.lit("Reportage "), sec, F.lit(" #"),
                 F.regexp_replace(aid.cast("string"), r"[^0-9]", "")).alias("title"),
        pick(AUTHORS, bucket(aid, 16, "auth")).alias("author"),
        sec.alias("section"),
        pick(PUBLICATIONS, bucket(aid, 5, "pub")).alias("publication"),
        add_hours(as_of_ts(as_of), -bucket(aid, 1440, "ts")).alias("published_at"),
        (F.lit(300) + bucket(aid, 2200, "wc")).alias("word_count"),
        paywall.alias("paywall_type"),
    )


def articles_dim(raw: DataFrame, as_of: str, extra_ids: list | None = None) -> DataFrame:
    """The article dimension."""
    return article_attributes(article_ids(raw, extra_ids), as_of)


def authors_dim(articles: DataFrame) -> DataFrame:
    """Authors of the articles, ``section = max(section)``."""
    seniority_idx = F.least(bucket("name", 3), F.lit(2))
    return (articles.groupBy(F.col("author").alias("name"))
            .agg(F.max("section").alias("section"), F.count("*").alias("article_count"))
            .select("name", "section",
                    pick(SENIORITY, seniority_idx).alias("seniority"), "article_count"))


def typed_events(raw: DataFrame, articles: DataFrame | None, keep_extra: list | None = None) -> DataFrame:
    """Parse timestamps, add the date, attach ``publication`` (LEFT join).

    Without ``articles`` nothing is joined and ``publication`` is left out.
    The event keeps its own ``section``.  ``keep_extra`` passes further raw
    columns through (e.g. ``event_id`` as a tiebreak, or evolved fields).
    The article side is a dimension; AQE broadcasts it once its measured size
    is under the threshold, else this is a sort-merge join that AQE can split
    for a hot article.
    """
    ts = parse_raw_ts("event_timestamp")
    e = raw.select(
        *[F.col(c) for c in (keep_extra or [])],
        "event_name", ts.alias("event_timestamp"), ts.cast("date").alias("event_date"),
        "user_pseudo_id", "article_id", "section", "device_category", "browser", "os",
        "country", "city", "traffic_source", "traffic_medium", "engagement_time_sec",
        "scroll_pct",
    )
    if articles is None:
        return e
    pub = articles.select("article_id", "publication")
    joined = e.join(pub, on="article_id", how="left")
    return joined.select(*(keep_extra or []), *TYPED_EVENT_COLUMNS)
