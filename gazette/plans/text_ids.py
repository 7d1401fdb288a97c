"""Text identifiers end to end (S1, J1, S15): load, number, aggregate, translate back.

The feed's readers are ``u<n>``, its articles ``art-<n>``, and every thirteenth
event has no article.  Ids are texts in the RAW schema; readers get stable
numbers from a dictionary where a numeric id pays (bitmaps), articles stay
texts as keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, audit, curate
from ..operators import sessions as sessions_op
from ..session import materialize, scratch_path
from ..sources import json_loader, staging
from ..sources import testdata as td
from ..sources.dictionary import IdDictionary
from ..sources.schemas import TRACKING_TEXT_SCHEMA
from ..streaming import bitmaps, refresh
from . import oracle as O
from .core import ARTICLE_PERFORMANCE_SQL, READER_ENGAGEMENT_SQL, _sessions_out, _sessions_sql
from .registry import register
from .streams import _state_buckets

_EV = O.EV_CTE.replace("ev_raw AS (", "ev_numbered AS (") + """,
ev_raw AS (
  SELECT * REPLACE ('u' || user_pseudo_id AS user_pseudo_id,
                    CASE WHEN event_id % 13 <> 0 THEN 'art-' || article_id END AS article_id) FROM ev_numbered
)"""
UNREAD = [f"art-{i}" for i in td.UNREAD_ARTICLE_IDS]
_ARTICLES = O.ARTICLES_CTE.replace(O._unread, ", ".join(f"('{i}')" for i in UNREAD))


def _sql(*ctes: str, body: str) -> str:
    return O.with_ctes(_EV, _ARTICLES, O.EVENTS_CTE, *ctes, body=body)


def _load(spark, sf_dir):
    """RAW events with text ids, loaded once from NDJSON, and the dictionary of their readers."""
    raw = materialize(json_loader.load_ndjson(spark, staging.stage_text_tracking(spark, sf_dir), TRACKING_TEXT_SCHEMA),
                      "raw-text-ids")
    return raw, IdDictionary(spark, scratch_path(spark, "reader-ids"), _state_buckets(sf_dir, spark))


def _curated(raw):
    articles = materialize(curate.articles_dim(raw, td.ARTICLE_AS_OF_TS, UNREAD), "text-articles")
    return articles, curate.typed_events(raw, articles, keep_extra=["event_id"])


@register("text_id_tracking", _sql(body="""
SELECT event_id, event_name, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp, user_pseudo_id,
       article_id, section FROM ev_raw"""))
def q_text_id_tracking(spark, sf_dir):
    """Text ids loaded, coded by the dictionary (two batches) and translated back."""
    raw, ids = _load(spark, sf_dir)
    for half in (0, 1):
        ids.extend(raw.where(F.pmod("event_id", F.lit(2)) == half), "user_pseudo_id", "article_id")
    coded = ids.encode(raw, "user_pseudo_id", "article_id")
    return ids.decode(coded, "user_pseudo_id", "article_id").select(
        "event_id", "event_name", "event_timestamp", "user_pseudo_id", "article_id", "section")


@register("text_id_audit", _sql(body="""
SELECT 'GA4_TRACKING' AS tbl, count(*) AS n FROM ev_raw
UNION ALL SELECT 'ARTICLES', count(*) FROM articles
UNION ALL SELECT 'GA4_EVENTS', count(*) FROM ev
UNION ALL SELECT 'GA4_EVENTS_no_pub', count(*) FROM ev WHERE publication IS NULL"""))
def q_text_id_audit(spark, sf_dir):
    """S15 with orphans: events without an article have no publication and are counted."""
    raw, _ = _load(spark, sf_dir)
    articles, events = _curated(raw)
    return audit.row_audit({"GA4_TRACKING": raw, "ARTICLES": articles, "GA4_EVENTS": events},
                           {"GA4_EVENTS_no_pub": ("GA4_EVENTS", "publication")})


@register("text_id_performance", _sql(body=ARTICLE_PERFORMANCE_SQL))
def q_text_id_performance(spark, sf_dir):
    """J1 / J2 / C5 on text keys; events without an article count for none."""
    articles, events = _curated(_load(spark, sf_dir)[0])
    return aggregates.article_performance(articles, events)


@register("text_id_sessions", _sql(_sessions_sql(30), body="SELECT * FROM sess"))
def q_text_id_sessions(spark, sf_dir):
    """C6 for text readers."""
    raw, _ = _load(spark, sf_dir)
    return _sessions_out(sessions_op.sessions(curate.typed_events(raw, None, keep_extra=["event_id"]), 30))


@register("text_id_engagement_stream", _sql(body=READER_ENGAGEMENT_SQL))
def q_text_id_engagement_stream(spark, sf_dir):
    """T3 on text readers: each batch extends the dictionary, bitmaps hold the numbers."""
    raw, ids = _load(spark, sf_dir)
    _, events = _curated(raw)
    landing, per_group = refresh.stage_typed_events(events, spark, files=3)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_group).parquet(landing)
    h = bitmaps.EngagementState(spark, scratch_path(spark, "text-engagement"), _state_buckets(sf_dir, spark), dictionary=ids)
    refresh.run_available_now(stream, h, scratch_path(spark, "text-engagement-ckpt"))
    return h.read()
