"""Independent SQL statements of every checked query (DuckDB dialect).

They restate the fixture mapping and each operator's semantics from the
specification, over the raw driver tables, so the Spark plans can be checked
against a second engine.  Shared CTEs are composed as text.
"""

from __future__ import annotations

from ..functions.constants import (
    AUTHORS, BROWSERS, COUNTRIES, DEVICES, FR_CITIES, MEDIUMS, OS_LIST, PUBLICATIONS,
    SECTIONS, SOURCES, CONSENT_STATES, AB_VARIANTS,
)
from ..sources import testdata as td


def sql_bucket(expr: str, n: int, salt: str = "") -> str:
    """Hash bucket: 15 hex digits of the MD5 of the key's text (and ``:salt``), as a number modulo ``n``."""
    text = f"concat({expr}, ':{salt}')" if salt else f"CAST({expr} AS VARCHAR)"
    return f"CASE WHEN ({expr}) IS NOT NULL THEN CAST(concat('0x', left(md5({text}), 15)) AS BIGINT) % {n} END"


def sql_pick(values: list, index: str) -> str:
    """The value at a 0-based place of a list."""
    quoted = ("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{', '.join(quoted)}], 1 + ({index}))"


def churn_score(days: str, reads: str, bounces: str) -> str:
    """M11 in words of its definition: 60 % recency over 90 days, 25 % reading missed of 60, 15 % bounces of 30."""
    return (f"0.6::DOUBLE * ({days} / 90::DOUBLE) + 0.25::DOUBLE * (1 - if({reads} < 60, {reads}, 60) / 60::DOUBLE)"
            f" + 0.15::DOUBLE * (if({bounces} < 30, {bounces}, 30) / 30::DOUBLE)")


def segment(reads: str, days: str) -> str:
    """The first rule that holds of loyal, regular, dormant, casual."""
    return (f"if({reads} >= 60 AND {days} <= 7, 'loyal', if({reads} >= 20, 'regular', if({days} >= 45, 'dormant', 'casual')))")


def _event_name_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in td.EVENT_NAME_MAP)
    return f"CASE {col} {whens} ELSE '{td.EVENT_NAME_DEFAULT}' END"


ARTICLE_EXPR = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# raw tracking feed with typed timestamp (text round trip == second truncation)
EV_CTE = f"""
ev_base AS (
  SELECT event_id, user_id, ts, value, event_type, {ARTICLE_EXPR} AS article_id FROM events
),
ev_raw AS (
  SELECT event_id,
    {_event_name_sql('event_type')} AS event_name,
    date_trunc('second', ts) AS event_timestamp,
    CAST(date_trunc('second', ts) AS DATE) AS event_date,
    user_id AS user_pseudo_id,
    article_id,
    {sql_pick(SECTIONS, 'article_id % 9')} AS section,
    {sql_pick(DEVICES, 'event_id % 3')} AS device_category,
    {sql_pick(BROWSERS, 'event_id % 5')} AS browser,
    {sql_pick(OS_LIST, 'user_id % 5')} AS os,
    {sql_pick(COUNTRIES, 'user_id % 9')} AS country,
    {sql_pick(FR_CITIES, 'user_id % 10')} AS city,
    {sql_pick(SOURCES, 'event_id % 6')} AS traffic_source,
    {sql_pick(MEDIUMS, '(event_id // 6) % 6')} AS traffic_medium,
    CAST(floor(value) AS BIGINT) AS engagement_time_sec,
    (event_id * 37) % 101 AS scroll_pct,
    {sql_pick(CONSENT_STATES, 'event_id % 3')} AS consent_state,
    round(value / 5, 1) AS engagement_score,
    {sql_pick(AB_VARIANTS, 'event_id % 4')} AS ab_test_variant
  FROM ev_base
)"""

_unread = ", ".join(f"({i})" for i in td.UNREAD_ARTICLE_IDS)

ARTICLES_CTE = f"""
art_ids AS (
  SELECT DISTINCT article_id FROM ev_raw WHERE article_id IS NOT NULL
  UNION SELECT * FROM (VALUES {_unread}) t(article_id)
),
articles AS (
  SELECT article_id,
    'Reportage ' || {sql_pick(SECTIONS, sql_bucket('article_id', 9))} || ' #'
      || regexp_replace(CAST(article_id AS VARCHAR), '[^0-9]', '', 'g') AS title,
    {sql_pick(AUTHORS, sql_bucket('article_id', 16, 'auth'))} AS author,
    {sql_pick(SECTIONS, sql_bucket('article_id', 9))} AS section,
    {sql_pick(PUBLICATIONS, sql_bucket('article_id', 5, 'pub'))} AS publication,
    TIMESTAMP '{td.ARTICLE_AS_OF_TS}' - to_hours({sql_bucket('article_id', 1440, 'ts')}) AS published_at,
    300 + {sql_bucket('article_id', 2200, 'wc')} AS word_count,
    CASE WHEN {sql_bucket('article_id', 10, 'pw')} IN (8, 9) THEN 'hard'
         WHEN {sql_bucket('article_id', 10, 'pw')} IN (0, 1, 2) THEN 'none'
         ELSE 'soft' END AS paywall_type
  FROM art_ids
)"""

EVENTS_CTE = """
ev AS (
  SELECT r.event_id, r.event_name, r.event_timestamp, r.event_date, r.user_pseudo_id,
         r.article_id, r.section, a.publication, r.device_category, r.browser, r.os,
         r.country, r.city, r.traffic_source, r.traffic_medium, r.engagement_time_sec,
         r.scroll_pct
  FROM ev_raw r LEFT JOIN articles a ON r.article_id = a.article_id
)"""

SUBSCRIBERS_CTE = f"""
subs_base AS (
  SELECT c_custkey AS k, c_name, c_acctbal,
         c_custkey % 91 AS dsl, (c_custkey * 7) % 121 AS reads, (c_custkey * 11) % 31 AS bounces
  FROM customer
),
subscribers AS (
  SELECT k AS user_id, c_name AS full_name,
    lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    '+33 6 11 22 33 ' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') AS phone,
    CASE k % 4 WHEN 0 THEN 'student' WHEN 1 THEN 'digital_only' WHEN 2 THEN 'standard' ELSE 'premium' END
      AS subscription_type,
    CAST(DATE '{td.SUBSCRIPTION_EPOCH}' + CAST(k % 60 AS INTEGER) AS DATE) AS start_date,
    CAST(DATE '{td.SUBSCRIBER_AS_OF}' - CAST(dsl AS INTEGER) AS TIMESTAMP) AS last_login,
    reads AS articles_read_30d,
    30 + (k * 13) % 1171 AS avg_session_sec,
    bounces AS paywall_bounces_30d,
    c_acctbal AS ltv_estimated_eur,
    {segment('reads', 'dsl')} AS segment,
    ({churn_score('dsl', 'reads', 'bounces')}) > 0.5 AS churn_flag
  FROM subs_base
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def ladder(value: str, tiers, strict: bool) -> str:
    """Label by the number of thresholds that a value passes."""
    op = ">" if strict else ">="
    labels = ["LOW"] + [name for name, _ in reversed(tiers)]
    passed = " + ".join(f"CAST(({value}) {op} {t} AS INTEGER)" for _, t in tiers)
    return f"{labels!r}[1 + {passed}]"


def content_ctes(tiers, strict: bool, deep: int) -> str:
    """Content mart over CTEs ``ev`` and ``articles``: counts per event kind, then one row per article."""
    def kind(name: str, what: str = "n") -> str:
        return f"COALESCE(sum({what}) FILTER (WHERE event_name = '{name}'), 0)"

    return f"""
kinds AS (
  SELECT article_id, event_name, count(*) AS n, count(*) FILTER (WHERE scroll_pct >= {deep}) AS deep
  FROM ev GROUP BY ALL
),
tallies AS (
  SELECT article_id, CAST(sum(n) AS BIGINT) AS n_all, CAST({kind('scroll', 'deep')} AS BIGINT) AS n_deep,
         CAST({kind('share')} AS BIGINT) AS n_share, CAST({kind('paywall_hit')} AS BIGINT) AS n_wall,
         CAST({kind('subscribe_click')} AS BIGINT) AS n_sub
  FROM kinds GROUP BY article_id
),
reading AS (
  SELECT article_id, avg(engagement_time_sec) AS mean_time, min(event_timestamp) AS t0, max(event_timestamp) AS t1,
         (SELECT count(*) FROM (SELECT DISTINCT article_id, user_pseudo_id FROM ev WHERE user_pseudo_id IS NOT NULL) r
          WHERE r.article_id = x.article_id) AS n_readers
  FROM ev x GROUP BY article_id
),
content AS (
  SELECT art.article_id, art.title, art.author, art.section, art.publication, art.published_at, art.word_count,
         art.paywall_type, IFNULL(n_readers, 0) AS unique_readers, IFNULL(n_all, 0) AS total_events,
         IFNULL(mean_time, 0) AS avg_engagement_sec, IFNULL(n_deep, 0) AS deep_reads, IFNULL(n_share, 0) AS shares,
         IFNULL(n_wall, 0) AS paywall_hits, IFNULL(n_sub, 0) AS conversions,
         IFNULL(round(n_sub / nullif(n_wall, 0) * 100, 1), 0) AS conversion_rate_pct,
         date_diff('hour', art.published_at, t1) AS lifespan_hours,
         date_diff('hour', art.published_at, t0) AS time_to_first_read_hours,
         {ladder('IFNULL(n_readers, 0)', tiers, strict)} AS performance_tier
  FROM articles art LEFT JOIN tallies USING (article_id) LEFT JOIN reading USING (article_id)
)"""


def with_events(body: str) -> str:
    return with_ctes(EV_CTE, ARTICLES_CTE, EVENTS_CTE, body=body)
