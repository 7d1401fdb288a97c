"""Plans for the change feed and the streaming jobs.

Each streaming plan stages fixture-derived landing files under the shared
checkpoint folder, drives the stream with ``availableNow`` (several
micro-batches, late events included) and returns the table the stream
maintained, so it can be compared with the batch definition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import PUBLICATIONS, SECTIONS
from ..operators import cdc
from ..session import input_bytes, scratch_path
from ..sources import staging
from ..sources import testdata as td
from ..sources.schemas import TRACKING_SCHEMA
from ..streaming import bitmaps, native, refresh, session_state
from ..streaming import ingest as st_ingest
from . import oracle as O
from .context import Context
from .core import ARTICLE_PERFORMANCE_SQL, READER_ENGAGEMENT_SQL, _sessions_out, _with_sessions
from .ingest import CUTOFF_SQL, RAW_EVOLVED_SQL
from .registry import register

CDC_KEY, CDC_ORDER = ["article_id"], ["change_ts", "change_seq"]
CDC_COLUMNS = ["article_id", "title", "section", "publication", "published_at", "word_count",
               "change_ts", "change_seq"]

CHANGE_FEED_CTE = f"""
feed AS (
  SELECT o_custkey AS article_id, 'Article ' || CAST(o_orderkey AS VARCHAR) AS title,
         {O.sql_pick(SECTIONS, 'o_orderkey % 9')} AS section,
         {O.sql_pick(PUBLICATIONS, 'o_orderkey % 5')} AS publication,
         o_orderdate AS published_at, 300 + CAST(floor(o_totalprice) AS BIGINT) % 2200 AS word_count,
         CASE o_orderstatus WHEN 'P' THEN 'I' WHEN 'O' THEN 'U' ELSE 'D' END AS op,
         o_orderdate AS change_ts, o_orderkey AS change_seq
  FROM orders
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY change_ts DESC, change_seq DESC) AS rn
  FROM feed
),
current_state AS (
  SELECT article_id, title, section, publication, published_at, word_count, change_ts, change_seq
  FROM ranked WHERE rn = 1 AND op <> 'D'
)"""

CDC_SQL = O.with_ctes(CHANGE_FEED_CTE, body="SELECT * FROM current_state")


@register("cdc_current_state", CDC_SQL)
def q_cdc_current_state(spark, sf_dir):
    """T2 batch form: latest image per key, deletes removed."""
    return cdc.current_state(Context(spark, sf_dir).change_feed, CDC_KEY, CDC_ORDER).select(*CDC_COLUMNS)


CALENDAR_COLUMNS = ["article_id", "entry_id", "planned_date", "priority", "change_ts", "change_seq", "change_sub"]
CALENDAR_ORDER = ["change_ts", "change_seq", "change_sub"]
CALENDAR_SQL = """
SELECT article_id, entry_id, planned_date, priority, change_ts, change_seq, change_sub FROM (
  SELECT l_partkey AS article_id, CAST(l_partkey * 4 + l_linenumber % 4 AS BIGINT) AS entry_id,
         CAST(l_shipdate AS DATE) AS planned_date, if(l_linestatus = 'O', 'high', 'normal') AS priority,
         l_returnflag AS flag, l_shipdate AS change_ts, l_orderkey AS change_seq,
         CAST(l_linenumber AS BIGINT) AS change_sub
  FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY change_ts DESC, change_seq DESC, change_sub DESC) = 1
        AND flag <> 'R'"""
AUTHORS_SQL = """
SELECT s_suppkey AS author_id, s_name AS name, [{sections}][1 + (s_suppkey + 2) % 9] AS section,
       s_suppkey * 10 + 2 AS bio_rev, CAST(2 AS BIGINT) AS change_seq
FROM supplier WHERE s_suppkey % 7 <> 0""".replace("{sections}", ", ".join(f"'{x}'" for x in SECTIONS))


@register("cdc_calendar_state", CALENDAR_SQL)
def q_cdc_calendar_state(spark, sf_dir):
    """T2 on the editorial calendar, keyed by entry: an article keeps all its entries."""
    feed = td.calendar_change_feed(spark, sf_dir)
    return cdc.current_state(feed, ["entry_id"], CALENDAR_ORDER).select(*CALENDAR_COLUMNS)


def _replayed(spark, feed, name, key, order, by, volume, files=4):
    """``feed`` written as landing files, changes out of order, and merged in several batches."""
    landing = scratch_path(spark, f"{name}-landing")
    for i in range(files):
        feed.where(F.pmod(F.xxhash64(by), F.lit(files)) == i).write.mode("append").parquet(landing)
    # as many micro-batches as pieces, whatever the number of files: each one rewrites the buckets it touches
    per_batch = -(-len(spark.read.schema(feed.schema).parquet(landing).inputFiles()) // files)
    store = cdc.SnapshotStore(spark, scratch_path(spark, f"{name}-snapshot"), buckets=cdc.buckets_for(volume))
    return st_ingest.apply_change_stream(spark, landing, feed.schema, store, key, order,
                                         scratch_path(spark, f"{name}-ckpt"), max_files=per_batch).current()


@register("cdc_calendar_stream", CALENDAR_SQL)
def q_cdc_calendar_stream(spark, sf_dir):
    """S9 on the editorial calendar: the change rows as a stream."""
    feed = td.calendar_change_feed(spark, sf_dir)
    return _replayed(spark, feed, "calendar", ["entry_id"], CALENDAR_ORDER, "change_seq",
                     input_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")).select(*CALENDAR_COLUMNS)


@register("cdc_authors_stream", AUTHORS_SQL)
def q_cdc_authors_stream(spark, sf_dir):
    """S9 on authors: inserts, updates and deletes, changes of an author in several batches."""
    feed = td.authors_change_feed(spark, sf_dir)
    return _replayed(spark, feed, "authors", ["author_id"], ["change_seq"], "change_seq",
                     input_bytes(spark, f"{sf_dir.rstrip('/')}/supplier.parquet")).select(
        "author_id", "name", "section", "bio_rev", "change_seq")


def _cdc_stream(spark, sf_dir):
    landing, files = staging.stage_change_feed(spark, sf_dir)
    schema = Context(spark, sf_dir).change_feed.schema
    # state is at most the size of the change log; size buckets from it
    nb = cdc.buckets_for(input_bytes(spark, f"{sf_dir.rstrip('/')}/orders.parquet"))
    store = cdc.SnapshotStore(spark, scratch_path(spark, "cdc-snapshot"), buckets=nb)
    handler = st_ingest.apply_change_stream(spark, landing, schema, store, CDC_KEY, CDC_ORDER,
                                            scratch_path(spark, "cdc-ckpt"), max_files=max(1, files // 4))
    return handler.current().select(*CDC_COLUMNS)


@register("cdc_stream_state", CDC_SQL)
def q_cdc_stream_state(spark, sf_dir):
    """T2 / S9 streaming form: micro-batches merged into versioned snapshots."""
    return _cdc_stream(spark, sf_dir)


@register("latest_articles_top5", O.with_ctes(CHANGE_FEED_CTE, body="""
SELECT article_id, title, section, published_at FROM current_state
ORDER BY published_at DESC, article_id DESC LIMIT 5"""))
def q_latest_articles_top5(spark, sf_dir):
    """Newest articles of the replicated CMS table."""
    state = cdc.current_state(Context(spark, sf_dir).change_feed, CDC_KEY, CDC_ORDER)
    return (cdc.latest_topn(state, "published_at", 5, "article_id")
            .select("article_id", "title", "section", "published_at"))


def _typed_stream(spark, sf_dir, groups_per_batch: int = 1, late_every: int | None = 20):
    """Typed events replayed as a file stream, ``groups_per_batch`` time groups per micro-batch."""
    ctx = Context(spark, sf_dir)
    landing, per_group = refresh.stage_typed_events(ctx.events, spark, late_every=late_every)
    stream = (spark.readStream.schema(ctx.events.schema)
              .option("maxFilesPerTrigger", per_group * groups_per_batch).parquet(landing))
    return ctx, stream


def _state_buckets(sf_dir, spark):
    return cdc.buckets_for(input_bytes(spark, f"{sf_dir.rstrip('/')}/events.parquet"))


@register("engagement_stream", O.with_events(READER_ENGAGEMENT_SQL))
def q_engagement_stream(spark, sf_dir):
    """Reader engagement kept by merging bitmaps of readers; late events included."""
    _, stream = _typed_stream(spark, sf_dir)
    h = bitmaps.EngagementState(spark, scratch_path(spark, "reader-engagement"), _state_buckets(sf_dir, spark))
    refresh.run_available_now(stream, h, scratch_path(spark, "engagement-ckpt"))
    return h.read()


@register("engagement_incremental", O.with_events(READER_ENGAGEMENT_SQL))
def q_engagement_incremental(spark, sf_dir):
    """T3, additive form: per-group totals + first-seen reader tuples by day."""
    _, stream = _typed_stream(spark, sf_dir)
    h = refresh.EngagementIncremental(scratch_path(spark, "reader-engagement-inc"))
    refresh.run_available_now(stream, h, scratch_path(spark, "engagement-inc-ckpt"))
    return h.read(spark)


@register("performance_stream", O.with_events(ARTICLE_PERFORMANCE_SQL))
def q_performance_stream(spark, sf_dir):
    """T4: article performance kept by merging bitmaps of readers, on a stored dimension."""
    ctx, stream = _typed_stream(spark, sf_dir)
    h = bitmaps.PerformanceState(spark, scratch_path(spark, "article-performance"), _state_buckets(sf_dir, spark))
    h.set_articles(ctx.articles)
    refresh.run_available_now(stream, h, scratch_path(spark, "performance-ckpt"))
    return h.read()


@register("performance_incremental", O.with_events(ARTICLE_PERFORMANCE_SQL))
def q_performance_incremental(spark, sf_dir):
    """T4, additive form: per-article totals + first-seen reader pairs."""
    ctx, stream = _typed_stream(spark, sf_dir)
    nb = cdc.buckets_for(input_bytes(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    h = refresh.PerformanceIncremental(scratch_path(spark, "article-performance-inc"), ctx.articles, buckets=nb)
    h.publish(spark)
    refresh.run_available_now(stream, h, scratch_path(spark, "performance-inc-ckpt"))
    return h.read(spark)


@register("file_ingest_dedup", f"""
SELECT r.*, CASE WHEN event_id >= {CUTOFF_SQL} THEN 9007199254740993 + event_id END AS visit_token,
       CASE WHEN event_id >= (SELECT (count(*) * 8) // 10 FROM events) THEN event_id % 7 + 0.25::DOUBLE
            WHEN event_id >= {CUTOFF_SQL} THEN CAST(event_id % 7 AS DOUBLE) END AS read_depth
FROM ({RAW_EVOLVED_SQL}) r""")
def q_file_ingest_dedup(spark, sf_dir):
    """File-arrival ingest in three folders, the first one twice (replay adds
    nothing); late fields keep all digits, and a whole number turns fractional."""
    paths = staging.stage_open_numbers(spark, sf_dir)
    raw_path, ckpt = scratch_path(spark, "raw-tracking-stream"), scratch_path(spark, "ingest-ckpt")
    for landing in (*paths, paths[0]):
        h = st_ingest.ingest_files(spark, landing, raw_path, f"{ckpt}/{landing.rsplit('/', 1)[-1]}",
                                   TRACKING_SCHEMA, glob="*.json*")
    return h.read(spark)


NATIVE_SESSIONS_SQL = O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, """
flagged AS (
  SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS f
  FROM ev WINDOW w AS (PARTITION BY user_pseudo_id ORDER BY event_timestamp, event_id)
), numbered AS (
  SELECT *, sum(f) OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM flagged
)""", body="""
SELECT user_pseudo_id, min(event_timestamp) AS session_start,
       max(event_timestamp) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS total_events, CAST(sum(engagement_time_sec) AS BIGINT) AS total_engagement_sec,
       count(CASE WHEN event_name = 'paywall_hit' THEN 1 END) AS paywall_hits
FROM numbered GROUP BY user_pseudo_id, s""")


@register("session_stream", NATIVE_SESSIONS_SQL)
def q_session_stream(spark, sf_dir):
    """session_window sessions on a stream (elapsed-gap rule).

    Fed in event-time order: rows later than the watermark are dropped by
    design in the native variants (late data is the job of T3/T4)."""
    _, stream = _typed_stream(spark, sf_dir, groups_per_batch=2, late_every=None)
    agg = native.native_sessions(stream)
    return native.run_to_table(agg, scratch_path(spark, "native-sessions"), mode="complete")


@register("engagement_window_stream", O.with_events("""
SELECT event_date AS day, section, count(*) AS page_views,
       count(CASE WHEN event_name = 'paywall_hit' THEN 1 END) AS paywall_hits,
       count(CASE WHEN event_name = 'subscribe_click' THEN 1 END) AS subscribe_clicks
FROM ev GROUP BY 1, 2"""))
def q_engagement_window_stream(spark, sf_dir):
    """One-day tumbling windows per section with a watermark (exact columns checked)."""
    _, stream = _typed_stream(spark, sf_dir, groups_per_batch=2, late_every=None)
    agg = native.daily_windows(stream, approx_readers=False)
    return native.run_to_table(agg, scratch_path(spark, "native-windows"), mode="complete")



@register("sessions_stream", _with_sessions(30, "SELECT * FROM sess"))
def q_sessions_stream(spark, sf_dir):
    """T8 by the C6 rule: interval state merged with late events (every 20th event comes last)."""
    _, stream = _typed_stream(spark, sf_dir, groups_per_batch=2)
    h = session_state.SessionState(spark, scratch_path(spark, "session-state"), 30, _state_buckets(sf_dir, spark))
    refresh.run_available_now(stream, h, scratch_path(spark, "session-state-ckpt"))
    return _sessions_out(h.read())


CLOSED_DAYS_CTE = """
closed AS (
  SELECT * FROM ev WHERE CAST(event_date AS TIMESTAMP) + INTERVAL 1 DAY
                         <= (SELECT max(event_timestamp) FROM ev) - INTERVAL 6 DAY
)"""


def _closed_days(spark, sf_dir):
    """Days closed by the watermark, with sketches; rows come up to one group (about five days) late."""
    ctx = Context(spark, sf_dir)
    landing, per_group = refresh.stage_typed_events(ctx.events, spark, late_every=20, late_groups=1)
    stream = spark.readStream.schema(ctx.events.schema).option("maxFilesPerTrigger", per_group).parquet(landing)
    agg = native.daily_windows(stream, watermark="6 days", approx_readers=False, sketch=True)
    return ctx, native.run_to_table(agg, scratch_path(spark, "closed-days"), mode="append")


def _estimates(rows, exact, keys):
    """``rows`` with a 0/1 column: the sketch's estimate is within 4 % (five standard errors) of the exact count."""
    same = [rows[k].eqNullSafe(exact[k]) for k in keys]
    near = F.abs(F.hll_sketch_estimate("readers_sketch") - F.col("readers")) <= 0.04 * F.col("readers")
    return rows.join(exact, same).select(*[rows[k] for k in keys], "page_views", "paywall_hits", "subscribe_clicks",
                                         near.cast("int").alias("estimate_within_bound"))


_WINDOW_SQL = """
SELECT {key} AS {name}, section, count(*) AS page_views, count(*) FILTER (WHERE event_name = 'paywall_hit') AS paywall_hits,
       count(*) FILTER (WHERE event_name = 'subscribe_click') AS subscribe_clicks, 1 AS estimate_within_bound
FROM closed GROUP BY 1, 2"""


@register("engagement_window_append", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, CLOSED_DAYS_CTE,
                                                  body=_WINDOW_SQL.format(key="event_date", name="day")))
def q_engagement_window_append(spark, sf_dir):
    """T9 in append mode: days leave the state once the watermark closes them, late rows included."""
    ctx, days = _closed_days(spark, sf_dir)
    exact = ctx.events.groupBy(F.col("event_date").alias("day"), "section").agg(
        F.count_distinct("user_pseudo_id").alias("readers"))
    return _estimates(days, exact, ["day", "section"])


@register("engagement_weeks_sketch", O.with_ctes(
    O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, CLOSED_DAYS_CTE,
    body=_WINDOW_SQL.format(key="CAST(date_trunc('week', event_date) AS DATE)", name="week")))
def q_engagement_weeks_sketch(spark, sf_dir):
    """Closed days' reader sketches merged into weeks without reading events again."""
    ctx, days = _closed_days(spark, sf_dir)
    weeks = native.merged_windows(days, "week")
    week = F.date_trunc("week", "event_date").cast("date").alias("week")
    last = days.agg(F.max("day")).first()[0]
    exact = ctx.events.where(F.col("event_date") <= F.lit(last)).groupBy(week, "section").agg(
        F.count_distinct("user_pseudo_id").alias("readers"))
    return _estimates(weeks, exact, ["week", "section"])
