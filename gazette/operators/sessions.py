"""Sessionization by inactivity gap.

Reference rule: an event opens a new session when the minute-boundary
difference to the same user's previous event exceeds ``gap`` minutes; the
first event of a user gets flag 0; the session number is the running sum of
flags (so it starts at 0 and is unique only per user).

Because the difference counts *minute boundaries*, two events inside the same
clock minute always differ by 0.  Hence only the first event of each
``(user, minute)`` bucket can carry flag 1, and its previous event lies in the
previous occupied bucket of that user.  The default ``method="buckets"``
therefore:

1. reduces events to their distinct ``(user, minute)`` buckets (partial
   aggregation before the shuffle),
2. runs LAG and the running SUM over the buckets of each user, on those two
   columns alone (one row per occupied minute: bounded by the time span, not by
   the event count or by what was read, so a bot user holding a third of all
   events still yields a small window partition),
3. joins the bucket -> session map back on ``(user, minute)``: ``sessionize`` to
   the events, ``sessions`` to the metrics and sets of each bucket (AQE
   broadcasts the map when its measured size allows; a minute is no hot key),
4. groups by ``(user, session_id)`` with partial aggregation.

No tiebreak is needed: ties fall in one minute.  ``method="window"`` is the
direct form (one exchange + one sort over raw events, partitioned by user);
it is exact too, and used as the brute-force check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import boundary_diff

SESSION_COLUMNS = [
    "user_pseudo_id", "session_id", "session_start", "session_end", "session_duration_sec",
    "total_events", "articles_viewed", "total_engagement_sec", "device", "traffic_source",
    "paywall_hits", "subscribe_clicks", "sections_visited",
]


def _flag(prev, cur, gap_minutes: int):
    return F.when(boundary_diff("minute", prev, cur) > F.lit(gap_minutes), F.lit(1)).otherwise(F.lit(0))


def sessionize(events: DataFrame, gap_minutes: int = 30, user: str = "user_pseudo_id",
               ts: str = "event_timestamp", method: str = "buckets",
               order_tiebreak: str | None = "event_id") -> DataFrame:
    """Attach ``session_id`` (long) to every event row."""
    if method == "window":
        order = [F.col(ts).asc_nulls_last()]
        if order_tiebreak and order_tiebreak in events.columns:
            order.append(F.col(order_tiebreak).asc_nulls_last())
        w = Window.partitionBy(user).orderBy(*order)
        flagged = events.withColumn("_flag", _flag(F.lag(ts).over(w), F.col(ts), gap_minutes))
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return flagged.withColumn("session_id", F.sum("_flag").over(run).cast("long")).drop("_flag")

    if method != "buckets":
        raise ValueError(f"unknown method {method!r}")
    ev = events.withColumn("_minute", F.date_trunc("minute", F.col(ts)))
    return _with_numbers(ev, ev, gap_minutes, user).drop("_minute")


def _with_numbers(rows: DataFrame, events: DataFrame, gap_minutes: int, user: str) -> DataFrame:
    """``rows`` (with ``_minute``) and the ``session_id`` of their user's minute, numbered over ``events``."""
    w = Window.partitionBy(user).orderBy(F.col("_minute").asc_nulls_last())
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    smap = (events.select(user, "_minute").distinct()
            .withColumn("_flag", _flag(F.lag("_minute").over(w), F.col("_minute"), gap_minutes))
            .withColumn("session_id", F.sum("_flag").over(run).cast("long"))
            .select(F.col(user).alias("_u"), F.col("_minute").alias("_m"), "session_id"))
    cond = F.col(user).eqNullSafe(F.col("_u")) & F.col("_minute").eqNullSafe(F.col("_m"))
    return rows.join(smap, cond, "inner").drop("_u", "_m")


def sessions(events: DataFrame, gap_minutes: int = 30, method: str = "buckets") -> DataFrame:
    """One row per (user, session number) with engagement metrics."""
    ev, user = F.col("event_name"), "user_pseudo_id"
    metrics = {
        "session_start": (F.min("event_timestamp"), F.min), "session_end": (F.max("event_timestamp"), F.max),
        "total_events": (F.count("*"), F.sum), "total_engagement_sec": (F.sum("engagement_time_sec"), F.sum),
        "device": (F.max("device_category"), F.max), "traffic_source": (F.max("traffic_source"), F.max),
        "paywall_hits": (F.count_if(ev == "paywall_hit"), F.sum),
        "subscribe_clicks": (F.count_if(ev == "subscribe_click"), F.sum),
    }
    sets = {"articles_viewed": F.collect_set("article_id"), "sections_visited": F.collect_set("section")}
    if method == "window":  # row by row: the check of the other form
        rows = sessionize(events, gap_minutes, method=method)
        agg = rows.groupBy(user, "session_id").agg(*[first.alias(n) for n, (first, _) in metrics.items()],
                                                   *[c.alias(n) for n, c in sets.items()])
    else:
        # one row per (user, minute); only those two columns are ordered by user
        events = events.withColumn("_minute", F.date_trunc("minute", "event_timestamp"))
        minutes = events.groupBy(user, "_minute").agg(
            *[first.alias(n) for n, (first, _) in metrics.items()], *[c.alias(n) for n, c in sets.items()])
        agg = (_with_numbers(minutes, events, gap_minutes, user).groupBy(user, "session_id")
               .agg(*[again(n).alias(n) for n, (_, again) in metrics.items()],
                    *[F.array_distinct(F.flatten(F.collect_list(n))).alias(n) for n in sets]))
    return (agg.withColumn("articles_viewed", F.size("articles_viewed").cast("long"))
            .withColumn("sections_visited", F.array_sort("sections_visited"))
            .withColumn("session_duration_sec", boundary_diff("second", "session_start", "session_end"))
            .select(*SESSION_COLUMNS))


def session_summary(sessions_df: DataFrame) -> DataFrame:
    """Invariant summary: session count, events, mean and max events per session."""
    return sessions_df.agg(
        F.count("*").alias("sessions"),
        F.sum("total_events").alias("events"),
        F.round(F.avg("total_events"), 4).alias("avg_events"),
        F.max("total_events").alias("max_events"),
        F.count_distinct("user_pseudo_id").alias("users"),
    )
