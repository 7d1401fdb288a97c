"""Sessions on a stream by the batch rule (T8, C6): interval state merged with late events.

The state holds one row per user and session: first and last minute, the
additive metrics, and the articles and sections read.  A micro-batch becomes
one row per user and minute.  Two rows of a user belong to one session exactly
if no minute gap above ``gap`` lies between them, and that can be decided on
intervals: in order of their first minute, a row opens a new session if it
begins more than ``gap`` minutes after everything before it ended.  A late event
may so extend a session, join two, or open one in between; the result equals
the batch definition on all events so far.

Only the buckets of a batch's users are read and rewritten, and only those
users' rows are merged.  The ordering works on three narrow columns (user,
first, last minute); sets and sums are attached afterwards by a join, so what a
task sorts for one user is bounded by the minutes of a batch and the sessions so
far, not by what the user read.  Session numbers are given on reading, since a
late session shifts those after it.  The NULL user is a user; events without a
time belong to a user's last session, as in the batch rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import boundary_diff
from ..operators.sessions import SESSION_COLUMNS
from ..sources.versions import BucketTable

USER = "user_pseudo_id"
_ENDS = ["first_minute", "last_minute"]
_SUMS = ["total_events", "total_engagement_sec", "paywall_hits", "subscribe_clicks"]


def minutes(events: DataFrame) -> DataFrame:
    """One interval per user and minute, in the shape of the state."""
    ev = F.col("event_name")
    minute = F.date_trunc("minute", "event_timestamp")
    return (events.groupBy(USER, minute.alias("first_minute"))
            .agg(F.min("event_timestamp").alias("session_start"), F.max("event_timestamp").alias("session_end"),
                 F.count(F.lit(1)).alias("total_events"), F.sum("engagement_time_sec").alias("total_engagement_sec"),
                 F.count_if(ev == "paywall_hit").alias("paywall_hits"),
                 F.count_if(ev == "subscribe_click").alias("subscribe_clicks"),
                 F.max("device_category").alias("device"), F.max("traffic_source").alias("traffic_source"),
                 F.collect_set("article_id").alias("articles"), F.collect_set("section").alias("sections"))
            .withColumn("last_minute", F.col("first_minute")))


def merged(intervals: DataFrame, gap: int) -> DataFrame:
    """Intervals of each user joined into sessions; ``number`` counts them from 0."""
    order = Window.partitionBy(USER).orderBy(F.asc_nulls_last("first_minute"), F.asc_nulls_last("last_minute"))
    reach = F.max("last_minute").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(boundary_diff("minute", reach, F.col("first_minute")) > gap, 1).otherwise(0)
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = (intervals.select(USER, *_ENDS).distinct().withColumn("_opens", opens)
              .withColumn("number", F.sum("_opens").over(run).cast("long"))
              .select(*[F.col(c).alias(f"_{c}") for c in (USER, *_ENDS)], "number"))
    same = F.lit(True)
    for c in (USER, *_ENDS):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    sets = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("articles", "sections")]
    return (intervals.join(narrow, same).groupBy(USER, "number")
            .agg(F.min("first_minute").alias("first_minute"), F.max("last_minute").alias("last_minute"),
                 F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
                 *[F.sum(c).alias(c) for c in _SUMS], F.max("device").alias("device"),
                 F.max("traffic_source").alias("traffic_source"), *sets))


class SessionState:
    """foreachBatch handler keeping all sessions (C6) exact, late events included."""

    def __init__(self, spark: SparkSession, root: str, gap: int = 30, buckets: int = 16, keep: int = 2):
        self.gap = gap
        self.table = BucketTable(spark, root, [USER], buckets, keep)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = self.table.manifest()
        if held["note"].get("batch", -1) >= int(batch_id):
            return  # the version that holds this batch is published
        new = minutes(batch).persist()
        try:
            touched = self.table.touched(new)
            if not touched and held["schema"] is not None:
                return
            state = self.table.read(buckets=touched)
            rows, rest = new, None
            if state is not None:
                users = new.select(F.col(USER).alias("_u")).distinct()
                mine = F.col(USER).eqNullSafe(F.col("_u"))
                rows = new.unionByName(state.join(users, mine, "left_semi"))
                rest = state.join(users, mine, "left_anti")
            timed = merged(rows.where(F.col("first_minute").isNotNull()), self.gap).drop("number")
            # without a time there is nothing to order by yet: one row per user, placed on reading
            untimed = merged(rows.where(F.col("first_minute").isNull()), self.gap).drop("number")
            out = timed.unionByName(untimed)
            out = out if rest is None else out.unionByName(rest)
            self.table.replace(out.select(*new.columns), touched, {"batch": int(batch_id)})
        finally:
            new.unpersist()

    def read(self, version: int | None = None) -> DataFrame | None:
        """The sessions of a version, numbered, in the columns of the batch form."""
        state = self.table.read(version)
        if state is None:
            return None
        return (merged(state, self.gap).withColumnRenamed("number", "session_id")
                .withColumn("articles_viewed", F.size("articles").cast("long"))
                .withColumn("sections_visited", F.array_sort("sections"))
                .withColumn("session_duration_sec", boundary_diff("second", "session_start", "session_end"))
                .select(*SESSION_COLUMNS))
