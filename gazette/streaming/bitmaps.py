"""Continuous aggregates with exact distinct readers kept as bitmaps.

Distinct counts do not add up, sets of readers do.  Per group and *slot* (a
range of 32,768 reader ids) the state holds one 4 KB bitmap next to the
additive totals of that slot's events.  A micro-batch is aggregated the same
way and merged by OR and by sums, so no history is read: the work is O(batch +
touched buckets).  Late events are merged like others.  A group's distinct
readers are the set bits over its slots.

The state is a versioned table.  The version that a batch makes carries the
batch's id, so data and id become visible together: a replayed batch is
recognised and changes nothing, and readers see whole batches only.  Groups are
spread over buckets by their slots as well, so a group with many readers is no
single bucket.

Reader ids should be dense numbers (``sources/dictionary.py`` makes such from
texts); any long works, at one bitmap for each 32,768 consecutive ids in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DEEP_READ_SCROLL_PCT, PERFORMANCE_TIERS
from ..functions.rules import pct_or_null, tier
from ..sources.dictionary import IdDictionary
from ..sources.versions import BucketTable


class DistinctState:
    """foreachBatch handler: groups by ``keys``, readers as bitmaps, ``sums`` of columns."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], sums: dict[str, Column],
                 reader: str = "user_pseudo_id", spread: list[str] | None = None, buckets: int = 16, keep: int = 2,
                 dictionary: IdDictionary | None = None):
        self.keys, self.sums, self.reader, self.dictionary = keys, sums, reader, dictionary
        self.table = BucketTable(spark, root, [*(spread or keys), "slot"], buckets, keep)

    def delta(self, events: DataFrame) -> DataFrame:
        """Bitmaps and totals of some events, by group and slot; no reader is slot NULL."""
        return (events.withColumn("slot", F.bitmap_bucket_number(self.reader))
                .groupBy(*self.keys, "slot")
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(self.reader)).alias("bits"),
                     *[c.cast("long").alias(n) for n, c in self.sums.items()]))

    def merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys, "slot").agg(
            F.bitmap_or_agg("bits").alias("bits"), *[F.sum(n).cast("long").alias(n) for n in self.sums])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = self.table.manifest()
        if held["note"].get("batch", -1) >= int(batch_id):
            return  # the version that holds this batch is published
        if self.dictionary:  # text readers: numbers for new ones first
            self.dictionary.extend(batch, self.reader)
            batch = self.dictionary.encode(batch, self.reader)
        delta = self.delta(batch).persist()
        try:
            touched = self.table.touched(delta)
            if not touched and held["schema"] is not None:
                return
            state = self.table.read(buckets=touched)
            self.table.replace(delta if state is None else self.merged(state.unionByName(delta)), touched,
                               {"batch": int(batch_id)})
        finally:
            delta.unpersist()

    def totals(self, version: int | None = None) -> DataFrame | None:
        """``keys``, ``readers`` (exact) and the sums of a version; None before the first batch."""
        state = self.table.read(version)
        if state is None:
            return None
        readers = F.sum(F.when(F.col("slot").isNotNull(), F.bitmap_count("bits")).otherwise(0))
        return state.groupBy(*self.keys).agg(readers.cast("long").alias("readers"),
                                             *[F.sum(n).cast("long").alias(n) for n in self.sums])

    def size(self) -> dict:
        """Figures of the current version: buckets, rows (bitmaps), bytes on disk, readers summed over groups."""
        sizes = self.table.sizes()
        row = self.table.read().agg(F.count(F.lit(1)), F.sum(F.bitmap_count("bits"))).first()
        return {"buckets": len(sizes), "bitmaps": row[0], "pairs": row[1] or 0, "bytes": sum(sizes.values())}


class EngagementState(DistinctState):
    """Reader engagement (C4) per day, section and publication; NULLs are groups."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, keep: int = 2,
                 dictionary: IdDictionary | None = None):
        ev = F.col("event_name")
        super().__init__(spark, root, ["event_date", "section", "publication"], {
            "page_views": F.count(F.lit(1)), "eng_sum": F.sum("engagement_time_sec"),
            "eng_cnt": F.count("engagement_time_sec"), "paywall_hits": F.count_if(ev == "paywall_hit"),
            "subscribe_clicks": F.count_if(ev == "subscribe_click")}, spread=["event_date"], buckets=buckets, keep=keep,
            dictionary=dictionary)

    def read(self, version: int | None = None) -> DataFrame | None:
        tot = self.totals(version)
        if tot is None:
            return None
        return tot.select(
            F.col("event_date").alias("day"), "section", "publication", F.col("readers").alias("unique_readers"),
            "page_views",
            F.round(F.col("eng_sum") / F.nullif(F.col("eng_cnt"), F.lit(0).cast("long")), 1).alias("avg_engagement_sec"),
            "paywall_hits", "subscribe_clicks",
            pct_or_null("subscribe_clicks", "paywall_hits").alias("conversion_rate_pct"))


class PerformanceState(DistinctState):
    """Article performance (C5): bitmap state joined with a versioned article dimension.

    The dimension is a table of its own, so edits outlive the driver; an edit
    replaces the buckets of its articles and touches no events.
    """

    COLUMNS = ["article_id", "title", "author", "section", "publication", "published_at", "paywall_type"]

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, keep: int = 2, tiers=None):
        ev = F.col("event_name")
        super().__init__(spark, f"{root}/events", ["article_id"], {
            "eng_sum": F.sum("engagement_time_sec"), "eng_cnt": F.count("engagement_time_sec"),
            "deep_reads": F.count_if(F.col("scroll_pct") >= DEEP_READ_SCROLL_PCT), "shares": F.count_if(ev == "share"),
            "paywall_hits": F.count_if(ev == "paywall_hit"), "conversions": F.count_if(ev == "subscribe_click")},
            buckets=buckets, keep=keep)
        self.tiers = tiers or PERFORMANCE_TIERS
        self.articles = BucketTable(spark, f"{root}/articles", ["article_id"], buckets, keep)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        super().__call__(batch.where(F.col("article_id").isNotNull()), batch_id)

    def set_articles(self, changed: DataFrame) -> None:
        """Insert or replace article rows (one row per id)."""
        changed = changed.select(*self.COLUMNS).persist()
        try:
            touched = self.articles.touched(changed)
            held = self.articles.read(buckets=touched)
            if held is not None:
                changed_rows = held.join(changed.select("article_id"), "article_id", "left_anti") \
                    .select(*self.COLUMNS).unionByName(changed)
            else:
                changed_rows = changed
            self.articles.replace(changed_rows, touched)
        finally:
            changed.unpersist()

    def read(self, version: int | None = None) -> DataFrame:
        """The current (or an older) state of events with the current dimension."""
        arts, tot = self.articles.read(), self.totals(version)
        zero = F.lit(0).cast("long")
        names = ["readers", *self.sums]
        if tot is None:
            rows = arts.select("*", *[F.lit(None).cast("long").alias(n) for n in names])
        else:  # both versions list one file per bucket; the planner sees their sizes
            rows = arts.join(tot, "article_id", "left")
        readers = F.coalesce("readers", zero)
        return rows.select(
            *self.COLUMNS, readers.alias("unique_readers"),
            F.round(F.col("eng_sum") / F.nullif(F.col("eng_cnt"), zero), 1).alias("avg_read_time_sec"),
            *[F.coalesce(n, zero).alias(n) for n in ("deep_reads", "shares", "paywall_hits", "conversions")],
            tier(readers, self.tiers, False).alias("performance_tier"))
