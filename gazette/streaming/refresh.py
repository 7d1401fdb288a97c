"""Continuously refreshed tables as Structured Streaming jobs.

The reference keeps READER_ENGAGEMENT (5 min) and ARTICLE_PERFORMANCE (10
min) fresh with incremental refresh.  Spark has no incremental view
maintenance, and streaming aggregation refuses exact COUNT(DISTINCT), so the
handlers below recompute only what a micro-batch touched:

* events are appended to a RAW table partitioned by ``event_date`` (and the
  batch id, so a replayed batch overwrites its own files: idempotent);
* reader engagement: the batch's distinct days (bounded by the calendar)
  are recomputed from RAW with partition pruning and written with dynamic
  partition overwrite, so late events simply re-touch their old day;
* article performance: the output is partitioned by an article hash bucket;
  the touched buckets are recomputed for every article of the dimension
  (unread articles included) and overwritten.

Exact distinct counts are kept; results equal the batch definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DEEP_READ_SCROLL_PCT
from ..operators import aggregates
from ..session import path_exists, scratch_path
from ..sources.versions import Versions

ARTICLE_BUCKETS = 32


def article_bucket(col="article_id", buckets: int = ARTICLE_BUCKETS):
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets))


def _overwrite(df: DataFrame, path: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


class RawAppender:
    """Idempotent append of typed events into RAW, partitioned by day and batch."""

    def __init__(self, raw_path: str):
        self.raw_path = raw_path

    def append(self, batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch.withColumn("_batch", F.lit(int(batch_id))), self.raw_path,
                   "event_date", "_batch")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.raw_path).drop("_batch")


class EngagementRefresh:
    """foreachBatch handler keeping reader engagement (C4) exact per day."""

    def __init__(self, raw_path: str, out_path: str):
        self.raw = RawAppender(raw_path)
        self.out_path = out_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            self.raw.append(batch, batch_id)
            days = [r[0] for r in batch.select("event_date").distinct().collect()]
        finally:
            batch.unpersist()
        if not days:
            return
        known = [d for d in days if d is not None]
        cond = F.col("event_date").isin(known) if known else F.lit(False)
        if len(known) < len(days):      # events without a date form their own group
            cond = cond | F.col("event_date").isNull()
        touched = self.raw.read(spark).where(cond)
        _overwrite(aggregates.reader_engagement(touched), self.out_path, "day")


class PerformanceRefresh:
    """foreachBatch handler keeping article performance (C5) exact per bucket."""

    def __init__(self, raw_path: str, out_path: str, articles: DataFrame, tiers=None):
        self.raw = RawAppender(raw_path)
        self.out_path = out_path
        self.articles = articles.withColumn("_bucket", article_bucket())
        self.tiers = tiers

    def _compute(self, events: DataFrame, articles: DataFrame) -> DataFrame:
        kw = {"tiers": self.tiers} if self.tiers else {}
        return (aggregates.article_performance(articles, events, **kw)
                .withColumn("_bucket", article_bucket()))

    def initialize(self, spark: SparkSession) -> None:
        """INITIALIZE ON CREATE: every article, no events yet."""
        empty = self.raw_schema_empty(spark)
        _overwrite(self._compute(empty, self.articles.drop("_bucket")), self.out_path, "_bucket")

    def raw_schema_empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], "article_id long, user_pseudo_id long, engagement_time_sec long, "
                                         "scroll_pct long, event_name string")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            self.raw.append(batch, batch_id)
            buckets = [r[0] for r in batch.select(article_bucket().alias("b")).distinct().collect()]
        finally:
            batch.unpersist()
        buckets = [b for b in buckets if b is not None]
        if not buckets:
            return
        events = self.raw.read(spark).where(article_bucket().isin(buckets))
        arts = self.articles.where(F.col("_bucket").isin(buckets)).drop("_bucket")
        _overwrite(self._compute(events, arts), self.out_path, "_bucket")

    def apply_dimension_change(self, spark: SparkSession, changed: DataFrame) -> None:
        """A CMS edit of article rows: swap them into the dimension and
        recompute only the buckets of the changed ids (from RAW)."""
        changed = changed.select(*[c for c in self.articles.columns if c != "_bucket"]) \
            .withColumn("_bucket", article_bucket())
        keep = self.articles.join(changed.select("article_id"), "article_id", "left_anti")
        self.articles = keep.unionByName(changed)
        buckets = [r[0] for r in changed.select("_bucket").distinct().collect()]
        if not buckets:
            return
        if path_exists(spark, self.raw.raw_path):
            events = self.raw.read(spark).where(article_bucket().isin(buckets))
        else:  # nothing ingested yet
            events = self.raw_schema_empty(spark)
        arts = self.articles.where(F.col("_bucket").isin(buckets)).drop("_bucket")
        _overwrite(self._compute(events, arts), self.out_path, "_bucket")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.out_path).drop("_bucket")


def run_available_now(stream: DataFrame, handler, checkpoint: str, name: str | None = None):
    """Drive a foreachBatch stream over everything available, then stop."""
    w = (stream.writeStream.foreachBatch(handler)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def stage_typed_events(events: DataFrame, spark: SparkSession, files: int = 6,
                       late_every: int | None = 20, late_groups: int | None = None) -> tuple[str, int]:
    """Write typed events as time-ordered groups of files, oldest group first.

    Group ``k`` holds days ``[5k+1, 5k+5]`` of the month.  With ``late_every``
    every n-th event is held back into the last group (or by ``late_groups``
    groups), so later micro-batches carry late events for old days.  Each group is written by all task slots
    (one file per slot, never a single-task write); groups are written one
    after another so the stream's modification-time order is the time order.
    Returns ``(path, files_per_group)``: read with ``maxFilesPerTrigger`` set
    to that number, one micro-batch is one group.
    """
    path = scratch_path(spark, "landing-typed")
    per_group = spark.sparkContext.defaultParallelism
    day = F.dayofmonth("event_date")
    file_no = F.least(F.floor((day - 1) / 5), F.lit(files - 1))
    if late_every:
        last = F.lit(files - 1)
        held = last if late_groups is None else F.least(file_no + late_groups, last)
        file_no = F.when(F.pmod(F.col("event_id"), F.lit(late_every)) == 0, held).otherwise(file_no)
    tagged = events.withColumn("_file", file_no).persist()
    try:
        for k in range(files):
            (tagged.where(F.col("_file") == k).drop("_file").repartition(per_group)
             .write.mode("append").parquet(path))
    finally:
        tagged.unpersist()
    return path, per_group


class PerformanceIncremental:
    """foreachBatch handler maintaining article performance (C5) additively.

    State (under ``root``):

    * ``pairs``  -- first-seen ``(article_id, reader)`` pairs, partitioned by
      article bucket and batch id.  A batch's new pairs are its distinct
      pairs minus the pairs of *earlier* batches in the touched buckets
      (partition-pruned), so a replay recomputes exactly the same set.
    * ``totals/v=<batch>`` -- per-article additive totals (new readers,
      engagement sum and count, deep reads, shares, paywall hits,
      conversions), each version = previous committed version + the batch
      delta; a commit marker makes the version visible.
    * the published table: dimension LEFT JOIN totals (one row per article), a
      folder of its own per publication.  A manifest names the current one and
      the current dimension: readers see whole tables and keep the one they
      opened, and dimension edits outlive the driver.  The last two
      publications and totals stay, older ones are removed.

    Per batch the work is O(batch + pairs of touched buckets + articles), not
    O(history); late events are simply added; exact distinct readers.
    Size ``buckets`` from the expected pair volume (a few hundred MB each).
    """

    def __init__(self, root: str, articles: DataFrame, tiers=None, buckets: int = ARTICLE_BUCKETS):
        self.root = root.rstrip("/")
        self.articles = articles
        self.tiers = tiers
        self.buckets = buckets

    # -- state helpers -----------------------------------------------------
    def _fs(self, spark, path):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _committed(self, spark) -> list[int]:
        p, fs = self._fs(spark, f"{self.root}/_commits")
        if not fs.exists(p):
            return []
        return sorted(int(st.getPath().getName()) for st in fs.listStatus(p))

    def _mark(self, spark, batch_id: int) -> None:
        p, fs = self._fs(spark, f"{self.root}/_commits/{batch_id}")
        fs.create(p, True).close()

    def _totals(self, spark, before: int | None = None):
        done = [b for b in self._committed(spark) if before is None or b < before]
        return spark.read.parquet(f"{self.root}/totals/v={done[-1]}") if done else None

    # -- publication -------------------------------------------------------
    def _published(self, spark) -> Versions:
        return Versions(spark, f"{self.root}/published")

    def _publish(self, spark, out: DataFrame, articles: DataFrame | None = None) -> None:
        """Write ``out`` (and a changed dimension) aside, then name them in the next manifest."""
        log = self._published(spark)
        held = log.load() or {"version": -1, "articles": None}
        number = held["version"] + 1
        names = {"out": f"out/v={number}", "articles": held["articles"]}
        if articles is not None:
            names["articles"] = f"articles/v={number}"
            articles.write.mode("overwrite").parquet(f"{self.root}/{names['articles']}")
            out = out(spark.read.parquet(f"{self.root}/{names['articles']}"))
        out.write.mode("overwrite").parquet(f"{self.root}/{names['out']}")
        log.publish(number, names)
        old, live = log.numbers()[:-2], [log.load(n) for n in log.numbers()[-2:]]
        kept = {m[k] for m in live for k in ("out", "articles")}
        for n in old:
            for path in {log.load(n)[k] for k in ("out", "articles")} - kept - {None}:
                p, fs = self._fs(spark, f"{self.root}/{path}")
                fs.delete(p, True)
        log.drop(old)
        for batch in self._committed(spark)[:-2]:
            p, fs = self._fs(spark, f"{self.root}/totals/v={batch}")
            fs.delete(p, True)

    def dimension(self, spark) -> DataFrame:
        """The stored article dimension; the one given at first until something is published."""
        held = self._published(spark).load()
        return spark.read.parquet(f"{self.root}/{held['articles']}") if held else self.articles

    # -- the handler -------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ev = F.col("event_name")
        batch = batch.where(F.col("article_id").isNotNull()).persist()
        pairs = new_pairs = None
        try:
            pairs = (batch.where(F.col("user_pseudo_id").isNotNull())
                     .select("article_id", "user_pseudo_id").distinct()
                     .withColumn("_bucket", article_bucket(buckets=self.buckets)))
            buckets = [r[0] for r in pairs.select("_bucket").distinct().collect()]
            new_pairs = pairs
            if buckets:
                if path_exists(spark, f"{self.root}/pairs"):
                    seen = (spark.read.parquet(f"{self.root}/pairs")
                            .where(F.col("_bucket").isin(buckets) & (F.col("_batch") < batch_id))
                            .select("article_id", "user_pseudo_id"))
                    new_pairs = pairs.join(seen, ["article_id", "user_pseudo_id"], "left_anti")
                new_pairs = new_pairs.persist()
                (new_pairs.withColumn("_batch", F.lit(int(batch_id)))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("_bucket", "_batch").parquet(f"{self.root}/pairs"))
            readers = new_pairs.groupBy("article_id").agg(F.count("*").alias("readers"))
            delta = (batch.groupBy("article_id")
                     .agg(F.sum("engagement_time_sec").alias("eng_sum"),
                          F.count("engagement_time_sec").alias("eng_cnt"),
                          F.count_if(F.col("scroll_pct") >= DEEP_READ_SCROLL_PCT).alias("deep_reads"),
                          F.count_if(ev == "share").alias("shares"),
                          F.count_if(ev == "paywall_hit").alias("paywall_hits"),
                          F.count_if(ev == "subscribe_click").alias("conversions"))
                     .join(readers, "article_id", "full_outer"))
            cols = ["readers", "eng_sum", "eng_cnt", "deep_reads", "shares", "paywall_hits", "conversions"]
            prev = self._totals(spark, before=batch_id)
            allrows = delta if prev is None else prev.unionByName(delta)
            totals = allrows.groupBy("article_id").agg(*[F.sum(c).cast("long").alias(c) for c in cols])
            totals.write.mode("overwrite").parquet(f"{self.root}/totals/v={batch_id}")
            self._mark(spark, batch_id)
        finally:
            batch.unpersist()
            if new_pairs is not None and new_pairs is not pairs:
                new_pairs.unpersist()
        self.publish(spark)

    def apply_dimension_change(self, spark, changed: DataFrame) -> None:
        """CMS edit of article rows: swap them into the dimension and republish
        (the totals are keyed by id, so no event history is touched)."""
        held = self.dimension(spark)
        keep = held.join(changed.select("article_id"), "article_id", "left_anti").select(*held.columns)
        self._publish(spark, lambda arts: self._table(spark, arts), keep.unionByName(changed.select(*held.columns)))

    def publish(self, spark) -> None:
        if self._published(spark).numbers():
            self._publish(spark, self._table(spark, self.dimension(spark)))
        else:  # the first time the dimension is stored too
            self._publish(spark, lambda arts: self._table(spark, arts), self.articles)

    def _table(self, spark, articles: DataFrame) -> DataFrame:
        from ..functions.constants import PERFORMANCE_TIERS
        from ..functions.rules import tier as tier_expr

        tot = self._totals(spark)
        arts = articles.select("article_id", "title", "author", "section", "publication",
                               "published_at", "paywall_type")
        zero = F.lit(0).cast("long")
        if tot is None:
            j = arts
            for c in ("readers", "eng_sum", "eng_cnt", "deep_reads", "shares", "paywall_hits", "conversions"):
                j = j.withColumn(c, F.lit(None).cast("long"))
        else:
            j = arts.join(tot, "article_id", "left")
        readers = F.coalesce("readers", zero)
        return j.select(
            "article_id", "title", "author", "section", "publication", "published_at", "paywall_type",
            readers.alias("unique_readers"),
            F.round(F.col("eng_sum") / F.nullif(F.col("eng_cnt"), zero), 1).alias("avg_read_time_sec"),
            F.coalesce("deep_reads", zero).alias("deep_reads"),
            F.coalesce("shares", zero).alias("shares"),
            F.coalesce("paywall_hits", zero).alias("paywall_hits"),
            F.coalesce("conversions", zero).alias("conversions"),
            tier_expr(readers, self.tiers or PERFORMANCE_TIERS, False).alias("performance_tier"))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{self._published(spark).load()['out']}")


class EngagementIncremental(PerformanceIncremental):
    """foreachBatch handler maintaining reader engagement (C4) additively.

    State: first-seen ``(day, section, publication, reader)`` tuples
    partitioned by day and batch id (the anti-join reads only the touched
    days), and per-group additive totals versioned per batch.  A micro-batch
    costs O(batch + reader tuples of its days + groups) instead of re-reading
    whole days of events.  NULL section / publication stay groups: all
    combining is done by union + group-by, never by equi-joins on them.
    """

    KEYS = ["event_date", "section", "publication"]
    SUMS = ["readers", "page_views", "eng_sum", "eng_cnt", "paywall_hits", "subscribe_clicks"]

    def __init__(self, root: str):
        super().__init__(root, articles=None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ev = F.col("event_name")
        batch = batch.persist()
        new = None
        try:
            days = [r[0] for r in batch.select("event_date").distinct().collect()]
            if not days:  # nothing to add: the last totals stay the current ones
                return
            tuples = batch.where(F.col("user_pseudo_id").isNotNull()) \
                .select(*self.KEYS, "user_pseudo_id").distinct()
            new = tuples
            path = f"{self.root}/tuples"
            p, fs = self._fs(spark, path)
            if fs.exists(p):
                known = [d for d in days if d is not None]
                cond = F.col("event_date").isin(known) if known else F.lit(False)
                if len(known) < len(days):
                    cond = cond | F.col("event_date").isNull()
                seen = spark.read.parquet(path).where(cond & (F.col("_batch") < batch_id)).drop("_batch")
                # null-safe anti join: a NULL section/publication is a value here
                on = [tuples[c].eqNullSafe(seen[c]) for c in self.KEYS + ["user_pseudo_id"]]
                new = tuples.join(seen, on, "left_anti")
            new = new.persist()
            (new.withColumn("_batch", F.lit(int(batch_id)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("event_date", "_batch").parquet(path))
            zero = F.lit(0).cast("long")
            readers = new.groupBy(*self.KEYS).agg(F.count("*").alias("readers"))
            readers = readers.select(*self.KEYS, "readers", *[zero.alias(c) for c in self.SUMS[1:]])
            delta = (batch.groupBy(*self.KEYS)
                     .agg(F.count("*").alias("page_views"),
                          F.sum("engagement_time_sec").alias("eng_sum"),
                          F.count("engagement_time_sec").alias("eng_cnt"),
                          F.count_if(ev == "paywall_hit").alias("paywall_hits"),
                          F.count_if(ev == "subscribe_click").alias("subscribe_clicks"))
                     .select(*self.KEYS, zero.alias("readers"), *[F.coalesce(c, zero).alias(c)
                                                                   for c in self.SUMS[1:]]))
            prev = self._totals(spark, before=batch_id)
            parts = readers.unionByName(delta)
            if prev is not None:
                parts = parts.unionByName(prev.select(*self.KEYS, *self.SUMS))
            totals = parts.groupBy(*self.KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in self.SUMS])
            totals.write.mode("overwrite").parquet(f"{self.root}/totals/v={batch_id}")
            self._mark(spark, batch_id)
        finally:
            batch.unpersist()
            if new is not None:
                new.unpersist()
        self.publish(spark)

    def publish(self, spark) -> None:
        from ..functions.rules import pct_or_null

        tot = self._totals(spark)
        if tot is None:
            return
        out = tot.select(
            F.col("event_date").alias("day"), "section", "publication",
            F.col("readers").alias("unique_readers"), "page_views",
            F.round(F.col("eng_sum") / F.nullif(F.col("eng_cnt"), F.lit(0).cast("long")), 1)
            .alias("avg_engagement_sec"),
            "paywall_hits", "subscribe_clicks",
            pct_or_null("subscribe_clicks", "paywall_hits").alias("conversion_rate_pct"))
        self._publish(spark, out)
