"""Stage fixture-derived landing files under the shared checkpoint folder.

The reference loads NDJSON files from a stage; here the landing files are
written by Spark from the driver's tables (never from made-up rows), into a
fresh folder under ``spark.checkpoint.dir`` per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import pick
from ..functions.constants import CAMPAIGNS, REGIONS
from ..session import scratch_path
from . import testdata as td



def batch_cutoff(spark: SparkSession, sf_dir: str) -> int:
    """event_id bound of the first batch: the first 60% of the (dense) ids."""
    n = td.table(spark, sf_dir, "events").count()
    return (n * 6) // 10


def stage_tracking_batches(spark: SparkSession, sf_dir: str, compression: str = "gzip",
                           upper_case_batch2: bool = True) -> dict:
    """Write batch 1 (base schema) and batch 2 (three extra fields) as NDJSON.

    Batch 2's original keys are written upper-case so the load exercises
    case-insensitive column matching.  Returns ``{"batch_1": path, "batch_2": path}``.
    """
    root = scratch_path(spark, "landing-tracking")
    ev = td.table(spark, sf_dir, "events")
    cut = batch_cutoff(spark, sf_dir)
    b1 = td.tracking_columns(ev.where(F.col("event_id") < cut), evolved=False)
    b2 = td.tracking_columns(ev.where(F.col("event_id") >= cut), evolved=True)
    if upper_case_batch2:
        new = {"consent_state", "engagement_score", "ab_test_variant"}
        b2 = b2.select(*[F.col(c).alias(c if c in new else c.upper()) for c in b2.columns])
    paths = {"batch_1": f"{root}/batch_1", "batch_2": f"{root}/batch_2"}
    b1.write.option("compression", compression).json(paths["batch_1"])
    b2.write.option("compression", compression).json(paths["batch_2"])
    return paths


def stage_open_numbers(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> list[str]:
    """Three landing folders of tracking lines whose late fields are not settled at first.

    From the second on lines carry the evolved fields, ``visit_token`` (whole
    numbers beyond 2^53) and ``read_depth``, which is whole in the second folder
    and fractional in the third.
    """
    root = scratch_path(spark, "landing-open")
    ev = td.table(spark, sf_dir, "events")
    n = ev.count()
    cuts = [0, (n * 6) // 10, (n * 8) // 10, n]
    paths = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rows = td.tracking_columns(ev.where(F.col("event_id").between(a, b - 1)), evolved=i > 0)
        if i:
            depth = F.pmod("event_id", F.lit(7))
            rows = rows.withColumn("visit_token", F.lit(9007199254740993) + F.col("event_id")) \
                .withColumn("read_depth", depth if i == 1 else depth + F.lit(0.25))
        paths.append(f"{root}/part_{i + 1}")
        rows.write.option("compression", compression).json(paths[-1])
    return paths


def stage_text_tracking(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> str:
    """Tracking lines with text ids: readers ``u<n>``, articles ``art-<n>``, none in every thirteenth event."""
    path = scratch_path(spark, "landing-text-ids")
    rows = td.tracking_events(spark, sf_dir)
    article = F.when(F.pmod("event_id", F.lit(13)) != 0, F.concat(F.lit("art-"), F.col("article_id").cast("string")))
    (rows.withColumn("article_id", article)
     .withColumn("user_pseudo_id", F.concat(F.lit("u"), F.col("user_pseudo_id").cast("string")))
     .write.option("compression", compression).json(path))
    return path


def stage_subscribers(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> str:
    """Subscribers as NDJSON with upper-case keys and text timestamps
    (``YYYY-MM-DDTHH:MM:SSZ``), the shape of the subscriber export."""
    from ..functions.dates import format_raw_ts

    path = scratch_path(spark, "landing-subscribers")
    subs = td.subscribers(spark, sf_dir)
    out = subs.withColumn("last_login", format_raw_ts("last_login"))
    out.select(*[F.col(c).alias(c.upper()) for c in out.columns]) \
        .write.option("compression", compression).json(path)
    return path


def nested_events(ev_raw: DataFrame) -> DataFrame:
    """Nested event documents ``{"raw_event": {...}}`` built from the raw feed."""
    eid, uid = F.col("event_id"), F.col("user_pseudo_id")
    params = F.array(
        F.struct(F.lit("article_section").alias("key"), F.col("section").alias("value")),
        F.struct(F.lit("page_title").alias("key"),
                 F.concat(F.lit("Article "), F.col("article_id").cast("string")).alias("value")),
        F.struct(F.lit("engagement_time_msec").alias("key"),
                 (F.col("engagement_time_sec") * 1000).cast("string").alias("value")),
    )
    doc = F.struct(
        F.col("event_name"), F.col("event_timestamp"),
        uid.cast("string").alias("user_pseudo_id"),
        F.col("article_id").cast("string").alias("article_id"),
        params.alias("event_params"),
        F.struct(F.col("device_category").alias("category"), "browser", "os").alias("device"),
        F.struct("country", "city",
                 pick(REGIONS, F.when(F.pmod(uid, F.lit(5)) < 2, 0).otherwise(1)).alias("region")).alias("geo"),
        F.struct(F.col("traffic_source").alias("source"), F.col("traffic_medium").alias("medium"),
                 pick(CAMPAIGNS, F.pmod(eid, F.lit(4))).alias("campaign")).alias("traffic_source"),
    )
    return ev_raw.select(doc.alias("raw_event"))


def stage_nested(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> str:
    path = scratch_path(spark, "landing-nested")
    nested_events(td.tracking_events(spark, sf_dir)).write.option("compression", compression).json(path)
    return path


def stage_change_feed(spark: SparkSession, sf_dir: str, files: int | None = None) -> tuple[str, int]:
    """Write the CMS change rows as Parquet files, ordered by change time.

    The feed is range-partitioned by change time into ``files`` files (by
    default one per ~64 MB of log, at least 8), so a file stream replays it
    in several micro-batches, older changes first.  Returns ``(path, files)``.
    """
    from ..session import input_bytes

    path = scratch_path(spark, "landing-cdc")
    if files is None:
        files = max(8, -(-input_bytes(spark, f"{sf_dir.rstrip('/')}/orders.parquet") // (64 << 20)))
    feed = td.article_change_feed(spark, sf_dir)
    (feed.repartitionByRange(files, "change_ts", "change_seq")
     .sortWithinPartitions("change_ts", "change_seq")
     .write.parquet(path))
    return path, files
