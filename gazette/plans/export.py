"""Plans for export, the volume query on lineitem, and batch entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CONTENT_TIERS, DEEP_READ_SCROLL_PCT
from ..operators import aggregates, marts, metrics
from ..operators import sessions as sessions_op
from ..session import scratch_path
from ..sources import export
from ..sources import testdata as td
from . import oracle as O
from .context import Context
from .core import ARTICLE_PERFORMANCE_SQL, _with_sessions
from .registry import register


def export_article_metrics(spark: SparkSession, sf_dir: str, path: str | None = None) -> str:
    ctx = Context(spark, sf_dir)
    perf = aggregates.article_performance(ctx.articles, ctx.actions)
    return export.export_parquet(perf, path or scratch_path(spark, "portable-article-metrics"))


@register("export_section_topn", O.with_events(f"""
SELECT article_id, title, section, unique_readers, performance_tier FROM ({ARTICLE_PERFORMANCE_SQL}) p
WHERE section = 'Sciences' ORDER BY unique_readers DESC, article_id ASC LIMIT 10"""))
def q_export_section_topn(spark, sf_dir):
    """S12 + S13 + C15: export partitioned by section, read back with pruning, top 10."""
    path = export_article_metrics(spark, sf_dir)
    return export.section_topn(export.read_export(spark, path), "Sciences", 10)


@register("export_narrow", O.with_events(f"""
SELECT article_id, title, section, unique_readers, avg_read_time_sec, deep_reads, shares
FROM ({ARTICLE_PERFORMANCE_SQL}) p"""))
def q_export_narrow(spark, sf_dir):
    """S12 narrow form: the 7-column open table, read back by any engine."""
    ctx = Context(spark, sf_dir)
    perf = aggregates.article_performance(ctx.articles, ctx.actions)
    path = export.export_parquet(perf, scratch_path(spark, "portable-narrow"), columns=export.NARROW_COLUMNS)
    return export.read_export(spark, path).select(*export.NARROW_COLUMNS)


# --------------------------------------------------------------------------
# Volume query: the content-analytics pattern (C7) on part x lineitem
# --------------------------------------------------------------------------
LINEITEM_TIERS = [("VIRAL", 3), ("HIGH", 2), ("NORMAL", 1)]


def lineitem_events(li: DataFrame) -> DataFrame:
    """lineitem as 'reads': part = article, supplier = reader, quantity = engagement."""
    rf = F.col("l_returnflag")
    return li.select(
        F.col("l_partkey").alias("article_id"),
        F.col("l_suppkey").alias("user_pseudo_id"),
        F.col("l_quantity").cast("long").alias("engagement_time_sec"),
        F.when(rf == "R", "paywall_hit").when(rf == "A", "subscribe_click").otherwise("scroll").alias("event_name"),
        F.round(F.col("l_discount") * 1000).cast("long").alias("scroll_pct"),
        F.col("l_shipdate").alias("event_timestamp"),
    )


def part_articles(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("article_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"), F.col("p_type").alias("section"),
        F.col("p_brand").alias("publication"),
        F.lit("1992-01-01 00:00:00").cast("timestamp_ntz").alias("published_at"),
        F.col("p_size").cast("long").alias("word_count"),
        F.when(F.col("p_retailprice") > 1500, "hard").otherwise("none").alias("paywall_type"),
    )


LINEITEM_SQL = O.with_ctes("""
ev AS (
  SELECT l_partkey AS article_id, l_suppkey AS user_pseudo_id, CAST(l_quantity AS BIGINT) AS engagement_time_sec,
         map {'R': 'paywall_hit', 'A': 'subscribe_click', 'N': 'scroll'}[l_returnflag] AS event_name,
         CAST(round(l_discount * 1000) AS BIGINT) AS scroll_pct, l_shipdate AS event_timestamp
  FROM lineitem
), articles AS (
  SELECT p_partkey AS article_id, p_name AS title, p_brand AS author, p_type AS section, p_brand AS publication,
         TIMESTAMP '1992-01-01 00:00:00' AS published_at, CAST(p_size AS BIGINT) AS word_count,
         if(p_retailprice > 1500, 'hard', 'none') AS paywall_type
  FROM part
)""", O.content_ctes(LINEITEM_TIERS, False, DEEP_READ_SCROLL_PCT), body="SELECT * FROM content")


@register("lineitem_part_performance", LINEITEM_SQL)
def q_lineitem_part_performance(spark, sf_dir):
    """C7 operator reused on part x lineitem (the largest fixture table)."""
    ctx = Context(spark, sf_dir)
    return marts.content_analytics(part_articles(ctx.table("part")), lineitem_events(ctx.table("lineitem")),
                                   LINEITEM_TIERS, strict=False)


# --------------------------------------------------------------------------
# T5 chained refresh / T7 mart rebuild
# --------------------------------------------------------------------------
def refresh_all(spark: SparkSession, sf_dir: str, out_root: str | None = None) -> dict:
    """T5: curated aggregates -> export -> metric layer, in dependency order."""
    root = out_root or scratch_path(spark, "refresh")
    ctx = Context(spark, sf_dir)
    eng = aggregates.reader_engagement(ctx.events)
    (eng.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("day").parquet(f"{root}/reader_engagement"))
    perf = aggregates.article_performance(ctx.articles, ctx.actions)
    perf.write.mode("overwrite").parquet(f"{root}/article_performance")
    perf_t = spark.read.parquet(f"{root}/article_performance")
    eng_t = spark.read.parquet(f"{root}/reader_engagement")
    export.export_parquet(perf_t, f"{root}/portable/article_metrics")
    model = metrics.content_model(perf_t, eng_t)
    return {"root": root, "model": model}


def build_marts(spark: SparkSession, sf_dir: str, out_root: str | None = None,
                as_of: str = td.SUBSCRIBER_AS_OF) -> dict:
    """Rebuild the three marts (sessions view + two tables) in one run."""
    root = out_root or scratch_path(spark, "marts")
    ctx = Context(spark, sf_dir)
    sessions_op.sessions(ctx.actions).createOrReplaceTempView("stg_sessions")  # view (S11)
    marts.content_analytics(ctx.articles, ctx.actions).write.mode("overwrite").parquet(f"{root}/content_analytics")
    marts.subscriber_journey(ctx.actions, ctx.subscribers, as_of).write.mode("overwrite").parquet(
        f"{root}/subscriber_journey")
    return {"root": root, "tables": ["content_analytics", "subscriber_journey"], "views": ["stg_sessions"]}


@register("refresh_chain", O.with_events(f"""
SELECT article_id, title, section, unique_readers, avg_read_time_sec, deep_reads, shares
FROM ({ARTICLE_PERFORMANCE_SQL}) p"""))
def q_refresh_chain(spark, sf_dir):
    """T5: the whole chain is refreshed, then its last link, the export, is read."""
    root = refresh_all(spark, sf_dir)["root"]
    return export.read_export(spark, f"{root}/portable/article_metrics").select(
        "article_id", "title", "section", "unique_readers", "avg_read_time_sec", "deep_reads", "shares")


@register("marts_rebuilt", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, O.content_ctes(
    CONTENT_TIERS, True, DEEP_READ_SCROLL_PCT), body="SELECT * FROM content"))
def q_marts_rebuilt(spark, sf_dir):
    """The stored content mart after a rebuild."""
    return spark.read.parquet(f"{build_marts(spark, sf_dir)['root']}/content_analytics")


@register("sessions_view", _with_sessions(30, "SELECT user_pseudo_id, count(*) AS sessions, "
                                              "CAST(sum(total_events) AS BIGINT) AS events FROM sess GROUP BY ALL"))
def q_sessions_view(spark, sf_dir):
    """The sessions stay a view, evaluated when the query reads it."""
    build_marts(spark, sf_dir)
    return spark.sql("SELECT user_pseudo_id, count(*) AS sessions, sum(total_events) AS events "
                     "FROM stg_sessions GROUP BY user_pseudo_id")
