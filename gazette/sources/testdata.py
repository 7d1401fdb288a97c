"""Map the driver's test tables onto the media domain.

The reference's inputs (tracking events, subscribers, a CMS change feed) are
derived column-by-column from the given Parquet tables, so every query's work
grows with those tables.  Everything here is a lazy projection: no action.

* ``events``   -> raw tracking feed (text timestamps, as the RAW layer keeps them)
* ``customer`` -> subscribers (PII columns, churn label and segment by rule)
* ``orders``   -> CMS ``articles`` change feed (insert / update / delete rows)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import pick
from ..functions.constants import (
    AB_VARIANTS, BROWSERS, CONSENT_STATES, COUNTRIES, DEVICES, FR_CITIES, MEDIUMS,
    OS_LIST, PUBLICATIONS, SECTIONS, SOURCES,
)
from ..functions.dates import format_raw_ts
from ..functions.rules import churn_rule_score, engagement_segment
from ..session import rebalance_small_scan

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Evaluation dates of the fixture mapping (explicit instead of CURRENT_DATE()).
SUBSCRIBER_AS_OF = "2024-02-29"
RECENT_AS_OF = "2024-01-31"
ARTICLE_AS_OF_TS = "2024-01-31 00:00:00"
SUBSCRIPTION_EPOCH = "2023-11-25"
# CMS articles that exist but have never been read (zero rows of C5/C7).
UNREAD_ARTICLE_IDS = [100, 101, 102, 103, 104]
# Event-type mapping of the driver's `events` onto tracking event names.
EVENT_NAME_MAP = [("view", "page_view"), ("click", "scroll"), ("signup", "subscribe_click"),
                  ("error", "paywall_hit")]
EVENT_NAME_DEFAULT = "share"


# Fact tables whose per-row work benefits from spreading a small scan.
FACT_TABLES = {"events", "lineitem", "orders", "customer"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return rebalance_small_scan(df, path) if name in FACT_TABLES else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def _event_name(col):
    expr = None
    for src, dst in EVENT_NAME_MAP:
        cond = col == F.lit(src)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    return expr.otherwise(F.lit(EVENT_NAME_DEFAULT))


def tracking_columns(ev: DataFrame, evolved: bool = False) -> DataFrame:
    """Project driver ``events`` rows into the 14-column tracking shape (+event_id).

    With ``evolved=True`` the three fields added by the second feed version
    (consent_state, engagement_score, ab_test_variant) are included.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    article = F.get_json_object("props", "$.k").cast("long")
    cols = [
        eid.alias("event_id"),
        _event_name(F.col("event_type")).alias("event_name"),
        format_raw_ts("ts").alias("event_timestamp"),
        uid.alias("user_pseudo_id"),
        article.alias("article_id"),
        pick(SECTIONS, F.pmod(article, F.lit(9))).alias("section"),
        pick(DEVICES, F.pmod(eid, F.lit(3))).alias("device_category"),
        pick(BROWSERS, F.pmod(eid, F.lit(5))).alias("browser"),
        pick(OS_LIST, F.pmod(uid, F.lit(5))).alias("os"),
        pick(COUNTRIES, F.pmod(uid, F.lit(9))).alias("country"),
        pick(FR_CITIES, F.pmod(uid, F.lit(10))).alias("city"),
        pick(SOURCES, F.pmod(eid, F.lit(6))).alias("traffic_source"),
        pick(MEDIUMS, F.pmod(F.floor(eid / 6), F.lit(6))).alias("traffic_medium"),
        F.floor("value").cast("long").alias("engagement_time_sec"),
        F.pmod(eid * 37, F.lit(101)).alias("scroll_pct"),
    ]
    if evolved:
        cols += [
            pick(CONSENT_STATES, F.pmod(eid, F.lit(3))).alias("consent_state"),
            F.round(F.col("value") / 5, 1).alias("engagement_score"),
            pick(AB_VARIANTS, F.pmod(eid, F.lit(4))).alias("ab_test_variant"),
        ]
    return ev.select(*cols)


def tracking_events(spark: SparkSession, sf_dir: str, evolved: bool = False,
                    since: str | None = None) -> DataFrame:
    """The raw tracking feed (RAW layer shape) derived from ``events``.

    ``since`` (a date) keeps events of that day and later, as a bound on the
    source timestamp column so it reaches the Parquet scan (PushedFilters,
    row-group / partition skipping) before any parsing happens.
    """
    ev = table(spark, sf_dir, "events")
    if since is not None:
        ev = ev.where(F.col("ts") >= F.lit(f"{since} 00:00:00").cast("timestamp_ntz"))
    return tracking_columns(ev, evolved)


def subscribers(spark: SparkSession, sf_dir: str, as_of: str = SUBSCRIBER_AS_OF) -> DataFrame:
    """13-column subscriber table derived from ``customer``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    days_since_login = F.pmod(key, F.lit(91))
    reads = F.pmod(key * 7, F.lit(121))
    bounces = F.pmod(key * 11, F.lit(31))
    as_of_d = F.lit(as_of).cast("date")
    sub_type = (F.when(F.pmod(key, F.lit(4)) == 0, "student")
                .when(F.pmod(key, F.lit(4)) == 1, "digital_only")
                .when(F.pmod(key, F.lit(4)) == 2, "standard")
                .otherwise("premium"))
    return c.select(
        key.alias("user_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+33 6 11 22 33 "),
                 F.lpad(F.pmod(key, F.lit(100)).cast("string"), 2, "0")).alias("phone"),
        sub_type.alias("subscription_type"),
        F.date_add(F.lit(SUBSCRIPTION_EPOCH).cast("date"), F.pmod(key, F.lit(60)).cast("int")).alias("start_date"),
        F.date_sub(as_of_d, days_since_login.cast("int")).cast("timestamp_ntz").alias("last_login"),
        reads.alias("articles_read_30d"),
        (F.lit(30) + F.pmod(key * 13, F.lit(1171))).alias("avg_session_sec"),
        bounces.alias("paywall_bounces_30d"),
        F.col("c_acctbal").alias("ltv_estimated_eur"),
        engagement_segment(reads, days_since_login).alias("segment"),
        (churn_rule_score(days_since_login, reads, bounces) > F.lit(0.5)).alias("churn_flag"),
    )


def article_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMS ``articles`` change rows derived from ``orders``.

    key = o_custkey, order of changes = (o_orderdate, o_orderkey);
    status P -> insert, O -> update, F -> delete.
    """
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    op = (F.when(F.col("o_orderstatus") == "P", "I")
          .when(F.col("o_orderstatus") == "O", "U")
          .otherwise("D"))
    return o.select(
        F.col("o_custkey").alias("article_id"),
        F.concat(F.lit("Article "), ok.cast("string")).alias("title"),
        pick(SECTIONS, F.pmod(ok, F.lit(9))).alias("section"),
        pick(PUBLICATIONS, F.pmod(ok, F.lit(5))).alias("publication"),
        F.col("o_orderdate").alias("published_at"),
        (F.lit(300) + F.pmod(F.floor("o_totalprice").cast("long"), F.lit(2200))).alias("word_count"),
        op.alias("op"),
        F.col("o_orderdate").alias("change_ts"),
        ok.alias("change_seq"),
    )


def calendar_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMS ``editorial_calendar`` change rows derived from ``lineitem``.

    key = entry (up to four of each article, l_partkey); order of changes =
    (l_shipdate, l_orderkey, l_linenumber); return flag N -> insert, A ->
    update, R -> delete.
    """
    li = table(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    op = F.when(rf == "N", "I").when(rf == "A", "U").otherwise("D")
    priority = F.when(F.col("l_linestatus") == "O", "high").otherwise("normal")
    return li.select(
        F.col("l_partkey").alias("article_id"),
        (F.col("l_partkey") * 4 + F.col("l_linenumber") % 4).cast("long").alias("entry_id"),
        F.to_date("l_shipdate").alias("planned_date"),
        priority.alias("priority"),
        op.alias("op"),
        F.col("l_shipdate").alias("change_ts"),
        F.col("l_orderkey").alias("change_seq"),
        F.col("l_linenumber").cast("long").alias("change_sub"),
    )


def authors_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMS ``authors`` change rows derived from ``supplier``: three per author.

    An insert, an update, then a second update, or a delete for every seventh.
    """
    s = table(spark, sf_dir, "supplier")
    k, v = F.col("s_suppkey"), F.col("change_seq")
    s = s.withColumn("change_seq", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)])))
    op = F.when(v == 0, "I").when((v == 2) & (k % 7 == 0), "D").otherwise("U")
    return s.select(k.alias("author_id"), F.col("s_name").alias("name"), pick(SECTIONS, F.pmod(k + v, F.lit(9))).alias("section"),
                    (k * 10 + v).alias("bio_rev"), op.alias("op"), v)
