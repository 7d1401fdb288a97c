"""Declared schemas of the RAW layer."""

from pyspark.sql import types as T

TRACKING_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("user_pseudo_id", T.LongType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("section", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("traffic_source", T.StringType()),
    T.StructField("traffic_medium", T.StringType()),
    T.StructField("engagement_time_sec", T.LongType()),
    T.StructField("scroll_pct", T.LongType()),
])

# The same feed with text identifiers; ``sources/dictionary.py`` gives them numbers where those are needed.
TRACKING_TEXT_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in ("user_pseudo_id", "article_id") else f.dataType)
    for f in TRACKING_SCHEMA.fields
])

EVOLVED_FIELDS = ["consent_state", "engagement_score", "ab_test_variant"]

SUBSCRIBER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("last_login", T.TimestampNTZType()),
    T.StructField("articles_read_30d", T.LongType()),
    T.StructField("avg_session_sec", T.LongType()),
    T.StructField("paywall_bounces_30d", T.LongType()),
    T.StructField("ltv_estimated_eur", T.DoubleType()),
    T.StructField("segment", T.StringType()),
    T.StructField("churn_flag", T.BooleanType()),
])
