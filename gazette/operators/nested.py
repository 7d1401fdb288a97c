"""Semi-structured access on VARIANT events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NESTED_FIELDS = [
    ("user_id", "$.user_pseudo_id"),
    ("device", "$.device.category"),
    ("browser", "$.device.browser"),
    ("country", "$.geo.country"),
    ("city", "$.geo.city"),
    ("source", "$.traffic_source.source"),
    ("medium", "$.traffic_source.medium"),
]

PARAM_TYPE = "array<struct<key string, value string>>"


def path_str(col: str, path: str):
    return F.variant_get(F.col(col), path, "string")


# Leaves that queries filter on, stored as typed columns next to the VARIANT
# so predicates on them reach the Parquet scan (min/max skipping).
HOT_LEAVES = {"geo_country": "$.geo.country", "event_name": "$.event_name"}


def with_hot_leaves(variant_df: DataFrame, col: str = "raw_event", leaves: dict = HOT_LEAVES) -> DataFrame:
    """Shred the hot leaves into columns (the VARIANT stays whole)."""
    return variant_df.select(col, *[path_str(col, p).alias(name) for name, p in leaves.items()])


def nested_projection(variant_df: DataFrame, col: str = "raw_event",
                      country: str | None = "FR") -> DataFrame:
    """Dot-path projection of seven leaves, optionally filtered on geo.country.

    Uses the shredded ``geo_country`` column when the frame has one (the
    filter is then pushed to the scan), else the VARIANT path.
    """
    df = variant_df
    if country is not None:
        key = F.col("geo_country") if "geo_country" in df.columns else path_str(col, "$.geo.country")
        df = df.where(key == F.lit(country))
    return df.select(*[path_str(col, p).alias(name) for name, p in NESTED_FIELDS])


def params_exploded(variant_df: DataFrame, col: str = "raw_event",
                    key: str | None = "article_section") -> DataFrame:
    """C11: LATERAL FLATTEN of ``event_params``; inner semantics (empty/NULL drop).

    For one wanted key the array is filtered before exploding, so only
    matching elements are materialised.
    """
    params = F.variant_get(F.col(col), "$.event_params", PARAM_TYPE)
    if key is not None:
        params = F.filter(params, lambda p: p["key"] == F.lit(key))
    return (variant_df.select(path_str(col, "$.user_pseudo_id").alias("user_id"),
                              F.explode(params).alias("p"))
            .select("user_id", F.col("p.key").alias("param_key"), F.col("p.value").alias("param_value")))
