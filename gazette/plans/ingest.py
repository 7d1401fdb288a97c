"""Plans for loads, schema evolution, nested data and audits (S*, C9-C11, U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, curate, evolve, nested
from ..session import path_exists, scratch_path
from ..sources import json_loader, staging
from ..sources.raw_table import RawTable
from ..sources.schemas import EVOLVED_FIELDS, SUBSCRIBER_SCHEMA, TRACKING_SCHEMA
from . import oracle as O
from .context import Context
from .registry import register

CUTOFF_SQL = "(SELECT (count(*) * 6) // 10 FROM events)"
RAW_COLUMNS = [f.name for f in TRACKING_SCHEMA.fields]


def load_raw_tracking(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """Stage both batches, load batch 1 with the declared schema, then batch 2
    with the evolved schema into the same Parquet table.  Returns the table
    and the per-batch loaded frames."""
    paths = staging.stage_tracking_batches(spark, sf_dir)
    table_path = scratch_path(spark, "raw-ga4-tracking")
    b1 = json_loader.load_ndjson(spark, paths["batch_1"], TRACKING_SCHEMA)
    evolve.append_evolving(spark, b1, table_path)
    current = evolve.read_evolving(spark, table_path).schema
    schema2 = evolve.merged_schema(current, json_loader.infer_schema(spark, paths["batch_2"]))
    b2 = json_loader.load_ndjson(spark, paths["batch_2"], schema2)
    evolve.append_evolving(spark, b2, table_path)
    final = evolve.read_evolving(spark, table_path)
    batches = {"batch_1": json_loader.load_ndjson(spark, paths["batch_1"], final.schema),
               "batch_2": json_loader.load_ndjson(spark, paths["batch_2"], final.schema)}
    return final, batches


RAW_EVOLVED_SQL = O.with_ctes(O.EV_CTE, body=f"""
SELECT event_id, event_name, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
       user_pseudo_id, article_id, section, device_category, browser, os, country, city,
       traffic_source, traffic_medium, engagement_time_sec, scroll_pct,
       CASE WHEN event_id >= {CUTOFF_SQL} THEN consent_state END AS consent_state,
       CASE WHEN event_id >= {CUTOFF_SQL} THEN engagement_score END AS engagement_score,
       CASE WHEN event_id >= {CUTOFF_SQL} THEN ab_test_variant END AS ab_test_variant
FROM ev_raw""")


@register("raw_tracking_evolved", RAW_EVOLVED_SQL)
def q_raw_tracking_evolved(spark, sf_dir):
    """Gzip NDJSON, case-insensitive keys, evolving append."""
    return load_raw_tracking(spark, sf_dir)[0]


@register("staged_batch_load", RAW_EVOLVED_SQL)
def q_staged_batch_load(spark, sf_dir):
    """Batch 1 loaded, batch 1 re-run (ledger: no-op), then batch 2 (evolved)."""
    paths = staging.stage_tracking_batches(spark, sf_dir)
    table = RawTable(spark, scratch_path(spark, "raw-staged"), TRACKING_SCHEMA)
    ledger = json_loader.FileLedger(spark, scratch_path(spark, "load-ledger"))
    for landing in (paths["batch_1"], paths["batch_1"], paths["batch_2"]):
        new = ledger.pending(landing, "*.json*")
        lines = ledger.lines(landing, new, "*.json*")
        if lines is not None:
            table.append(lines, landing.rsplit("/", 1)[-1], 0)
            ledger.record(new)
    return table.read()


@register("evolved_fields", O.with_ctes(O.EV_CTE, body=f"""
SELECT consent_state, engagement_score, ab_test_variant, count(*) AS events
FROM ev_raw WHERE event_id >= {CUTOFF_SQL} AND consent_state IS NOT NULL
GROUP BY 1, 2, 3"""))
def q_evolved_fields(spark, sf_dir):
    """Query the evolved fields right after the load."""
    return evolve.evolved_breakdown(load_raw_tracking(spark, sf_dir)[0])


def _presence_sql() -> str:
    cols = RAW_COLUMNS + EVOLVED_FIELDS
    parts = []
    for batch, cond in (("batch_1", f"event_id < {CUTOFF_SQL}"), ("batch_2", f"event_id >= {CUTOFF_SQL}")):
        for c in cols:
            expr = "count(NULL)" if (batch == "batch_1" and c in EVOLVED_FIELDS) else f"count({c})"
            if c == "event_timestamp":
                expr = "count(event_timestamp)"
            parts.append(f"SELECT '{batch}' AS batch, '{c}' AS column_name, CAST({expr} AS BIGINT) AS non_null "
                         f"FROM ev_raw WHERE {cond}")
    return O.with_ctes(O.EV_CTE, body="\nUNION ALL\n".join(parts))


@register("field_presence", _presence_sql())
def q_field_presence(spark, sf_dir):
    """Per batch, non-NULL count of every column after evolution."""
    _, batches = load_raw_tracking(spark, sf_dir)
    labelled = None
    for name, df in batches.items():
        part = df.withColumn("batch", F.lit(name))
        labelled = part if labelled is None else labelled.unionByName(part)
    return evolve.field_presence(labelled, "batch")


_NESTED: dict = {}  # (application, folder) -> path of its RAW VARIANT table


def load_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents loaded as one VARIANT column (unwrapped) into a RAW
    Parquet table with the hot leaves shredded, once per application and folder;
    queries read the stored table."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _NESTED or not path_exists(spark, _NESTED[key]):
        path = staging.stage_nested(spark, sf_dir)
        v = json_loader.load_variant(spark, path, "raw_event", unwrap_key="raw_event")
        _NESTED[key] = scratch_path(spark, "raw-events-variant")
        nested.with_hot_leaves(v).write.mode("overwrite").parquet(_NESTED[key])
    return spark.read.parquet(_NESTED[key])


@register("nested_projection", O.with_ctes(O.EV_CTE, body="""
SELECT CAST(user_pseudo_id AS VARCHAR) AS user_id, device_category AS device, browser, country, city,
       traffic_source AS source, traffic_medium AS medium
FROM ev_raw WHERE country = 'FR'"""))
def q_nested_projection(spark, sf_dir):
    """Seven dot-path leaves, filtered on a nested path."""
    return nested.nested_projection(load_nested(spark, sf_dir))


@register("params_exploded", O.with_ctes(O.EV_CTE, body="""
SELECT CAST(user_pseudo_id AS VARCHAR) AS user_id, 'article_section' AS param_key, section AS param_value
FROM ev_raw"""))
def q_params_exploded(spark, sf_dir):
    """C11: lateral flatten of event_params, key = article_section."""
    return nested.params_exploded(load_nested(spark, sf_dir))


@register("params_all", O.with_ctes(O.EV_CTE, body="""
SELECT CAST(user_pseudo_id AS VARCHAR) AS user_id, 'article_section' AS param_key, section AS param_value FROM ev_raw
UNION ALL
SELECT CAST(user_pseudo_id AS VARCHAR), 'page_title', 'Article ' || CAST(article_id AS VARCHAR) FROM ev_raw
UNION ALL
SELECT CAST(user_pseudo_id AS VARCHAR), 'engagement_time_msec', CAST(engagement_time_sec * 1000 AS VARCHAR)
FROM ev_raw"""))
def q_params_all(spark, sf_dir):
    """Full flatten of every parameter."""
    return nested.params_exploded(load_nested(spark, sf_dir), key=None)


def load_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber NDJSON into the declared 13-column schema (keys matched
    case-insensitively, text values cast with ANSI rules, abort on bad input)."""
    return json_loader.load_ndjson(spark, staging.stage_subscribers(spark, sf_dir), SUBSCRIBER_SCHEMA)


@register("subscribers_loaded", O.with_ctes(O.SUBSCRIBERS_CTE, body="SELECT * FROM subscribers"))
def q_subscribers_loaded(spark, sf_dir):
    """S1 typed round trip: DATE, TIMESTAMP_NTZ (Z text), BOOLEAN, DOUBLE from JSON."""
    return load_subscribers(spark, sf_dir)


@register("load_audit", f"""
SELECT 'GA4_TRACKING' AS tbl, {CUTOFF_SQL} AS n
UNION ALL SELECT 'GA4_EVENTS_VARIANT', count(*) FROM events
UNION ALL SELECT 'SUBSCRIBERS', count(*) FROM customer""")
def q_load_audit(spark, sf_dir):
    """S6 + S15: the RAW load step (batch 2 held back), then its row-count audit."""
    paths = staging.stage_tracking_batches(spark, sf_dir)
    tracking = json_loader.load_ndjson(spark, paths["batch_1"], TRACKING_SCHEMA)
    return audit.row_audit({"GA4_TRACKING": tracking, "GA4_EVENTS_VARIANT": load_nested(spark, sf_dir),
                            "SUBSCRIBERS": load_subscribers(spark, sf_dir)})


@register("row_audit", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, O.SUBSCRIBERS_CTE, body="""
SELECT 'GA4_TRACKING' AS tbl, count(*) AS n FROM ev_raw
UNION ALL SELECT 'SUBSCRIBERS', count(*) FROM subscribers
UNION ALL SELECT 'ARTICLES', count(*) FROM articles
UNION ALL SELECT 'AUTHORS', count(DISTINCT author) FROM articles
UNION ALL SELECT 'GA4_EVENTS', count(*) FROM ev
UNION ALL SELECT 'GA4_EVENTS_no_pub', count(*) FROM ev WHERE publication IS NULL"""))
def q_row_audit(spark, sf_dir):
    """Labelled row counts incl. events without a publication."""
    ctx = Context(spark, sf_dir)
    return audit.row_audit(
        {"GA4_TRACKING": ctx.raw, "SUBSCRIBERS": ctx.subscribers, "ARTICLES": ctx.articles,
         "AUTHORS": curate.authors_dim(ctx.articles), "GA4_EVENTS": ctx.events},
        {"GA4_EVENTS_no_pub": ("GA4_EVENTS", "publication")})

