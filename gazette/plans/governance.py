"""Plans for masking (C16) and the metric layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import ANALYST_ROLE, PRIVILEGED_ROLES
from ..functions.sql_functions import register_sql_functions
from ..operators import aggregates, masking, metrics
from . import oracle as O
from .context import Context
from .registry import register

SUBSCRIBER_VIEW = ["user_id", "full_name", "email", "phone", "subscription_type", "ltv_estimated_eur"]


def _masked(spark, sf_dir, role):
    subs = Context(spark, sf_dir).subscribers.select(*SUBSCRIBER_VIEW)
    return masking.secured(subs, masking.SUBSCRIBER_POLICIES, role)


_CLEAR_SQL = O.with_ctes(O.SUBSCRIBERS_CTE, body=f"SELECT {', '.join(SUBSCRIBER_VIEW)} FROM subscribers")
_MASKED_SQL = O.with_ctes(O.SUBSCRIBERS_CTE, body="""
SELECT user_id, '*** MASKED ***' AS full_name, regexp_replace(email, '.+@', '****@', 'g') AS email,
       concat('+33 **** ** ', right(phone, 2)) AS phone, subscription_type, ltv_estimated_eur
FROM subscribers""")


@register("masked_admin", _CLEAR_SQL)
def q_masked_admin(spark, sf_dir):
    """C16 as the admin role: clear values."""
    return _masked(spark, sf_dir, PRIVILEGED_ROLES[0])


@register("masked_analyst", _MASKED_SQL)
def q_masked_analyst(spark, sf_dir):
    """C16 as the analyst role: email, name and phone masked."""
    return _masked(spark, sf_dir, ANALYST_ROLE)


_LOADED = ["user_id", "full_name", "email", "phone"]


@register("masked_loaded", O.with_ctes(O.SUBSCRIBERS_CTE, body="""
SELECT user_id AS "USER_ID", '*** MASKED ***' AS "FULL_NAME", '****' || substr(email, instr(email, '@')) AS "EMAIL",
       '+33 **** ** ' || substr(phone, -2) AS "PHONE" FROM subscribers"""))
def q_masked_loaded(spark, sf_dir):
    """C16 over names in upper case, as the subscriber files spell them."""
    subs = Context(spark, sf_dir).subscribers.select(*[F.col(c).alias(c.upper()) for c in _LOADED])
    return masking.secured(subs, masking.SUBSCRIBER_POLICIES, ANALYST_ROLE)


@register("masked_sysadmin", _MASKED_SQL)
def q_masked_sysadmin(spark, sf_dir):
    """Exact role match only: a role granted the admin role still sees masks."""
    return _masked(spark, sf_dir, "SYSADMIN")


def _model(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return metrics.content_model(aggregates.article_performance(ctx.articles, ctx.actions),
                                 aggregates.reader_engagement(ctx.events))


def _perf_sql():
    from .core import ARTICLE_PERFORMANCE_SQL
    return f"perf AS ({ARTICLE_PERFORMANCE_SQL})"


def _eng_sql():
    from .core import READER_ENGAGEMENT_SQL
    return f"eng AS ({READER_ENGAGEMENT_SQL})"


ARTICLE_METRICS = ["total_unique_readers", "avg_reading_time", "total_deep_reads", "total_shares",
                   "total_conversions", "total_paywall_hits", "article_count"]


@register("metric_by_section", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, _perf_sql(), body="""
SELECT section, CAST(sum(unique_readers) AS BIGINT) AS total_unique_readers,
       round(avg(avg_read_time_sec), 6) AS avg_reading_time, CAST(sum(deep_reads) AS BIGINT) AS total_deep_reads,
       CAST(sum(shares) AS BIGINT) AS total_shares, CAST(sum(conversions) AS BIGINT) AS total_conversions,
       CAST(sum(paywall_hits) AS BIGINT) AS total_paywall_hits, count(article_id) AS article_count
FROM perf GROUP BY section"""))
def q_metric_by_section(spark, sf_dir):
    """All article metrics by section."""
    out = _model(spark, sf_dir).query(ARTICLE_METRICS, ["section"])
    return out.withColumn("avg_reading_time", F.round("avg_reading_time", 6))


@register("metric_by_day", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, _eng_sql(), body="""
SELECT day, CAST(sum(page_views) AS BIGINT) AS total_page_views, round(avg(avg_engagement_sec), 6) AS avg_engagement
FROM eng GROUP BY day"""))
def q_metric_by_day(spark, sf_dir):
    """Engagement metrics by day."""
    out = _model(spark, sf_dir).query(["total_page_views", "avg_engagement"], ["day"])
    return out.withColumn("avg_engagement", F.round("avg_engagement", 6))


@register("metric_by_synonyms", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, _perf_sql(), body="""
SELECT publication, author, CAST(sum(unique_readers) AS BIGINT) AS total_unique_readers, CAST(sum(shares) AS BIGINT) AS total_shares,
       CAST(sum(conversions) AS BIGINT) AS total_conversions
FROM perf GROUP BY publication, author"""))
def q_metric_by_synonyms(spark, sf_dir):
    """C18 with synonyms: 'lecteurs', 'partages', 'abonnements' by 'journal' x 'auteur'."""
    return _model(spark, sf_dir).query(["lecteurs", "partages", "abonnements"], ["journal", "auteur"])


@register("metric_filtered", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, _perf_sql(), body="""
SELECT publication, CAST(sum(unique_readers) AS BIGINT) AS total_unique_readers, count(article_id) AS article_count
FROM perf WHERE paywall_type <> 'none' AND section IN ('Politique', 'Sport', 'Culture') AND unique_readers >= 10
GROUP BY publication"""))
def q_metric_filtered(spark, sf_dir):
    """G6 with a filter: metrics of paid articles in three sections with at least ten readers."""
    paid = (F.col("paywall_type") != "none") & F.col("section").isin("Politique", "Sport", "Culture") \
        & (F.col("unique_readers") >= 10)
    return _model(spark, sf_dir).query(["readers", "article_count"], ["journal"], where=paid)


_names = [(n, e) for n, e, *_ in metrics.CONTENT_METRICS], [(n, e) for n, e, *_ in metrics.CONTENT_DIMENSIONS]


@register("metric_refusals", O.with_ctes(O.EV_CTE, O.ARTICLES_CTE, O.EVENTS_CTE, _perf_sql(), _eng_sql(), f"""
asked AS (SELECT * FROM (VALUES {', '.join(f"('{n}', '{e}')" for n, e in _names[0])}) m(metric, metric_entity),
                       (VALUES {', '.join(f"('{n}', '{e}')" for n, e in _names[1])}) d(dimension, dimension_entity))""", body="""
SELECT metric_entity, CAST(count(*) FILTER (WHERE metric_entity <> dimension_entity) AS BIGINT) AS refused,
       CAST(count(*) FILTER (WHERE metric_entity = dimension_entity) AS BIGINT) AS answered,
       any_value(CASE metric_entity WHEN 'articles' THEN (SELECT count(*) FROM perf) ELSE (SELECT count(*) FROM eng) END)
         AS entity_rows
FROM asked GROUP BY metric_entity"""))
def q_metric_refusals(spark, sf_dir):
    """Every metric asked by every dimension; combinations across entities are refused."""
    model = _model(spark, sf_dir)
    tally = {e: [0, 0] for e in model.entities}
    for m in model.metrics.values():
        for d in model.dimensions.values():
            try:
                model.query([m.name], [d.name])
                tally[m.entity][1] += 1
            except metrics.MetricError:
                tally[m.entity][0] += 1
    out = None
    for name, (refused, answered) in tally.items():
        one = model.entities[name].frame().agg(F.count("*").alias("entity_rows")).select(
            F.lit(name).alias("metric_entity"), F.lit(refused).cast("long").alias("refused"),
            F.lit(answered).cast("long").alias("answered"), "entity_rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("masked_sql", _MASKED_SQL)
def q_masked_sql(spark, sf_dir):
    """G1-G3 through the SQL masking functions, bound to the analyst's role."""
    register_sql_functions(spark, ANALYST_ROLE)
    Context(spark, sf_dir).subscribers.createOrReplaceTempView("subscribers")
    return spark.sql("""
SELECT user_id, mask_name(full_name) AS full_name, mask_email(email) AS email, mask_phone(phone) AS phone,
       subscription_type, ltv_estimated_eur
FROM subscribers""")
