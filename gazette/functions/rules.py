"""Business rules as Column expressions: tiers, safe ratios, segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (
    CHURN_BOUNCES_CAP, CHURN_DAYS_SCALE, CHURN_READS_CAP, CHURN_W_BOUNCES, CHURN_W_READING,
    CHURN_W_RECENCY, DORMANT_MIN_DAYS, LOYAL_MAX_DAYS, LOYAL_MIN_READS, REGULAR_MIN_READS,
    RISK_HIGH, RISK_MEDIUM,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tier(value, thresholds, strict: bool = False, default: str = "LOW") -> Column:
    """Searched CASE over ordered ``(label, threshold)`` pairs.

    ``strict=False`` tests ``>=`` (article performance preset), ``strict=True``
    tests ``>`` (content analytics preset).  First match wins.
    """
    v = _c(value)
    expr = None
    for label, thr in thresholds:
        cond = (v > F.lit(thr)) if strict else (v >= F.lit(thr))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def pct_or_null(num, den, scale: int = 1) -> Column:
    """``round(num / nullif(den, 0) * 100, scale)``: NULL when den is 0."""
    return F.round(_c(num) / F.nullif(_c(den), F.lit(0)) * F.lit(100), scale)


def pct_or_zero(num, den, scale: int = 1) -> Column:
    """``CASE WHEN den > 0 THEN round(num / den * 100, scale) ELSE 0 END``.

    NULL or zero denominators give 0 (as a double).
    """
    d = _c(den)
    return (F.when(d > 0, F.round(_c(num) / F.nullif(d, F.lit(0)) * F.lit(100), scale))
            .otherwise(F.lit(0.0)))


def churn_rule_score(days_since_login, articles_read_30d, paywall_bounces_30d) -> Column:
    """Fixed-formula churn score (weights and caps in ``constants``), double arithmetic."""
    return (_c(days_since_login) / F.lit(float(CHURN_DAYS_SCALE)) * F.lit(CHURN_W_RECENCY)
            + (F.lit(1.0) - F.least(_c(articles_read_30d), F.lit(CHURN_READS_CAP))
               / F.lit(float(CHURN_READS_CAP))) * F.lit(CHURN_W_READING)
            + F.least(_c(paywall_bounces_30d), F.lit(CHURN_BOUNCES_CAP))
            / F.lit(float(CHURN_BOUNCES_CAP)) * F.lit(CHURN_W_BOUNCES))


def churn_rule_score_sql(days: str, reads: str, bounces: str, dbl: str = "") -> str:
    """The same score as SQL text; ``dbl="D"`` marks double literals for Spark SQL."""
    def lit(x):
        return f"{float(x)}{dbl}"
    return (f"CAST({days} AS DOUBLE) / {lit(CHURN_DAYS_SCALE)} * {lit(CHURN_W_RECENCY)}"
            f" + ({lit(1)} - CAST(least({reads}, {CHURN_READS_CAP}) AS DOUBLE) / {lit(CHURN_READS_CAP)})"
            f" * {lit(CHURN_W_READING)}"
            f" + CAST(least({bounces}, {CHURN_BOUNCES_CAP}) AS DOUBLE) / {lit(CHURN_BOUNCES_CAP)}"
            f" * {lit(CHURN_W_BOUNCES)}")


def engagement_segment(articles_read_30d, days_since_login) -> Column:
    """Ordered rules: loyal, regular (tested before dormant), dormant, casual."""
    a, d = _c(articles_read_30d), _c(days_since_login)
    return (F.when((a >= LOYAL_MIN_READS) & (d <= LOYAL_MAX_DAYS), F.lit("loyal"))
            .when(a >= REGULAR_MIN_READS, F.lit("regular"))
            .when(d >= DORMANT_MIN_DAYS, F.lit("dormant"))
            .otherwise(F.lit("casual")))


def risk_segment(prob, high: float = RISK_HIGH, medium: float = RISK_MEDIUM) -> Column:
    """Strict thresholds on the unrounded probability."""
    p = _c(prob)
    return (F.when(p > high, F.lit("HIGH"))
            .when(p > medium, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))
