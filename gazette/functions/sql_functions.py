"""SQL surface: temporary SQL functions (inlined by the analyzer, JVM-only).

* ``predict_churn_rule(days_since_last_login, articles_read_30d,
  subscription_months, avg_session_sec, paywall_bounces_30d)`` -- a table
  function returning ``(churn_probability, risk_segment)`` for
  ``FROM t, LATERAL predict_churn_rule(...)`` (J7).  It scores with the
  fixed formula (M11); NULL inputs count as 0; the probability is rounded
  to 4 places and the segment uses the unrounded value.
* ``predict_churn(...)`` -- the same arguments, scored by trained trees (M9):
  the ensemble is written out as nested conditions.
* ``mask_email / mask_name / mask_phone(value)`` -- the masking policies
  (G1-G3) for the role bound when the functions are registered (exact match),
  so a query cannot name a role of its own.

Unlike Python UDFs/UDTFs these are SQL bodies, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .rules import churn_rule_score_sql
from .constants import (
    EMAIL_MASK, NAME_MASK, PHONE_MASK_PREFIX, PRIVILEGED_ROLES, RISK_HIGH, RISK_MEDIUM, SUBSCRIPTION_CODE_DEFAULT,
)


def register_sql_functions(spark: SparkSession, role: str | None = None) -> None:
    clear = role in PRIVILEGED_ROLES
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION predict_churn_rule(
  days_since_last_login BIGINT, articles_read_30d BIGINT, subscription_months BIGINT,
  avg_session_sec DOUBLE, paywall_bounces_30d BIGINT)
RETURNS TABLE (churn_probability DOUBLE, risk_segment STRING)
RETURN SELECT round(s, 4),
              CASE WHEN s > {RISK_HIGH}D THEN 'HIGH' WHEN s > {RISK_MEDIUM}D THEN 'MEDIUM' ELSE 'LOW' END
FROM (SELECT {churn_rule_score_sql("coalesce(days_since_last_login, 0)", "coalesce(articles_read_30d, 0)",
                                    "coalesce(paywall_bounces_30d, 0)", dbl="D")} AS s)""")
    bodies = {"mask_email": f"regexp_replace(val, '.+@', '{EMAIL_MASK}')", "mask_name": f"'{NAME_MASK}'",
              "mask_phone": f"concat('{PHONE_MASK_PREFIX}', right(val, 2))"}
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(val STRING) RETURNS STRING "
                  f"RETURN {'val' if clear else body}")


def register_tree_function(spark: SparkSession, nodes: dict, name: str = "predict_churn",
                           subscription_code: int = SUBSCRIPTION_CODE_DEFAULT) -> None:
    """A table function over trained trees: ``FROM t, LATERAL predict_churn(...)``.

    ``nodes`` are the arrays of ``operators.churn.tree_nodes``.  Each tree is
    written as nested conditions, so a row costs the comparisons on its paths
    and carries no node arrays; the leaves, times their tree's weight, are added
    up in the order of the trees.  Arguments are those of
    ``predict_churn_rule``; the subscription code is fixed, as the serving
    function fixes it.  NULL arguments count as 0; the probability is rounded to
    4 places, the segment uses the unrounded value.
    """
    def branch(n: int) -> str:
        if nodes["feature"][n] < 0:
            return f"{nodes['value'][n]!r}D"
        return (f"if(x{nodes['feature'][n]} <= {nodes['threshold'][n]!r}D, {branch(nodes['left'][n])}, "
                f"{branch(nodes['right'][n])})")

    leaves = ", ".join(f"{w!r}D * {branch(root)}" for w, root in zip(nodes["weight"], nodes["root"]))
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(
  days_since_last_login BIGINT, articles_read_30d BIGINT, subscription_months BIGINT,
  avg_session_sec DOUBLE, paywall_bounces_30d BIGINT)
RETURNS TABLE (churn_probability DOUBLE, risk_segment STRING)
RETURN SELECT round(p, 4), CASE WHEN p > {RISK_HIGH}D THEN 'HIGH' WHEN p > {RISK_MEDIUM}D THEN 'MEDIUM' ELSE 'LOW' END
FROM (SELECT 1D / (1D + exp(-2D * aggregate(array({leaves}), 0D, (total, leaf) -> total + leaf))) AS p
      FROM (SELECT CAST(coalesce(days_since_last_login, 0) AS DOUBLE) AS x0, CAST(coalesce(articles_read_30d, 0) AS DOUBLE) AS x1,
                   CAST(coalesce(subscription_months, 0) AS DOUBLE) AS x2, coalesce(avg_session_sec, 0D) AS x3,
                   CAST(coalesce(paywall_bounces_30d, 0) AS DOUBLE) AS x4, {float(subscription_code)}D AS x5))""")
