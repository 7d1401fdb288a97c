import pytest

from conftest import SMOKE, rows
from gazette.functions.constants import ANALYST_ROLE
from gazette.operators import masking, metrics
from gazette.operators.aggregates import article_performance, reader_engagement
from gazette.plans.context import Context


def subs(spark):
    return spark.createDataFrame(
        [(1, "Ann Lee", "a.b@c@example.com", "+33 6 11 22 33 44"),
         (2, None, "no-at-sign", None),
         (3, "Bo", None, "7")],
        "user_id long, full_name string, email string, phone string")


def test_analyst_masks(spark):
    got = rows(masking.secured(subs(spark), masking.SUBSCRIBER_POLICIES, ANALYST_ROLE))
    assert got == [(1, "*** MASKED ***", "****@example.com", "+33 **** ** 44"),
                   (2, "*** MASKED ***", "no-at-sign", None),
                   (3, "*** MASKED ***", None, "+33 **** ** 7")]


def test_admin_unchanged_and_exact_role(spark):
    df = subs(spark)
    assert rows(masking.secured(df, masking.SUBSCRIBER_POLICIES, "ACCOUNTADMIN")) == rows(df)
    assert rows(masking.secured(df, masking.SUBSCRIBER_POLICIES, "accountadmin")) != rows(df)
    assert rows(masking.secured(df, masking.SUBSCRIBER_POLICIES, "SYSADMIN")) != rows(df)


@pytest.fixture(scope="module")
def model(spark):
    ctx = Context(spark, SMOKE)
    return metrics.content_model(article_performance(ctx.articles, ctx.events), reader_engagement(ctx.events))


def test_synonyms_resolve(model):
    assert model.resolve("Rubrique").name == "section"
    assert model.resolve("temps de lecture").name == "avg_reading_time"
    assert model.resolve("vues").name == "total_page_views"


def test_cross_entity_rejected(model):
    with pytest.raises(metrics.MetricError):
        model.query(["total_page_views"], ["section"])
    with pytest.raises(metrics.MetricError):
        model.query(["nope"], [])


def test_metric_totals_consistent(model):
    by_sec = model.query(["article_count", "total_unique_readers"], ["section"])
    total = model.query(["article_count", "total_unique_readers"], [])
    s = by_sec.groupBy().sum("article_count", "total_unique_readers").first()
    t = total.first()
    assert (s[0], s[1]) == (t.article_count, t.total_unique_readers)


def test_secured_view_same_query_role_dependent(spark):
    df = subs(spark)
    masking.create_secured_view(df, "subscribers_admin", masking.SUBSCRIBER_POLICIES, "ACCOUNTADMIN")
    masking.create_secured_view(df, "subscribers_analyst", masking.SUBSCRIBER_POLICIES, ANALYST_ROLE)
    q = "SELECT user_id, email FROM {} WHERE user_id = 1"
    assert spark.sql(q.format("subscribers_admin")).first().email == "a.b@c@example.com"
    assert spark.sql(q.format("subscribers_analyst")).first().email == "****@example.com"
