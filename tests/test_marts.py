"""Subscriber journey and content analytics traps on literal frames."""

import datetime as dt

from conftest import rows
from gazette.operators import marts

EV = ("user_pseudo_id long, event_timestamp timestamp_ntz, event_date date, event_name string, "
      "section string, article_id long, engagement_time_sec long")
SUB = ("user_id long, subscription_type string, start_date date, churn_flag boolean, "
       "ltv_estimated_eur double")


def e(u, day, name="page_view", sec="Sport", art=1, eng=10):
    d = dt.date.fromisoformat(day)
    return (u, dt.datetime(d.year, d.month, d.day, 12), d, name, sec, art, eng)


def test_journey_phases_and_stages(spark):
    subs = spark.createDataFrame([
        (1, "premium", dt.date(2024, 1, 1), None, 10.0),     # NULL churn flag falls through
        (2, "student", dt.date(2024, 1, 1), True, 5.0),      # churned wins
        (3, "standard", dt.date(2023, 11, 1), False, 1.0),   # no first-30 events, recent ones -> trend 0
        (4, "standard", dt.date(2024, 1, 1), False, 1.0),    # no events -> absent
    ], SUB)
    ev = spark.createDataFrame([
        e(1, "2023-12-31", sec="Culture", art=7, eng=20),    # d = -1: pre-subscription
        e(1, "2024-01-01"), e(1, "2024-01-31", art=2),       # d = 0 and d = 30: first 30 (inclusive)
        e(1, "2024-02-01", art=3),                           # d = 31: not first 30
        e(2, "2024-01-05"),
        e(3, "2024-02-20", art=9), e(3, "2024-02-21", art=9),
    ], EV)
    out = {r.user_id: r for r in marts.subscriber_journey(ev, subs, "2024-02-29").collect()}
    assert set(out) == {1, 2, 3}
    u1 = out[1]
    assert (u1.events_before_sub, u1.pages_before_sub, u1.sections_explored_pre) == (1, 1, 1)
    assert u1.avg_engagement_pre == 20.0
    assert (u1.events_first_30d, u1.articles_first_30d) == (2, 2)
    # last 30: d >= days(2024-01-01 -> 2024-02-29) - 30 = 59 - 30 = 29
    assert (u1.events_last_30d, u1.articles_last_30d) == (2, 2)
    assert (u1.total_events, u1.total_articles_read, u1.sections_engaged) == (4, 4, 2)
    assert u1.engagement_trend_pct == 0.0 and u1.journey_stage == "STABLE"
    assert out[2].journey_stage == "CHURNED"
    u3 = out[3]
    assert u3.events_first_30d == 0 and u3.events_last_30d == 2
    assert u3.engagement_trend_pct == 0.0 and u3.journey_stage == "STABLE"


def test_journey_trend_rules(spark):
    subs = spark.createDataFrame([(1, "premium", dt.date(2024, 1, 25), False, 1.0),
                                  (2, "premium", dt.date(2023, 12, 1), False, 1.0)], SUB)
    ev = spark.createDataFrame(
        [e(1, "2024-01-26")] + [e(1, "2024-02-20")] * 3 +              # first 30: 4 (incl. recent), last: 3
        [e(2, "2023-12-02")] * 4 + [e(2, "2024-02-25")], EV)           # first: 4, last: 1 -> -75 %
    out = {r.user_id: r for r in marts.subscriber_journey(ev, subs, "2024-02-29").collect()}
    assert out[1].events_first_30d == 4 and out[1].events_last_30d == 3
    assert out[1].engagement_trend_pct == -25.0 and out[1].journey_stage == "STABLE"
    assert out[2].engagement_trend_pct == -75.0 and out[2].journey_stage == "DECLINING"


def test_content_analytics_zero_rules(spark):
    arts = spark.createDataFrame(
        [(1, "t", "a", "Sport", "p", dt.datetime(2024, 1, 1, 10, 30), 500, "none"),
         (2, "t2", "a", "Sport", "p", dt.datetime(2024, 1, 1, 10, 30), 500, "hard")],
        "article_id long, title string, author string, section string, publication string, "
        "published_at timestamp_ntz, word_count long, paywall_type string")
    ev = spark.createDataFrame([
        (1, 1, dt.datetime(2024, 1, 1, 9, 59), "scroll", 80, 10),     # read before publication: -1 hour boundary
        (1, 2, dt.datetime(2024, 1, 1, 11, 0), "page_view", 90, 20),  # deep read needs 'scroll'
    ], "article_id long, user_pseudo_id long, event_timestamp timestamp_ntz, event_name string, "
       "scroll_pct long, engagement_time_sec long")
    out = {r.article_id: r for r in marts.content_analytics(arts, ev).collect()}
    a = out[1]
    assert (a.unique_readers, a.deep_reads, a.conversion_rate_pct) == (2, 1, 0.0)
    assert (a.time_to_first_read_hours, a.lifespan_hours) == (-1, 1)
    b = out[2]
    assert (b.unique_readers, b.total_events, b.avg_engagement_sec, b.conversion_rate_pct) == (0, 0, 0.0, 0.0)
    assert b.lifespan_hours is None and b.performance_tier == "LOW"


def test_tiers_partition_all_articles(spark):
    import __spark_entry__ as E
    from conftest import SMOKE

    for name in ("article_performance_tiers", "content_analytics", "tier_summary"):
        df = E.queries()[name](spark, SMOKE)
        if name == "tier_summary":
            total = df.groupBy().sum("articles").first()[0]
        else:
            assert df.where(~df.performance_tier.isin("VIRAL", "HIGH", "NORMAL", "LOW")).count() == 0
            total = df.count()
        assert total == E.queries()["articles_dim"](spark, SMOKE).count()
