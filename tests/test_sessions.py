import datetime as dt

from conftest import SMOKE, rows
from gazette.operators import sessions as S
from gazette.plans.context import Context

SCHEMA = ("event_id long, user_pseudo_id long, event_timestamp timestamp_ntz, event_name string, "
          "article_id long, section string, engagement_time_sec long, device_category string, "
          "traffic_source string")


def ev(spark, data):
    out = []
    for i, (u, t, *rest) in enumerate(data):
        sec = rest[0] if rest else "Sport"
        out.append((i, u, dt.datetime.fromisoformat(t), "page_view", 1, sec, 10, "mobile", "google"))
    return spark.createDataFrame(out, SCHEMA)


def test_gap_30_vs_31_boundaries(spark):
    df = ev(spark, [(1, "2024-01-01 00:00:59"), (1, "2024-01-01 00:30:00"),   # 30 boundaries: same session
                    (1, "2024-01-01 01:01:00")])                             # 31 boundaries: new session
    for m in ("buckets", "window"):
        got = rows(S.sessionize(df, 30, method=m), "event_id", "session_id")
        assert got == [(0, 0), (1, 0), (2, 1)], m


def test_minute_boundary_counts_not_elapsed(spark):
    # elapsed 30m01s but only 30 minute boundaries -> same session
    df = ev(spark, [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:01")])
    assert rows(S.sessionize(df, 30), "session_id") == [(0,), (0,)]


def test_ties_null_user_and_first_event(spark):
    df = ev(spark, [(None, "2024-01-01 00:00:00"), (None, "2024-01-01 03:00:00"),
                    (2, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00")])
    got = rows(S.sessions(df, 30), "user_pseudo_id", "session_id", "total_events")
    assert sorted(got, key=str) == sorted([(None, 0, 1), (None, 1, 1), (2, 0, 2)], key=str)


def test_sections_sorted_distinct_without_null(spark):
    df = ev(spark, [(1, "2024-01-01 00:00:00", "Sport"), (1, "2024-01-01 00:01:00", None),
                    (1, "2024-01-01 00:02:00", "Culture"), (1, "2024-01-01 00:03:00", "Sport")])
    r = S.sessions(df, 30).first()
    assert r.sections_visited == ["Culture", "Sport"]
    assert r.session_duration_sec == 180


def test_bucket_method_equals_window_method(spark):
    events = Context(spark, SMOKE).events
    for gap in (30, 720):
        a = rows(S.sessions(events, gap, method="buckets"))
        b = rows(S.sessions(events, gap, method="window"))
        assert a == b


def test_invariant_events_sum(spark):
    events = Context(spark, SMOKE).events
    total = S.sessions(events, 30).groupBy().sum("total_events").first()[0]
    assert total == events.count()


def test_window_method_single_exchange(spark):
    events = Context(spark, SMOKE).events.select("event_id", "user_pseudo_id", "event_timestamp")
    plan = S.sessionize(events, 30, method="window")._jdf.queryExecution().executedPlan().toString()
    # lag and running sum share one shuffle + sort (AQE wrapper may add none)
    assert plan.count("Exchange hashpartitioning(user_pseudo_id") == 1
