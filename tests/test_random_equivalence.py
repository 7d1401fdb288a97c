"""Randomized brute-force checks against DuckDB on generated small frames."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd

from gazette.functions import boundary_diff
from gazette.operators import sessions as S

BASE = dt.datetime(2024, 1, 30, 23, 0, 0)


def rand_ts(rng, n, span_sec):
    secs = rng.integers(0, span_sec, n)
    micros = rng.integers(0, 1_000_000, n) * rng.integers(0, 2, n)
    return [BASE + dt.timedelta(seconds=int(s), microseconds=int(u)) for s, u in zip(secs, micros)]


def test_boundary_diff_matches_duckdb(spark):
    rng = np.random.default_rng(7)
    n = 3000
    a = rand_ts(rng, n, 90 * 86400)
    b = rand_ts(rng, n, 90 * 86400)
    pdf = pd.DataFrame({"i": range(n), "a": a, "b": b})
    df = spark.createDataFrame([(int(i), x.to_pydatetime(), y.to_pydatetime()) for i, x, y in pdf.itertuples(index=False)],
                               "i long, a timestamp_ntz, b timestamp_ntz")
    units = ["second", "minute", "hour", "day", "month"]
    got = {r.i: tuple(r[u] for u in units) for r in
           df.select("i", *[boundary_diff(u, "a", "b").alias(u) for u in units]).collect()}
    con = duckdb.connect()
    con.register("p", pdf)
    want = {r[0]: tuple(r[1:]) for r in con.execute(
        "SELECT i, " + ", ".join(f"date_diff('{u}', a, b)" for u in units) + " FROM p").fetchall()}
    assert got == want


def test_sessions_random_events_match_duckdb(spark):
    rng = np.random.default_rng(11)
    n = 4000
    users = rng.integers(0, 40, n).astype(object)
    users[rng.random(n) < 0.02] = None                     # NULL readers form one partition
    ts = rand_ts(rng, n, 3 * 86400)
    ts = [t.replace(microsecond=0) for t in ts]
    for k in range(0, n, 97):                              # forced ties
        ts[k] = ts[k - 1] if k else ts[k]
    rows = [(i, users[i], ts[i], "page_view", int(rng.integers(0, 20)),
             ["Sport", "Culture", None][int(rng.integers(0, 3))], int(rng.integers(5, 600)), "mobile", "google")
            for i in range(n)]
    schema = ("event_id long, user_pseudo_id long, event_timestamp timestamp_ntz, event_name string, "
              "article_id long, section string, engagement_time_sec long, device_category string, "
              "traffic_source string")
    df = spark.createDataFrame(rows, schema)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    con = duckdb.connect()
    con.register("ev", pdf)
    for gap in (30, 5, 720):
        want = sorted(con.execute(f"""
            WITH f AS (SELECT *, CASE WHEN date_diff('minute', lag(event_timestamp) OVER w, event_timestamp) > {gap}
                                      THEN 1 ELSE 0 END AS flag
                       FROM ev WINDOW w AS (PARTITION BY user_pseudo_id ORDER BY event_timestamp, event_id)),
                 s AS (SELECT *, sum(flag) OVER (PARTITION BY user_pseudo_id ORDER BY event_timestamp, event_id
                                                 ROWS UNBOUNDED PRECEDING) AS sid FROM f)
            SELECT user_pseudo_id, CAST(sid AS BIGINT), count(*), count(DISTINCT article_id),
                   CAST(sum(engagement_time_sec) AS BIGINT)
            FROM s GROUP BY 1, 2""").fetchall(), key=repr)
        for method in ("buckets", "window"):
            got = sorted(((r.user_pseudo_id, r.session_id, r.total_events, r.articles_viewed, r.total_engagement_sec)
                          for r in S.sessions(df, gap, method=method).collect()), key=repr)
            assert got == want, (gap, method)
