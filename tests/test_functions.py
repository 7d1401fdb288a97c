import datetime as dt

import duckdb
from pyspark.sql import functions as F

from gazette.functions import boundary_diff, bucket, pct_or_null, pct_or_zero, tier
from gazette.plans.oracle import sql_bucket
from gazette.functions.rules import churn_rule_score, engagement_segment, risk_segment


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_minute_boundary_not_elapsed(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(boundary_diff("minute", "a", "b").alias("m"),
                  F.timestamp_diff("MINUTE", "a", "b").alias("elapsed")).first()
    assert r.m == 1 and r.elapsed == 0


def test_second_and_hour_boundaries_and_sign(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:59:59.900"), ts("2024-01-01 09:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(boundary_diff("hour", "a", "b").alias("h"),
                  boundary_diff("second", "b", "a").alias("s")).first()
    assert r.h == -1
    assert r.s == 7199


def test_month_boundary(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1))], "a date, b date")
    assert df.select(boundary_diff("month", "a", "b").alias("m")).first().m == 1


def test_null_previous_gives_null(spark):
    df = spark.createDataFrame([(None, ts("2024-01-01 00:00:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(boundary_diff("minute", "a", "b").alias("m")).first().m is None


def test_bucket_matches_duckdb(spark):
    ids = list(range(0, 300, 7))
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    got = {r.x: (r.b9, r.b16) for r in df.select("x", bucket("x", 9).alias("b9"),
                                                   bucket("x", 16, "auth").alias("b16")).collect()}
    con = duckdb.connect()
    want = {x: (a, b) for x, a, b in con.execute(
        f"SELECT x, {sql_bucket('x', 9)}, {sql_bucket('x', 16, 'auth')} FROM range(0, 300, 7) t(x)").fetchall()}
    assert got == want


def test_tiers_strict_and_inclusive(spark):
    df = spark.createDataFrame([(30,), (29,), (25,), (18,), (17,)], "n long")
    incl = [r.t for r in df.select(tier("n", [("VIRAL", 30), ("HIGH", 25), ("NORMAL", 18)]).alias("t")).collect()]
    strict = [r.t for r in df.select(tier("n", [("VIRAL", 30), ("HIGH", 25), ("NORMAL", 18)], strict=True)
                                     .alias("t")).collect()]
    assert incl == ["VIRAL", "HIGH", "HIGH", "NORMAL", "LOW"]
    assert strict == ["HIGH", "HIGH", "NORMAL", "LOW", "LOW"]


def test_two_zero_rules(spark):
    df = spark.createDataFrame([(3, 0), (1, 4), (2, None)], "num long, den long")
    r = df.select(pct_or_null("num", "den").alias("a"), pct_or_zero("num", "den").alias("b")).collect()
    assert [x.a for x in r] == [None, 25.0, None]
    assert [x.b for x in r] == [0.0, 25.0, 0.0]


def test_segment_rule_order_and_risk(spark):
    df = spark.createDataFrame([(60, 7), (25, 80), (10, 50), (10, 10), (60, 8)], "a long, d long")
    segs = [r.s for r in df.select(engagement_segment("a", "d").alias("s")).collect()]
    assert segs == ["loyal", "regular", "dormant", "casual", "regular"]
    df2 = spark.createDataFrame([(90, 0, 30)], "d long, a long, b long")
    r = df2.select(churn_rule_score("d", "a", "b").alias("s")).first()
    assert abs(r.s - 1.0) < 1e-12
    df3 = spark.createDataFrame([(0.7,), (0.70001,), (0.4,), (0.41,)], "p double")
    assert [r.r for r in df3.select(risk_segment("p").alias("r")).collect()] == ["MEDIUM", "HIGH", "LOW", "MEDIUM"]
