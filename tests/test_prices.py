"""Prices: the small cases whose results are known."""

from __future__ import annotations

import datetime

import pytest

from tidemark.functions import time_buckets as tb
from tidemark.operators import prices

DAY = tb.DAY


def ms(y, m, d):
    return int(datetime.datetime(y, m, d, tzinfo=datetime.UTC).timestamp() * 1000)


def series(spark, rows):
    return spark.createDataFrame(rows, "timestamp_ms long, value double")


def points(df):
    return sorted(tuple(r) for r in df.select("timestamp_ms", "value").collect())


def test_vwap(spark):
    rows = [(1000, 100.0, 50.0), (1000, 110.0, 50.0), (2000, 200.0, 10.0), (3000, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "timestamp_ms long, close double, base_volume double")
    assert points(prices.vwap(df)) == [(1000, 105.0), (2000, 200.0)]


def test_daily_close(spark):
    rows = [(1, 100.0), (2, 105.0), (3, 110.0), (4, None), (DAY, 200.0), (DAY + 5, 195.0)]
    assert points(prices.daily_close(series(spark, rows))) == [(0, 110.0), (DAY, 195.0)]


def test_weekly_close(spark):
    rows = [(ms(2023, 11, 13), 100.0), (ms(2023, 11, 15), 105.0), (ms(2023, 11, 19), 110.0), (ms(2023, 11, 20), 200.0)]
    assert points(prices.weekly_close(series(spark, rows))) == [(ms(2023, 11, 13), 110.0), (ms(2023, 11, 20), 200.0)]


def test_buckets_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(ms(2023, 11, 19) + 1,)], "timestamp_ms long")
    want = None
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = df.select(tb.day("timestamp_ms"), tb.week("timestamp_ms"), tb.month_key("timestamp_ms")).first()
        want = want or got
        assert tuple(got) == tuple(want) == (ms(2023, 11, 19), ms(2023, 11, 13), "2023-11")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cross_rate(spark):
    usd, ref = series(spark, [(1000, 500.0), (2000, 750.0), (3000, 1.0)]), series(spark, [(1000, 50000.0), (2000, 50000.0), (3000, 0.0)])
    assert points(prices.cross_rate(usd, ref)) == [(1000, 0.01), (2000, 0.015)]


@pytest.mark.parametrize("observed, threshold, flagged", [(0.0094, 0.05, 1), (0.0102, 0.05, 0), (0.0102, 0.01, 1)])
def test_cross_rate_check(spark, observed, threshold, flagged):
    one = lambda v: series(spark, [(1000, v)])
    assert prices.cross_rate_check(one(500.0), one(50000.0), one(observed), threshold).count() == flagged
    assert prices.cross_rate_check(one(500.0), one(50000.0), series(spark, [(2000, 1.0)]), threshold).count() == 0


def test_composite_staleness(spark):
    df = spark.createDataFrame([("kraken", 500.0, 1.0, 99_000), ("old", 900.0, 1.0, 0), ("none", 1.0, 0.0, 99_000)], "exchange string, price double, volume double, timestamp_ms long")
    r = prices.composite(df, 100_000, 5_000).first()
    assert (r.price, r.venues) == (500.0, ["kraken"])
    r = prices.composite(df, 1_000_000, 5_000).first()
    assert (r.price, r.venues) == (None, [])


def test_normalise_candles(spark):
    rows = [("k", "p", [60_000.0 * i, 1.0, 2.0, 0.5, 1.5, 10.0 if i else None]) for i in range(5)] + [("k", "p", [0.0, None, 1.0, 1.0, 1.0, 1.0])]
    good, bad = prices.normalise_candles(spark.createDataFrame(rows, "exchange string, pair string, tuple array<double>"), 60_000, 4 * 60_000 + 30_000)
    got = good.orderBy("timestamp_ms").collect()
    assert [r.is_partial for r in got] == [False] * 4 + [True]
    assert [r.quote_volume for r in got] == [0.0, 15.0, 15.0, 15.0, 15.0] and bad.count() == 1


def test_latest_fetch(spark):
    rows = [("a", 1, 5.0, 100), ("a", 2, 6.0, 100), ("a", 1, 8.0, 200), ("a", 2, 11.0, 200), ("a", 3, 15.0, 200), ("b", 1, 1.0, 50)]
    df = spark.createDataFrame(rows, "keyword string, week_start_ms long, value double, fetched_at_ms long")
    assert sorted(r.value for r in prices.latest_fetch(df, "keyword", "fetched_at_ms").collect()) == [1.0, 8.0, 11.0, 15.0]


def test_trend_points_and_channels(spark):
    raw = spark.createDataFrame([("k", 10, [3.0, 4.0], None, 1), ("k", 11, [], True, 1)], "keyword string, time_s long, values array<double>, is_partial boolean, fetched_at_ms long")
    assert [tuple(r) for r in prices.trend_points(raw).collect()] == [("k", 10_000, 3.0, False, 1), ("k", 11_000, 0.0, True, 1)]
    stats = spark.createDataFrame([("c", "h", "t", datetime.date(2024, 1, 1), "7", "8", "9", 1)], "channel_id string, handle string, title string, date date, view_count string, subscriber_count string, video_count string, fetched_at_ms long")
    rows, missing = prices.channel_stats(stats, spark.createDataFrame([("c",), ("d",)], "channel_id string"))
    assert rows.first().view_count == 7 and [r.channel_id for r in missing.collect()] == ["d"]
