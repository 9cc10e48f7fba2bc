"""Composite prices, closes, volumes and cross rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import day, week


def vwap(candles: DataFrame, price: str = "close", weight: str = "base_volume", by: str = "timestamp_ms") -> DataFrame:
    """(timestamp_ms, value): the mean price by bucket weighted by volume; rows without volume are left out.

    With integer prices and volumes the sums are exact and only the last division is in doubles.
    """
    return (
        candles.where(F.col(weight) > 0)
        .groupBy(F.col(by).alias("timestamp_ms"))
        .agg((F.sum(F.col(price) * F.col(weight)).cast("double") / F.sum(weight).cast("double")).alias("value"))
    )


def last_by(series: DataFrame, bucket: Column, ts: str = "timestamp_ms", value: str = "value") -> DataFrame:
    """The last value of each bucket; null values don't count, of equal times the larger value is taken."""
    return (
        series.where(F.col(value).isNotNull())
        .groupBy(bucket.alias("timestamp_ms"))
        .agg(F.max_by(value, F.struct(ts, value)).alias("value"))
    )


def daily_close(series: DataFrame) -> DataFrame:
    return last_by(series, day("timestamp_ms"))


def weekly_close(daily: DataFrame) -> DataFrame:
    """Closes of Monday weeks, from daily closes rather than from minutes."""
    return last_by(daily, week("timestamp_ms"))


def cross_rate(numerator: DataFrame, denominator: DataFrame) -> DataFrame:
    """Quotient of two series at equal times; times where the denominator is zero are left out."""
    other = denominator.where(F.col("value") != 0).select("timestamp_ms", F.col("value").alias("_by"))
    return numerator.join(other, "timestamp_ms").select("timestamp_ms", (F.col("value") / F.col("_by")).alias("value"))


def daily_sum(df: DataFrame, value: str, ts: str = "timestamp_ms") -> DataFrame:
    return df.groupBy(day(ts).alias("timestamp_ms")).agg(F.sum(value).alias("value"))


def composite(quotes: DataFrame, as_of_ms: int, stale_after_ms: int, by: list[str] | None = None) -> DataFrame:
    """Price and the venues used, from quotes with volume that are not stale at as_of_ms; NULL price and no venues if there are none.

    by: key columns for one composite each; keys keep their row even if all of their quotes are stale.
    """
    fresh = (F.col("volume") > 0) & (F.lit(as_of_ms) - F.col("timestamp_ms") <= stale_after_ms)
    weight = F.sum(F.when(fresh, F.col("volume")))
    price = F.sum(F.when(fresh, F.col("price") * F.col("volume"))).cast("double") / weight.cast("double")
    venues = F.sort_array(F.collect_set(F.when(fresh, F.col("exchange"))))
    return quotes.groupBy(*(by or [])).agg(price.alias("price"), venues.alias("venues"))


def cross_rate_check(usd: DataFrame, reference: DataFrame, observed: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Times at which the implied rate usd/reference is off the observed one by more than a share of it."""
    implied = cross_rate(usd, reference).withColumnRenamed("value", "implied")
    both = implied.join(observed.where(F.col("value") != 0).withColumnRenamed("value", "observed"), "timestamp_ms")
    return both.withColumn("divergence", F.abs(F.col("implied") - F.col("observed")) / F.abs("observed")).where(F.col("divergence") > threshold)


def first_divergences(checked: DataFrame, n: int = 20) -> DataFrame:
    """The first n divergences of cross_rate_check, by time."""
    return checked.orderBy("timestamp_ms").limit(n)


def normalise_candles(raw: DataFrame, interval_ms: int, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """(candles, rejected) from rows (exchange, pair, tuple: array<double> of time, open, high, low, close, volume).

    A missing volume is 0, the quote volume is volume times close, and a bucket that ends after now is partial. Rows
    without one of time and prices are rejected.
    """
    at = lambda k: F.get(F.col("tuple"), F.lit(k))
    bad = F.lit(False)
    for k in range(5):
        bad = bad | at(k).isNull()
    volume = F.coalesce(at(5), F.lit(0.0))
    good = raw.where(~bad).select(
        "exchange", "pair", at(0).cast("long").alias("timestamp_ms"),
        *[at(k).alias(n) for k, n in enumerate(("open", "high", "low", "close"), 1)],
        volume.alias("base_volume"), (volume * at(4)).alias("quote_volume"),
        (at(0).cast("long") + interval_ms > now_ms).alias("is_partial"),
    )
    return good, raw.where(bad)


def candle_silver(bronze: DataFrame) -> DataFrame:
    """Candles without repeated rows."""
    return bronze.distinct()


def latest_fetch(rows: DataFrame, key: str, fetched: str) -> DataFrame:
    """The rows of each key's newest fetch: the newest time is a small aggregate that meets the rows in a join."""
    newest = rows.groupBy(F.col(key).alias("_key")).agg(F.max(fetched).alias("_newest"))
    return rows.join(newest, (F.col(key) == F.col("_key")) & (F.col(fetched) == F.col("_newest"))).select(*rows.columns)


def trend_points(raw: DataFrame) -> DataFrame:
    """Normalised trend points: seconds become milliseconds, a missing first value 0, a missing flag false."""
    return raw.select(
        "keyword", (F.col("time_s") * 1000).cast("long").alias("week_start_ms"),
        F.coalesce(F.get("values", F.lit(0)), F.lit(0.0)).alias("value"), F.coalesce("is_partial", F.lit(False)).alias("is_partial"), "fetched_at_ms",
    )


def channel_stats(raw: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with counters as longs, wanted channels that are missing)."""
    rows = raw.select("channel_id", "handle", "title", "date", *[F.col(c).cast("long").alias(c) for c in ("view_count", "subscriber_count", "video_count")], "fetched_at_ms")
    return rows, wanted.join(raw, "channel_id", "left_anti")


def gained_per_day(snapshots: DataFrame, key: str, date: str, *counters: str) -> DataFrame:
    """What each counter gained since the key's snapshot before; null for the first."""
    order = Window.partitionBy(key).orderBy(date)
    return snapshots.select(key, date, *[(F.col(c) - F.lag(c).over(order)).alias(f"{c}_gained") for c in counters])
