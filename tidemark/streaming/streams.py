"""Streaming jobs over landed files: incremental silver, upserts, closes, balances, gap alarms and live rates."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.sources.schemas import RAO_SUM
from tidemark.sources.tables import upsert_candles

#: The state store for state by `transformWithState`.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed(spark: SparkSession, folder: str, schema: str, glob: str | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(folder)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that has landed since the checkpoint, append it to a table and stop: a rerun goes on exactly there."""
    df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def run_batches(df: DataFrame, write, checkpoint: str, mode: str = "update", state: str = ROCKSDB) -> None:
    """The same with a function (batch, number) as the sink; state: the class that keeps the state."""
    conf, key = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    try:
        conf.set(key, state)
        query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(key, before)
    query.awaitTermination()


def deduplicated(events: DataFrame, keys: list[str], ts: str = "timestamp_ms", late: str = "1 day") -> DataFrame:
    """One row per key of overlapping or redone ranges; keys are forgotten once the watermark has passed them."""
    return events.withColumn("_at", F.timestamp_millis(ts)).withWatermark("_at", late).dropDuplicatesWithinWatermark(keys).drop("_at")


def upserted_candles(candles: DataFrame, path: str, checkpoint: str) -> None:
    """Late and revised candles: the newest version of a minute replaces the one that is there."""
    run_batches(candles, lambda batch, _: upsert_candles(batch, path), checkpoint, "append")


def daily_figures(candles: DataFrame, late: str = "2 days", width: str = "1 day", start: str | None = None) -> DataFrame:
    """(timestamp_ms, pair, close, volume) by tumbling window, emitted once the watermark has passed its end.

    Weeks: width "7 days" with start "4 days", as the epoch was a Thursday.
    """
    at = candles.withColumn("_at", F.timestamp_millis("timestamp_ms")).withWatermark("_at", late)
    window = F.window("_at", width, width, start) if start else F.window("_at", width)
    return at.groupBy(window.alias("w"), "pair").agg(F.max_by("close", F.struct("timestamp_ms", "close")).alias("close"), F.sum("quote_volume").alias("volume")).select(
        F.unix_millis("w.start").alias("timestamp_ms"), "pair", "close", "volume"
    )


def summed_by_batch(legs: DataFrame) -> DataFrame:
    """(coldkey, delta): one row for each account in each Arrow batch, so that few rows of a busy account meet its state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by("coldkey").aggregate([("delta", "sum")])
            yield from found.select(["coldkey", "delta_sum"]).rename_columns(["coldkey", "delta"]).cast(batch.schema).to_batches()

    whole = legs.select("coldkey", F.col("delta").cast(RAO_SUM).alias("delta")).where("delta is not null")
    return whole.mapInArrow(run, f"coldkey string, delta {RAO_SUM}")


class _Balance(StatefulProcessor):
    """An account's balance, an exact decimal."""

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", f"total {RAO_SUM}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.total.get()
        total = sum((d for pdf in rows for d in pdf["delta"]), known[0] if known else Decimal(0))
        self.total.update((total,))
        yield pd.DataFrame({"coldkey": [key[0]], "balance_rao": [total]})

    def close(self) -> None:
        pass


def running_balances(legs: DataFrame) -> DataFrame:
    """(coldkey, balance_rao) after each batch, from (coldkey, delta): one exact state per account, emitted when it changes.

    Legs are summed per account before they are shuffled, so an account with half of them is a few rows. The state needs
    the RocksDB store, with which run_batches starts a query.
    """
    return summed_by_batch(legs).groupBy("coldkey").transformWithStateInPandas(_Balance(), f"coldkey string, balance_rao {RAO_SUM}", "Update", "None")


def gap_alarms(ticks: DataFrame, interval_ms: int, late: str = "1 hour") -> DataFrame:
    """(series, gap_start_ms, gap_end_ms, missing): gaps of each series as they close, from (series, timestamp_ms).

    The state is the last bucket of the series. Buckets of one batch are put in order first; a bucket older than
    the watermark is dropped.
    """

    def watch(key, batches: Iterator[pd.DataFrame], state):
        oldest = state.getCurrentWatermarkMs()
        times = sorted({int(t) for pdf in batches for t in pdf["timestamp_ms"] if t >= oldest})
        last = state.get[0] if state.exists else None
        found = []
        for t in times:
            if last is not None and t - last > interval_ms:
                found.append((key[0], last + interval_ms, t - interval_ms, round((t - last) / interval_ms) - 1))
            last = t if last is None else max(last, t)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(found, columns=["series", "gap_start_ms", "gap_end_ms", "missing"])

    at = ticks.withColumn("_at", F.timestamp_millis("timestamp_ms")).withWatermark("_at", late).select("series", "timestamp_ms", "_at")
    return at.groupBy("series").applyInPandasWithState(watch, "series string, gap_start_ms long, gap_end_ms long, missing long", "last long", "append", "NoTimeout")


def silence_alarms(ticks: DataFrame, interval_ms: int, late: str = "1 hour", clock: DataFrame | None = None) -> DataFrame:
    """(series, silent_from_ms): series whose next tick is overdue, from (series, timestamp_ms); gap_alarms gives the gap once it closes.

    The state is the last bucket of the series and whether its silence is reported; the timer fires once the watermark has
    passed the next bucket. Every call clears the timer, so a tick that is no news sets it again. The watermark moves with
    all series and with clock, a stream of (timestamp_ms) such as one row for each run of the poller: with it, a stop of
    all series is reported as well.
    """

    def watch(key, batches: Iterator[pd.DataFrame], state):
        found = []
        if key[0] is None:  # the clock
            for _ in batches:
                pass
        elif state.hasTimedOut:
            found.append((key[0], state.get[0] + interval_ms))
            state.update((state.get[0], True))
        else:
            latest = max(int(pdf["timestamp_ms"].max()) for pdf in batches)
            last, reported = state.get if state.exists else (latest, False)
            last, reported = max(last, latest), reported and latest <= last
            state.update((last, reported))
            if not reported:
                state.setTimeoutTimestamp(max(last + interval_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=["series", "silent_from_ms"])

    rows = ticks.select("series", "timestamp_ms").where("series is not null")
    if clock is not None:  # before the watermark, so that there is one of both
        rows = rows.unionByName(clock.select(F.lit(None).cast("string").alias("series"), "timestamp_ms"))
    at = rows.withColumn("_at", F.timestamp_millis("timestamp_ms")).withWatermark("_at", late).select("series", "timestamp_ms", "_at")
    return at.groupBy("series").applyInPandasWithState(watch, "series string, silent_from_ms long", "last long, reported boolean", "append", "EventTimeTimeout")


def live_rate(numerator: DataFrame, denominator: DataFrame, late: str = "1 hour") -> DataFrame:
    """The implied rate of two streams (timestamp_ms, value) at equal buckets."""
    a = numerator.withColumn("_a", F.timestamp_millis("timestamp_ms")).withWatermark("_a", late).alias("a")
    b = denominator.where("value <> 0").withColumn("_b", F.timestamp_millis("timestamp_ms")).withWatermark("_b", late).alias("b")
    joined = a.join(b, F.expr("a._a = b._b"))
    return joined.select(F.col("a.timestamp_ms").alias("timestamp_ms"), (F.col("a.value") / F.col("b.value")).alias("value"))
