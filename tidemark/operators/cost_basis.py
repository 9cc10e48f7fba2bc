"""Estimated cost basis per account, and the share of the supply that is in profit.

An account's cost is a running weighted mean in whole numbers: what comes in adds its amount times the price as of its
time, what goes out takes its part of the cost along, rounded down. Rounding and overdrawn accounts make the order matter,
so each account's legs are folded one after another. Two choices are the caller's: the price of emission (zero or the
market's), and the price series.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import DAY, day
from tidemark.operators.ledger import UPTO_HERE, every_day
from tidemark.sources.schemas import RAO, RAO_SUM

#: How what was mined or earned by staking enters: without cost, or at the price when it is received.
EMISSION_RULES = ("zero", "market")
#: The order in which an account's legs are folded: time, which is that of blocks, then all that tells legs apart.
ORDER = ("timestamp_ms", "block_number", "event_index", "delta", "emission")
#: Legs in one packed row. Spark hands rows to Python some ten thousand at a time, so this bounds what a worker holds.
PACK = 128


def as_of(asked: DataFrame, points: DataFrame, key: str, value: str, width: int) -> DataFrame:
    """(key, value) for each distinct key that is asked for: the value of the last point at or before it, null before the first.

    Keys are longs. Points and questions are sorted together in ranges of `width`; what was last known before a range is
    carried over from one row for each range, so no task sees the whole series. Points without a value don't count; of
    points with one key the largest value does.
    """
    known = points.where(F.col(value).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
    of_range = F.floor(F.col(key) / width).alias("_range")
    both = known.select(key, value, F.lit(False).alias("_asked")).unionByName(
        asked.where(F.col(key).isNotNull()).select(key).distinct().select(key, F.lit(None).cast(points.schema[value].dataType).alias(value), F.lit(True).alias("_asked"))
    )
    both = both.select("*", of_range)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A struct is kept whole, so a range without points has none to carry.
    latest = F.max(F.when(~F.col("_asked"), F.struct(key, value)))
    carried = both.groupBy("_range").agg(latest.alias("_latest")).select("_range", F.last("_latest", ignorenulls=True).over(before)[value].alias("_carried"))
    inside = Window.partitionBy("_range").orderBy(key, "_asked").rowsBetween(*UPTO_HERE)
    found = both.withColumn("_inside", F.last(value, ignorenulls=True).over(inside)).where("_asked")
    return found.join(carried, "_range").select(key, F.coalesce("_inside", "_carried").alias(value))


def whole_prices(series: DataFrame, scale: int = 1) -> DataFrame:
    """(timestamp_ms, price): a price series as whole numbers of 1/scale, rounded down."""
    return series.select("timestamp_ms", F.floor(F.col("value") * scale).cast("long").alias("price"))


def priced_legs(transfers: DataFrame, events: DataFrame, prices: DataFrame, emission: str, snapshots: DataFrame | None = None) -> DataFrame:
    """(coldkey, timestamp_ms, block_number, event_index, delta, emission, price): what moves an account's cost, each leg with the price as of its time.

    A transfer to oneself moves nothing. Deposits are emission. Before the first price the price is 0.
    """
    if emission not in EMISSION_RULES:
        raise ValueError(f"the emission rule is one of {', '.join(EMISSION_RULES)}")
    amount, at = F.col("amount_rao").cast(RAO), ["timestamp_ms", "block_number", "event_index"]
    leg = lambda account, delta: F.struct(F.col(account).alias("coldkey"), delta.alias("delta"))
    moved = transfers.where(~F.col("from_coldkey").eqNullSafe(F.col("to_coldkey"))).select(*at, F.explode(F.array(leg("from_coldkey", -amount), leg("to_coldkey", amount))).alias("leg"))
    legs = moved.select("leg.coldkey", *at, "leg.delta", F.lit(False).alias("emission"))
    into = F.col("kind") == "deposit"
    legs = legs.unionByName(events.select("coldkey", *at, F.when(into, amount).otherwise(-amount).alias("delta"), F.coalesce(into, F.lit(False)).alias("emission")))
    if snapshots is not None:
        total = F.col("free_rao").cast(RAO) + F.col("reserved_rao").cast(RAO)
        opening = snapshots.where("block_number = 0 and timestamp_ms is not null")
        legs = legs.unionByName(opening.select("coldkey", "timestamp_ms", "block_number", F.lit(-1).alias("event_index"), total.cast(RAO).alias("delta"), F.lit(False).alias("emission")))
    legs = legs.where("coldkey is not null and delta is not null and timestamp_ms is not null")
    priced = legs.join(as_of(legs, prices, "timestamp_ms", "price", DAY), "timestamp_ms")
    free = F.col("price").isNull() if emission == "market" else F.col("price").isNull() | F.col("emission")
    return priced.withColumn("price", F.when(free, 0).otherwise(F.col("price")))


def moved(balance: int, cost: int, delta: int, price: int) -> tuple[int, int]:
    """Balance and cost after one leg. What is overdrawn has no cost, nor has what fills the hole."""
    after = balance + delta
    if delta >= 0:
        return after, cost + delta * price if balance >= 0 else max(after, 0) * price
    if after <= 0:
        return after, 0
    return after, cost - cost * -delta // balance


def _whole(column: pa.Array) -> list[int]:
    """Decimals without a fraction as integers, from their two 64-bit words."""
    words = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
    low, high = words[:, 0], words[:, 1]
    if (high == low >> 63).all():
        return low.tolist()
    return [(h << 64) + (x & (1 << 64) - 1) for h, x in zip(high.tolist(), low.tolist())]


def _packed(ordered: DataFrame) -> DataFrame:
    """Sorted legs as rows of one account's next legs: (coldkey, shard, nth, days, deltas, prices)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            accounts = batch.column(0)
            code = accounts.dictionary_encode().indices.to_numpy()
            first = np.flatnonzero(np.diff(code, prepend=-1))
            own = np.arange(len(code)) - np.repeat(first, np.diff(first, append=len(code)))
            starts = np.flatnonzero(own % PACK == 0)
            offsets = pa.array(np.append(starts, len(code)).astype(np.int32))
            numbers = np.arange(nth, nth + len(starts), dtype=np.int64)
            nth += len(starts)
            lists = [pa.ListArray.from_arrays(offsets, batch.column(k)) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([accounts.take(pa.array(starts)), pa.array(np.full(len(starts), shard, np.int32)), pa.array(numbers), *lists], names=["coldkey", "shard", "nth", "days", "deltas", "prices"])

    return ordered.select("coldkey", "day", F.col("delta").cast(RAO_SUM).alias("delta"), "price").mapInArrow(run, f"coldkey string, shard int, nth long, days array<long>, deltas array<{RAO_SUM}>, prices array<long>")


def daily_cost(legs: DataFrame) -> DataFrame:
    """(coldkey, timestamp_ms, balance_rao, cost): each account's balance and cost at the end of each day on which it moved.

    Legs are sorted in ranges of account and time, so the legs of a busy account are sorted by many tasks and leave them
    packed, PACK to a row. One task then reads an account's packs in order; it holds two numbers at a time.
    """
    keyed = legs.withColumn("day", day("timestamp_ms"))
    ordered = keyed.repartitionByRange("coldkey", *ORDER).sortWithinPartitions("coldkey", *ORDER)
    packs = _packed(ordered).repartition("coldkey").sortWithinPartitions("coldkey", "shard", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        account, at, balance, cost = None, None, 0, 0
        out: list[tuple] = []
        number = pa.decimal128(38, 0)
        emit = lambda: pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), pa.array([Decimal(r[2]) for r in out], number), pa.array([Decimal(r[3]) for r in out], number)],
            names=["coldkey", "timestamp_ms", "balance_rao", "cost"],
        )
        for batch in batches:
            for k in range(batch.num_rows):
                key = batch.column(0)[k].as_py()
                if key != account:
                    if at is not None:
                        out.append((account, at, balance, cost))
                    account, at, balance, cost = key, None, 0, 0
                days, deltas, prices = (batch.column(c)[k].values for c in (1, 2, 3))
                for when, delta, price in zip(days.to_numpy().tolist(), _whole(deltas), prices.to_numpy().tolist()):
                    if when != at:
                        if at is not None:
                            out.append((account, at, balance, cost))
                        at = when
                    balance, cost = moved(balance, cost, delta, price)
            if len(out) >= 10_000:
                yield emit()
                out.clear()
        if at is not None:
            out.append((account, at, balance, cost))
        if out:
            yield emit()

    return packs.select("coldkey", "days", "deltas", "prices").mapInArrow(run, f"coldkey string, timestamp_ms long, balance_rao {RAO_SUM}, cost {RAO_SUM}")


def supply_in_profit(states: DataFrame, prices: DataFrame) -> DataFrame:
    """(timestamp_ms, supply_rao, in_profit_rao, value): on every day, the positive balances, those whose mean cost is below the day's last price, and their share.

    An account's state holds until its next one. Its balance counts from the first price above its mean cost on, and only
    the prices that some day has matter, so balances are summed up by day of change and by the least such price: no more
    cells than days times days, however many accounts there are, and no table of accounts by days. Days before the first
    price have no share.
    """
    # Several chains of joins read these, and the fold behind them is dear: the caller may write them first.
    held = states.where("balance_rao > 0").select("coldkey", "timestamp_ms", "balance_rao", "cost")
    ends = states.select("coldkey", "timestamp_ms", F.lead("timestamp_ms").over(Window.partitionBy("coldkey").orderBy("timestamp_ms")).alias("_until"))
    spans = held.join(ends, ["coldkey", "timestamp_ms"]).withColumn("_least", -(F.floor(F.col("cost") / F.col("balance_rao")) + 1).cast("long"))

    changes = _steps(spans.select("timestamp_ms", "_until", "balance_rao"))
    bounds = states.agg(F.min("timestamp_ms").alias("timestamp_ms"), F.max("timestamp_ms").alias("_last"))
    # Days on which nothing is held count as well, so the first and the last day are changes by nothing.
    edges = bounds.select(F.explode(F.array("timestamp_ms", "_last")).alias("timestamp_ms"), F.lit(0).cast(RAO_SUM).alias("moved")).where("timestamp_ms is not null")
    supply = every_day(changes.unionByName(edges).groupBy("timestamp_ms").agg(F.sum("moved").cast(RAO_SUM).alias("moved")), "moved")

    closes = prices.groupBy(day("timestamp_ms").alias("timestamp_ms")).agg(F.max_by("price", "timestamp_ms").alias("price"))
    spots = supply.select("timestamp_ms", F.col("value").alias("supply_rao")).join(as_of(supply, closes, "timestamp_ms", "price", 1_000 * DAY), "timestamp_ms", "left")

    # The least price of any day at or above a threshold is the last one at or before it when signs are turned.
    levels = spots.where("price is not null").select((-F.col("price")).alias("_least"), F.col("price").alias("level"))
    levelled = spans.join(as_of(spans, levels, "_least", "level", 1_000), "_least").where("level is not null")
    cells = _steps(levelled.select("timestamp_ms", "_until", "balance_rao", "level"), "level").groupBy("level", "timestamp_ms").agg(F.sum("moved").cast(RAO_SUM).alias("moved"))
    of_level = Window.partitionBy("level").orderBy("timestamp_ms")
    upto = F.coalesce(F.lead("timestamp_ms").over(of_level), F.col("_last") + DAY) - DAY
    steps = cells.crossJoin(F.broadcast(bounds.select("_last"))).select("level", "timestamp_ms", F.sum("moved").over(of_level.rowsBetween(*UPTO_HERE)).cast(RAO_SUM).alias("held"), upto.alias("_upto"))
    daily = steps.where("held <> 0 and _upto >= timestamp_ms").select("level", "held", F.explode(F.sequence("timestamp_ms", "_upto", F.lit(DAY).cast("long"))).alias("timestamp_ms"))
    gained = daily.join(spots.select("timestamp_ms", "price"), "timestamp_ms").where("price >= level").groupBy("timestamp_ms").agg(F.sum("held").cast(RAO_SUM).alias("_gained"))
    profit = F.when(F.col("price").isNotNull(), F.coalesce("_gained", F.lit(0).cast(RAO_SUM)))
    return spots.join(gained, "timestamp_ms", "left").select(
        "timestamp_ms", F.col("supply_rao").cast(RAO_SUM).alias("supply_rao"), profit.alias("in_profit_rao"),
        F.when(F.col("supply_rao") > 0, profit.cast("double") / F.col("supply_rao").cast("double")).alias("value"),
    )


def _steps(spans: DataFrame, *keys: str) -> DataFrame:
    """(keys, timestamp_ms, moved): what each span adds when it begins and takes away when it ends."""
    step = lambda at, amount: F.struct(F.col(at).alias("timestamp_ms"), amount.cast(RAO_SUM).alias("moved"))
    both: Column = F.array(step("timestamp_ms", F.col("balance_rao")), step("_until", -F.col("balance_rao")))
    return spans.select(*keys, F.explode(both).alias("_s")).select(*keys, "_s.timestamp_ms", "_s.moved").where("timestamp_ms is not null")
