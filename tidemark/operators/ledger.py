"""Accounts: signed legs, end-of-day balances, holders, labelled totals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import DAY, day
from tidemark.sources.schemas import RAO, RAO_SUM

UPTO_HERE = (Window.unboundedPreceding, Window.currentRow)


def transfer_legs(transfers: DataFrame) -> DataFrame:
    """(coldkey, block_number, timestamp_ms, delta): both legs of each transfer from one scan; sums widen what they add up."""
    amount = F.col("amount_rao").cast(RAO)
    legs = F.array(F.struct(F.col("from_coldkey").alias("coldkey"), (-amount).alias("delta")), F.struct(F.col("to_coldkey").alias("coldkey"), amount.alias("delta")))
    return transfers.select("block_number", "timestamp_ms", F.explode(legs).alias("leg")).select("leg.coldkey", "block_number", "timestamp_ms", F.col("leg.delta").alias("delta"))


def event_legs(events: DataFrame) -> DataFrame:
    """Deposits add, all other kinds take away."""
    amount = F.col("amount_rao").cast(RAO)
    return events.select("coldkey", "block_number", "timestamp_ms", F.when(F.col("kind") == "deposit", amount).otherwise(-amount).alias("delta"))


def genesis_legs(snapshots: DataFrame) -> DataFrame:
    """Opening balances: dated snapshots of block 0 with something in them."""
    total = F.col("free_rao").cast(RAO) + F.col("reserved_rao").cast(RAO)
    return snapshots.where("block_number = 0 and timestamp_ms is not null").select("coldkey", "block_number", "timestamp_ms", total.alias("delta")).where("delta <> 0")


def signed_legs(transfers: DataFrame, events: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    legs = transfer_legs(transfers).unionByName(event_legs(events))
    return legs if snapshots is None else legs.unionByName(genesis_legs(snapshots))


def daily_deltas(legs: DataFrame) -> DataFrame:
    """One row per account and day: an account with most of all legs is down to its days before anything is shuffled."""
    return legs.groupBy("coldkey", day("timestamp_ms").alias("timestamp_ms")).agg(F.sum("delta").cast(RAO_SUM).alias("delta"))


def daily_balances(legs: DataFrame) -> DataFrame:
    """(coldkey, timestamp_ms, balance_rao): each account's balance at the end of each day on which it moved."""
    order = Window.partitionBy("coldkey").orderBy("timestamp_ms").rowsBetween(*UPTO_HERE)
    return daily_deltas(legs).select("coldkey", "timestamp_ms", F.sum("delta").over(order).cast(RAO_SUM).alias("balance_rao"))


def every_day(changes: DataFrame, value: str) -> DataFrame:
    """(timestamp_ms, value): the running sum of a table of daily changes, on every day from its first to its last one.

    One row per day with changes is all that the window sorts; the days up to the next such row are counted out.
    """
    days = Window.orderBy("timestamp_ms")
    upto = F.lead("timestamp_ms").over(days) - DAY
    summed = changes.select("timestamp_ms", F.sum(value).over(days.rowsBetween(*UPTO_HERE)).alias("value"), F.coalesce(upto, F.col("timestamp_ms")).cast("long").alias("_upto"))
    return summed.select(F.explode(F.sequence("timestamp_ms", "_upto", F.lit(DAY).cast("long"))).alias("timestamp_ms"), "value")


def holder_counts(balances: DataFrame, threshold: int | Decimal = 0) -> DataFrame:
    """(timestamp_ms, value): accounts above a threshold on every day, without an account-by-day table.

    Each account adds one on the day on which it rises above the threshold and takes one off when it falls. The daily
    sums of these crossings run over days only. Days before the first crossing are NULL.
    """
    order = Window.partitionBy("coldkey").orderBy("timestamp_ms")
    above = (F.col("balance_rao") > F.lit(threshold)).cast("int")
    crossings = balances.select("coldkey", "timestamp_ms", above.alias("above")).withColumn("crossing", F.col("above") - F.lag("above", 1, 0).over(order))
    net = F.sum(F.when(F.col("crossing") != 0, F.col("crossing"))).cast("long")
    return every_day(crossings.groupBy("timestamp_ms").agg(net.alias("net")), "net")


def labelled_totals(balances: DataFrame, labels: DataFrame, scale: float = 1e9) -> DataFrame:
    """(timestamp_ms, value): what the labelled accounts hold together on every day, each balance carried forward.

    A balance that stays is no change of the total, so what accounts gained or lost is summed up day by day and the sums
    run over days only. Labels are a maintained list, whose broadcast Spark's own threshold guards.
    """
    held = balances.join(labels.select("coldkey").distinct(), "coldkey")
    before = F.lag("balance_rao").over(Window.partitionBy("coldkey").orderBy("timestamp_ms"))
    moved = held.select("timestamp_ms", (F.col("balance_rao") - F.coalesce(before, F.lit(0).cast(RAO_SUM))).cast(RAO_SUM).alias("moved"))
    changes = moved.groupBy("timestamp_ms").agg(F.sum("moved").cast(RAO_SUM).alias("moved"))
    return every_day(changes, "moved").select("timestamp_ms", (F.col("value").cast("double") / scale).alias("value"))


def user_transfers(transfers: DataFrame, protocol: DataFrame) -> DataFrame:
    """Transfers with no protocol account on either side; a null leg is excluded where the list is not empty, as NOT IN has it.

    Both anti joins carry the condition that NOT IN has for nulls. The list is a short dimension; Spark broadcasts it
    below its own threshold.
    """
    query = "SELECT * FROM {transfers} WHERE from_coldkey NOT IN (SELECT coldkey FROM {protocol}) AND to_coldkey NOT IN (SELECT coldkey FROM {protocol})"
    return transfers.sparkSession.sql(query, transfers=transfers, protocol=protocol.select("coldkey").where("coldkey is not null"))


def protocol_transfers(transfers: DataFrame, protocol: DataFrame) -> DataFrame:
    """Transfers with a protocol account on one side at least."""
    query = "SELECT * FROM {transfers} WHERE from_coldkey IN (SELECT coldkey FROM {protocol}) OR to_coldkey IN (SELECT coldkey FROM {protocol})"
    return transfers.sparkSession.sql(query, transfers=transfers, protocol=protocol.select("coldkey").where("coldkey is not null"))


def daily_count(df: DataFrame, ts: str = "timestamp_ms") -> DataFrame:
    return df.groupBy(day(ts).alias("timestamp_ms")).agg(F.count("*").alias("value"))


def net_deltas(legs: DataFrame, first_block: int, last_block: int) -> DataFrame:
    """Each touched account's net change over a block range; accounts with a net of zero stay."""
    return legs.where(F.col("block_number").between(first_block, last_block)).groupBy("coldkey").agg(F.sum("delta").cast(RAO_SUM).alias("delta"))


def fold_balances(legs: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Final balance of every account, from opening balances and all legs; negative ones are not clamped."""
    every = legs.select("coldkey", "delta")
    if initial is not None:
        every = every.unionByName(initial.select("coldkey", F.col("balance_rao").cast(RAO_SUM).alias("delta")))
    return every.groupBy("coldkey").agg(F.sum("delta").cast(RAO_SUM).alias("balance_rao"))


def emptied_for_good(balances: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled accounts whose last balance is zero, and since when."""
    last = balances.groupBy("coldkey").agg(F.max_by("balance_rao", "timestamp_ms").alias("balance"), F.max("timestamp_ms").alias("since_ms"))
    return last.where("balance = 0").join(labels, "coldkey").select("coldkey", "exchange", "since_ms")


def staked_accounts(stake_events: DataFrame, owners: DataFrame) -> DataFrame:
    """(timestamp_ms, value): accounts with stake above zero on every day; owners maps hotkey to coldkey."""
    amount = F.col("amount_rao").cast(RAO)
    legs = stake_events.join(owners, "hotkey").select("coldkey", "timestamp_ms", F.when(F.col("kind") == "stakeAdded", amount).otherwise(-amount).cast(RAO_SUM).alias("delta"))
    return holder_counts(daily_balances(legs), 0)
