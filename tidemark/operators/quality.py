"""Gaps, coverage, segments, duplicates and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import month_key


def gaps(series: DataFrame, interval_ms: int, *keys: str, ts: str = "timestamp_ms") -> DataFrame:
    """(keys, gap_start_ms, gap_end_ms, missing): stretches without a bucket between two that are there."""
    order = Window.partitionBy(*keys).orderBy(ts)
    step = series.select(*keys, ts).distinct().withColumn("_before", F.lag(ts).over(order)).withColumn("_delta", F.col(ts) - F.col("_before"))
    missing = F.round(F.col("_delta") / interval_ms).cast("long") - 1
    return step.where(F.col("_delta") > interval_ms).select(*keys, (F.col("_before") + interval_ms).alias("gap_start_ms"), (F.col(ts) - interval_ms).alias("gap_end_ms"), missing.alias("missing"))


def gap_log(series: DataFrame, venues: DataFrame, interval_ms: int, run_at_ms: int) -> DataFrame:
    """Rows for the ingestion log: every gap of every venue, or one clean row where there is none."""
    rows = series.groupBy("exchange", "pair").agg(F.count("*").alias("rows_fetched"))
    found = gaps(series, interval_ms, "exchange", "pair")
    return venues.join(rows, ["exchange", "pair"], "left").join(found, ["exchange", "pair"], "left").select(
        "exchange", "pair", F.lit(run_at_ms).cast("long").alias("run_at_ms"), F.coalesce("rows_fetched", F.lit(0)).cast("long").alias("rows_fetched"),
        "gap_start_ms", "gap_end_ms", F.coalesce("missing", F.lit(0)).cast("long").alias("missing_buckets"),
    )


def coverage(candles: DataFrame, venues: DataFrame, found_gaps: DataFrame) -> DataFrame:
    """First and last bucket, rows, months and gaps of every listed venue; status NO DATA where there is none."""
    rows = candles.groupBy("exchange", "pair").agg(
        F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"), F.count("*").alias("rows"), F.countDistinct(month_key("timestamp_ms")).alias("months")
    )
    totals = found_gaps.groupBy("exchange", "pair").agg(F.count("*").alias("gaps"), F.sum("missing").alias("missing"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return venues.join(rows, ["exchange", "pair"], "left").join(totals, ["exchange", "pair"], "left").select(
        "exchange", "pair", "first_ms", "last_ms", zero("rows"), zero("months"), zero("gaps"), zero("missing"),
        F.when(F.col("rows").isNull(), "NO DATA").otherwise("OK").alias("status"),
    )


def largest_gaps(found: DataFrame, n: int = 10) -> DataFrame:
    """The n largest gaps; equal ones by their columns."""
    return found.orderBy(F.col("missing").desc(), *[c for c in found.columns if c != "missing"]).limit(n)


def segments(rows: DataFrame, position: str, value: str) -> DataFrame:
    """(from_block, to_block, value): stretches of positions with the same value.

    Values that only ever go up, like versions, need no sort of all rows: each value's first and last position make its
    stretch. Whether they do is part of the result of `decode_plan`.
    """
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(position).alias("from_block"), F.max(position).alias("to_block")).select("from_block", "to_block", value)


def islands(rows: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """Stretches of equal values in each series, for values that may come back."""
    order = Window.partitionBy(*keys).orderBy(position)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(order)) | (F.row_number().over(order) == 1)).cast("int")
    numbered = rows.withColumn("_new", changed).withColumn("_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_n", value).agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("rows")).drop("_n")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def conservation(transfers: DataFrame) -> DataFrame:
    """One row: the sum of all transfer legs, which is zero."""
    amount = F.col("amount_rao").cast("decimal(38,0)")
    return transfers.agg(F.sum(F.when(F.col("from_coldkey").isNotNull(), -amount)).alias("out_rao"), F.sum(F.when(F.col("to_coldkey").isNotNull(), amount)).alias("in_rao")).select(
        "out_rao", "in_rao", (F.col("out_rao") + F.col("in_rao")).alias("net_rao")
    )


def violations(df: DataFrame, **checks) -> DataFrame:
    """(check, violations): how many rows break each of the named conditions (SQL text), counted in one pass; null breaks it."""
    counted = df.agg(*[F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in checks.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return counted.selectExpr(f"stack({len(checks)}, {pairs}) as (check, violations)")


def unique_violations(df: DataFrame, *keys: str) -> DataFrame:
    return duplicates(df, *keys)


def negative_balances(balances: DataFrame) -> DataFrame:
    """(coldkey, days, least_rao): accounts that the ledger has below zero, which are reported and not clamped."""
    return balances.where("balance_rao < 0").groupBy("coldkey").agg(F.count("*").alias("days"), F.min("balance_rao").alias("least_rao"))


def has_plain_address(df: DataFrame) -> bool:
    """No table may have a column `address`: accounts are coldkeys or hotkeys."""
    return "address" in df.columns


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, removed, added): keys whose rows differ between two tables, compared as multisets."""
    removed = before.exceptAll(after).groupBy(key).agg(F.count("*").alias("removed"))
    added = after.exceptAll(before).groupBy(key).agg(F.count("*").alias("added"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return removed.join(added, key, "full").select(key, zero("removed"), zero("added"))
