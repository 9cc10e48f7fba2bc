"""Replayed balances against observed ones, and what observing would cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import window_index
from tidemark.operators.ledger import net_deltas
from tidemark.sources.schemas import RAO_SUM
from tidemark.sources.tables import append, read_table_or_empty


def _zero():
    return F.lit(0).cast(RAO_SUM)


def reconcile_window(legs: DataFrame, first_block: int, last_block: int, known: DataFrame, fresh: DataFrame, observed: DataFrame) -> DataFrame:
    """(coldkey, baseline, delta, expected, observed, matches) of every account touched in a block range.

    The baseline is the known balance, else the one freshly observed before the range, else zero.
    """
    named = lambda df, name: df.select("coldkey", F.col("balance_rao").cast(RAO_SUM).alias(name))
    base = F.coalesce("known", "fresh", _zero())
    rows = net_deltas(legs, first_block, last_block).join(named(known, "known"), "coldkey", "left").join(named(fresh, "fresh"), "coldkey", "left").join(named(observed, "observed"), "coldkey", "left")
    expected = (base + F.col("delta")).cast(RAO_SUM)
    return rows.select("coldkey", base.alias("baseline"), "delta", expected.alias("expected"), F.coalesce("observed", _zero()).alias("observed"), (expected == F.coalesce("observed", _zero())).alias("matches"))


def carried(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Known balances after a window: what was observed replaces what was known."""
    new = rows.select("coldkey", F.col("observed").alias("balance_rao"))
    return known.select("coldkey", F.col("balance_rao").cast(RAO_SUM).alias("balance_rao")).join(new, "coldkey", "left_anti").unionByName(new)


def reconcile_checkpoints(legs: DataFrame, observed: DataFrame, first_block: int, last_block: int, interval: int, initial: DataFrame | None = None) -> DataFrame:
    """(window_index, coldkey, baseline, delta, expected, observed, matches) over all whole windows at once.

    observed: (window_index, coldkey, balance_rao) at the window ends. An account's baseline is what was observed at the
    end of its previous touched window, so a mismatch doesn't cascade; its first baseline is in initial (coldkey,
    balance_rao), else zero. A partial last window is skipped.
    """
    windows = (last_block - first_block + 1) // interval
    touched = (
        legs.where(F.col("block_number").between(first_block, first_block + windows * interval - 1))
        .withColumn("window_index", window_index("block_number", first_block, interval))
        .groupBy("coldkey", "window_index").agg(F.sum("delta").cast(RAO_SUM).alias("delta"))
    )
    rows = touched.join(observed.select("coldkey", "window_index", F.col("balance_rao").cast(RAO_SUM).alias("observed")), ["coldkey", "window_index"], "left")
    rows = rows.withColumn("observed", F.coalesce("observed", _zero()))
    order = Window.partitionBy("coldkey").orderBy("window_index")
    first = None if initial is None else initial.select("coldkey", F.col("balance_rao").cast(RAO_SUM).alias("_initial"))
    rows = rows.withColumn("_initial", _zero()) if first is None else rows.join(first, "coldkey", "left")
    base = F.coalesce(F.lag("observed").over(order), F.col("_initial"), _zero())
    rows = rows.withColumn("baseline", base).withColumn("expected", (F.col("baseline") + F.col("delta")).cast(RAO_SUM))
    return rows.select("window_index", "coldkey", "baseline", "delta", "expected", "observed", (F.col("expected") == F.col("observed")).alias("matches"))


def reconcile_resumed(legs: DataFrame, observed: DataFrame, first_block: int, last_block: int, interval: int, folder: str) -> DataFrame:
    """reconcile_checkpoints' rows up to last_block, of which only windows that no earlier run has done are worked on.

    folder keeps, for each pair of first_block and interval, the rows of the windows done, what was last observed of each
    account, and a log of finished runs, which is written last: a run that was stopped is done again, and a run over
    other windows never goes on from these. last_block may grow from run to run; whole windows only are done. Legs and
    observations of windows done are not looked at, so they need not be there any more.
    """
    if interval <= 0:
        raise ValueError(f"the interval must be positive, not {interval}")
    spark, base = legs.sparkSession, f"{folder.rstrip('/')}/{first_block}-{interval}"
    runs = "from_window long, upto_window long, touched long, mismatches long"
    known = f"coldkey string, balance_rao {RAO_SUM}"
    finished = read_table_or_empty(spark, f"{base}/runs", runs).orderBy("from_window").collect()
    done, windows = max((r["upto_window"] for r in finished), default=0), (last_block - first_block + 1) // interval
    if windows > done:
        carry = spark.read.schema(known).parquet(f"{base}/carry/upto={done}") if done else None
        later = observed.where(F.col("window_index") >= done).withColumn("window_index", F.col("window_index") - done)
        rows = reconcile_checkpoints(legs, later, first_block + done * interval, last_block, interval, carry).withColumn("window_index", F.col("window_index") + done)
        rows.write.mode("overwrite").parquet(f"{base}/rows/from={done}")
        new = spark.read.schema(rows.schema).parquet(f"{base}/rows/from={done}")
        latest = new.groupBy("coldkey").agg(F.max_by("observed", "window_index").alias("observed"))
        carried(spark.createDataFrame([], known) if carry is None else carry, latest).write.mode("overwrite").parquet(f"{base}/carry/upto={windows}")
        counts = new.agg(F.count("*"), F.count_if(~F.col("matches"))).first()
        append(spark.createDataFrame([(done, windows, counts[0], counts[1])], runs), f"{base}/runs")
        finished = [*finished, {"from_window": done}]
    columns = f"window_index long, coldkey string, baseline {RAO_SUM}, delta {RAO_SUM}, expected {RAO_SUM}, observed {RAO_SUM}, matches boolean"
    # Folders that no finished run names are not read.
    return spark.read.schema(columns).parquet(*[f"{base}/rows/from={r['from_window']}" for r in finished]) if finished else spark.createDataFrame([], columns)


def checkpoint_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_index").agg(F.count("*").alias("touched"), F.count_if(~F.col("matches")).alias("mismatches"))


def reconciliation_sizing(touches: DataFrame, first_block: int, last_block: int, interval: int, per_window: int = 3) -> DataFrame:
    """(window_index, touched, new, calls) of every window, touched or not: an observation for each touched account, one more for each new one, and `per_window`."""
    keyed = touches.where(F.col("block_number").between(first_block, last_block)).select("coldkey", window_index("block_number", first_block, interval).alias("window_index")).distinct()
    per = keyed.groupBy("window_index").agg(F.count("*").alias("touched"))
    new = keyed.groupBy("coldkey").agg(F.min("window_index").alias("window_index")).groupBy("window_index").agg(F.count("*").alias("new"))
    last = (last_block - first_block) // interval
    spine = touches.sparkSession.range(0, last + 1).select(F.col("id").alias("window_index"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return spine.join(per, "window_index", "left").join(new, "window_index", "left").select("window_index", zero("touched").alias("touched"), zero("new").alias("new"), (zero("touched") + zero("new") + per_window).cast("long").alias("calls"))


def sizing_total(sizing: DataFrame) -> DataFrame:
    """(windows, touched, new, calls) over all windows."""
    return sizing.agg(F.count("*").alias("windows"), *[F.sum(c).alias(c) for c in ("touched", "new", "calls")])


def account_touches(transfers: DataFrame, events: DataFrame) -> DataFrame:
    """(coldkey, block_number): both legs of transfers and all balance events."""
    legs = transfers.select("block_number", F.explode(F.array("from_coldkey", "to_coldkey")).alias("coldkey"))
    return legs.unionByName(events.select("block_number", "coldkey"))
