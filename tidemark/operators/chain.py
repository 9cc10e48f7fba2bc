"""Raw blocks to typed tables: decode plan, event normalisation, repair, snapshot dating."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.decode import account_balances
from tidemark.operators.quality import changed_keys
from tidemark.sources.schemas import RAO
from tidemark.sources.files import Files, beside
from tidemark.sources.tables import overwrite_partitions, read_partitions, write_if_changed

#: Event methods that change balances or stake; sections are compared in lower case, methods as they are.
BALANCE_KINDS = {"Deposit": "deposit", "Withdraw": "withdraw", "DustLost": "withdraw"}
STAKE_KINDS = {"StakeAdded": "stakeAdded", "StakeRemoved": "stakeRemoved"}
#: Blocks in a range in which facts and snapshots are sorted together.
RANGE = 100_000
#: Blocks whose times are small enough to be sent to every task.
FEW_BLOCKS = 1_000_000
#: Partitions that one thread moves in one after another, and how many threads do so.
MOVED, MOVERS = 64, 16


def canonical_blocks(stamps: DataFrame) -> DataFrame:
    """(block_number, spec_version, versions): the largest stamp of each block and how many it has."""
    return stamps.groupBy("block_number").agg(F.max("spec_version").alias("spec_version"), F.countDistinct("spec_version").alias("versions"))


def decode_plan(stamps: DataFrame) -> DataFrame:
    """(block_number, stamped, decode_spec, is_transition, is_conflict, goes_back) of the blocks that need care.

    The first block of a version decodes with the version before. A lag over all blocks would be one task; versions only
    go up, so each version's first and last block say the same, and one row per version is all that is sorted. Where a
    version ends after the next one began, the stamps go backwards: those rows have goes_back and must stop the job.
    """
    blocks = canonical_blocks(stamps)
    ranges = blocks.groupBy("spec_version").agg(F.min("block_number").alias("first"), F.max("block_number").alias("last"))
    order = Window.orderBy("spec_version")
    starts = ranges.select(
        F.col("first").alias("block_number"), F.lag("spec_version").over(order).alias("_previous"), F.coalesce(F.lag("last").over(order) > F.col("first"), F.lit(False)).alias("_back")
    )
    joined = blocks.join(starts, "block_number", "left")
    return joined.where("_previous is not null or versions > 1").select(
        "block_number", F.col("spec_version").alias("stamped"), F.coalesce("_previous", "spec_version").alias("decode_spec"),
        F.col("_previous").isNotNull().alias("is_transition"), (F.col("versions") > 1).alias("is_conflict"), F.coalesce("_back", F.lit(False)).alias("goes_back"),
    )


def checked_plan(stamps: DataFrame) -> DataFrame:
    """The decode plan; stamps that go backwards stop the job before anything is decoded."""
    plan = decode_plan(stamps)
    back = plan.where("goes_back").select("block_number").first()
    if back is not None:
        raise ValueError(f"the version stamps go backwards at block {back['block_number']}")
    return plan


def with_decode_spec(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """blocks with decode_spec: the plan's where it has one, else the stamp."""
    named = plan.select("block_number", F.col("decode_spec").alias("_spec"))
    return blocks.join(named, "block_number", "left").withColumn("decode_spec", F.coalesce("_spec", "spec_version")).drop("_spec")


def missing_specs(blocks: DataFrame, metadata: DataFrame) -> DataFrame:
    """Blocks whose decode_spec has no metadata; must be empty."""
    return blocks.join(metadata.select(F.col("spec_version").alias("decode_spec")).distinct(), "decode_spec", "left_anti")


def with_metadata(blocks: DataFrame, plan: DataFrame, metadata: DataFrame) -> DataFrame:
    """blocks with decode_spec and the metadata to decode them by; blocks without any stop the job before it decodes.

    metadata: (spec_version, metadata_hex, captured_at_block), of which each version's earliest capture is taken.
    """
    chosen = with_decode_spec(blocks, plan)
    missing = missing_specs(chosen, metadata).groupBy("decode_spec").agg(F.min("block_number").alias("first")).orderBy("decode_spec").first()
    if missing is not None:
        raise ValueError(f"no metadata for version {missing['decode_spec']}, which block {missing['first']} needs")
    by_spec = metadata.groupBy(F.col("spec_version").alias("decode_spec")).agg(F.min_by("metadata_hex", F.struct("captured_at_block", "metadata_hex")).alias("metadata_hex"))
    return chosen.join(by_spec, "decode_spec")


def event_rows(blocks: DataFrame) -> DataFrame:
    """One row per event of decoded blocks; event_index counts all of a block's events, wanted or not."""
    return blocks.select("block_number", "timestamp_ms", F.posexplode("events").alias("event_index", "e")).select(
        "block_number", "timestamp_ms", "event_index", F.lower("e.section").alias("section"), F.col("e.method").alias("method"), F.col("e.data").alias("data")
    )


def _amount(k: int):
    return F.get("data", F.lit(k)).cast(RAO).alias("amount_rao")


def transfers_of(events: DataFrame) -> DataFrame:
    return events.where("section = 'balances' and method = 'Transfer'").select(
        "block_number", "event_index", "timestamp_ms", F.get("data", F.lit(0)).alias("from_coldkey"), F.get("data", F.lit(1)).alias("to_coldkey"), _amount(2)
    )


def balance_events_of(events: DataFrame) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for p in BALANCE_KINDS.items() for x in p])[F.col("method")]
    return events.where(F.col("section") == "balances").where(F.col("method").isin(*BALANCE_KINDS)).select(
        "block_number", "event_index", "timestamp_ms", kind.alias("kind"), F.get("data", F.lit(0)).alias("coldkey"), _amount(1)
    )


def stake_events_of(events: DataFrame) -> DataFrame:
    """Only events of the two-field shape (hotkey, amount)."""
    kind = F.create_map(*[F.lit(x) for p in STAKE_KINDS.items() for x in p])[F.col("method")]
    return events.where((F.col("section") == "subtensormodule") & F.col("method").isin(*STAKE_KINDS) & (F.size("data") == 2)).select(
        "block_number", "event_index", "timestamp_ms", kind.alias("kind"), F.get("data", F.lit(0)).alias("hotkey"), _amount(1)
    )


def chain_silver(decoded: DataFrame, metadata: DataFrame | None = None) -> dict[str, DataFrame]:
    """transfers, balance_events, stake_events and bad_blocks from decoded blocks.

    Of repeated rows of a block one is used. Blocks without an event list could not be decoded; they are set aside.
    metadata: what there is to decode by; given, the plan of the blocks' stamps is checked against it first, and a block
    without metadata, or stamps that go backwards, stop the job.
    """
    if metadata is not None:
        stamps = decoded.select("block_number", "spec_version")
        decoded = with_metadata(decoded, checked_plan(stamps), metadata).drop("metadata_hex")
    one = decoded.dropDuplicates(["block_number"])
    events = event_rows(one.where(F.col("events").isNotNull()))
    return {"transfers": transfers_of(events), "balance_events": balance_events_of(events), "stake_events": stake_events_of(events), "bad_blocks": one.where(F.col("events").isNull()).select("block_number")}


def repair(silver: DataFrame, rebuilt: DataFrame, bad_blocks: DataFrame, path: str, by: str = "part") -> DataFrame:
    """Replace the partitions of rebuilt rows, all or nothing; returns the blocks whose rows changed.

    silver and rebuilt: the old and the new rows of the partitions in question; a partition of silver that rebuilt has no
    rows of goes. If any block could not be decoded, nothing is written and an error is raised.
    """
    if not bad_blocks.isEmpty():
        raise ValueError("some blocks can't be decoded; nothing is replaced")
    spark = rebuilt.sparkSession
    finish_swaps(spark, path)
    noted, staged = beside(path, "changed"), beside(path, "staged")
    found = changed_keys(silver, rebuilt, "block_number")
    found.write.parquet(noted)
    overwrite_partitions(rebuilt, staged, by)
    _swap(spark, path, staged, [str(r[0]) for r in silver.select(by).union(rebuilt.select(by)).distinct().collect()], by)
    return spark.read.schema(found.schema).parquet(noted)


def repair_blocks(path: str, silver: str, plan: DataFrame, decoded: DataFrame, rows_of, size: int, by: str = "part") -> DataFrame:
    """Decode again the blocks that a plan names and replace their rows; (block_number, removed, added) of those that changed.

    path: a table with the schema `silver`, in partitions of `size` blocks named by `by` = block_number div size; rows_of
    makes its rows from event_rows. Only the partitions that hold named blocks are read and written (their numbers, one
    for each such folder, pass through the driver); the others' files stay. Every named block must be there and decode,
    or nothing is written. The new partitions are staged, noted in a marker file and then moved in by some threads: a run that
    is stopped between these steps is finished by the next one, and a reader meanwhile can miss a partition but never
    sees half of one. Partitions that end up empty go.
    """
    spark = plan.sparkSession
    finish_swaps(spark, path)
    part = F.floor(F.col("block_number") / size).cast("long")
    noted, staged = beside(path, "changed"), beside(path, "staged")
    asked, found_again, made = beside(path, "asked"), beside(path, "again"), beside(path, "rebuilt")
    try:
        # The plan and the blocks it names are written, as they are used several times: both come from all blocks.
        plan.select(F.col("block_number").cast("long")).distinct().write.parquet(asked)
        named = spark.read.schema("block_number long").parquet(asked)
        decoded.join(named, "block_number", "left_semi").dropDuplicates(["block_number"]).write.parquet(found_again)
        again = spark.read.schema(decoded.schema).parquet(found_again)
        lost = named.join(again.where(F.col("events").isNotNull()), "block_number", "left_anti").orderBy("block_number").first()
        if lost is not None:
            raise ValueError(f"block {lost['block_number']} can't be decoded; nothing is replaced")
        parts = [r[0] for r in named.select(part).distinct().collect()]
        old = read_partitions(spark, path, f"{silver}, {by} long").where(F.col(by).isin(parts))
        rows_of(event_rows(again)).withColumn(by, part).select(*old.columns).write.parquet(made)
        rebuilt = spark.read.schema(old.schema).parquet(made)
        found = changed_keys(old.join(named, "block_number", "left_semi"), rebuilt, "block_number")
        found.write.parquet(noted)
        overwrite_partitions(old.join(named, "block_number", "left_anti").unionByName(rebuilt), staged, by, order=["block_number", "event_index"])
        _swap(spark, path, staged, [str(x) for x in parts], by)
    finally:
        for folder in (asked, found_again, made):
            Files(spark, folder).delete(folder)
    return spark.read.schema(found.schema).parquet(noted)


def _swap(spark: SparkSession, path: str, staged: str, parts: list[str], by: str) -> None:
    files = Files(spark, path)
    filled = set(files.names(staged))
    names = [f"{by}={p}" for p in parts]
    files.write_json(f"{beside(path, 'swap')}", {"staged": staged, "filled": [n for n in names if n in filled], "emptied": [n for n in names if n not in filled]})
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> int:
    """Move in what a marker beside the table names, as often as it takes; the number of markers that were found."""
    files, path = Files(spark, path), path.rstrip("/")
    folder, name = path.rsplit("/", 1)

    def move_in(staged: str, parts: list[str]) -> None:
        for part in parts:
            if files.exists(f"{staged}/{part}"):  # else it was moved before
                files.delete(f"{path}/{part}")
                files.move(f"{staged}/{part}", f"{path}/{part}")

    markers = [f"{folder}/{n}" for n in files.names(folder) if n.startswith(f"{name}.swap-") and n.count(".") == name.count(".") + 1]
    for marker in markers:
        swap = files.read_json(marker)
        with ThreadPoolExecutor(MOVERS) as movers:
            list(movers.map(lambda parts: move_in(swap["staged"], parts), [swap["filled"][k : k + MOVED] for k in range(0, len(swap["filled"]), MOVED)]))
        for part in swap["emptied"]:
            files.delete(f"{path}/{part}")
        files.delete(swap["staged"])
        files.delete(marker)
    return len(markers)


def date_snapshots(snapshots: DataFrame, *facts: DataFrame) -> DataFrame:
    """snapshots with timestamp_ms: the time of the first fact after their block, NULL if there is none."""
    return snapshots.drop("timestamp_ms").join(block_dates(snapshots, *facts), "block_number", "left")


def block_dates(blocks: DataFrame, *facts: DataFrame) -> DataFrame:
    """(block_number, timestamp_ms) of distinct blocks: the time of the first fact after each, NULL if there is none.

    Each block's earliest time is reduced first. Facts and snapshot blocks are then sorted together in ranges of blocks,
    from the last one back; what lies beyond a range is the least time of all later ranges, one row for each range.
    """
    times = facts[0].select("block_number", "timestamp_ms")
    for f in facts[1:]:
        times = times.unionByName(f.select("block_number", "timestamp_ms"))
    times = times.where("timestamp_ms is not null").groupBy("block_number").agg(F.min("timestamp_ms").alias("_ms"))
    of_range = F.floor(F.col("block_number") / RANGE).alias("_range")
    blocks = blocks.select("block_number", F.lit(None).cast("long").alias("_ms"), F.lit(True).alias("_asked")).distinct()
    both = times.select("block_number", "_ms", F.lit(False).alias("_asked")).unionByName(blocks).select("*", of_range)
    later = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = both.groupBy("_range").agg(F.min("_ms").alias("_least")).select("_range", F.min("_least").over(later).alias("_beyond"))
    inside = F.min(F.when(~F.col("_asked"), F.struct("_ms"))).over(Window.partitionBy("_range").orderBy(F.col("block_number").desc(), F.col("_asked").desc()).rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumn("_inside", inside["_ms"]).where("_asked").join(ranges, "_range").select("block_number", F.least("_inside", "_beyond").alias("timestamp_ms"))


SNAPSHOT = ("block_number", "timestamp_ms", "coldkey", "free_rao", "reserved_rao")


def decoded_snapshots(raw: DataFrame) -> DataFrame:
    """Account snapshots with their balances; records that come decoded (with free_rao) are taken as they are."""
    return (raw if "free_rao" in raw.columns else account_balances(raw)).select("block_number", "coldkey", "free_rao", "reserved_rao")


def snapshot_silver(raw: DataFrame, *facts: DataFrame) -> DataFrame:
    """Decoded and dated account snapshots."""
    return date_snapshots(decoded_snapshots(raw), *facts).select(*SNAPSHOT)


def materialise_snapshots(raw: DataFrame, path: str, *facts: DataFrame, blocks: DataFrame | None = None) -> bool:
    """Snapshot silver as a table that is written only if its rows change; tells whether it did.

    The blocks' times are found once and written beside the table, as its rows are made several times. blocks: the
    snapshots' blocks, if they are known; they are looked for in all of the snapshots otherwise. Times of fewer than
    FEW_BLOCKS of them go to where the snapshots are, so that these are not shuffled.
    """
    dates = beside(path, "dates")
    decoded = decoded_snapshots(raw)
    try:
        block_dates(decoded if blocks is None else blocks, *facts).write.parquet(dates)
        dated = raw.sparkSession.read.schema("block_number long, timestamp_ms long").parquet(dates)
        dated = F.broadcast(dated) if dated.count() < FEW_BLOCKS else dated
        return write_if_changed(decoded.join(dated, "block_number", "left").select(*SNAPSHOT), "account_snapshots", path)
    finally:
        Files(raw.sparkSession, dates).delete(dates)
