"""What goes on where it stopped: reconciliation, sharded metrics, repairs; and sources, counts and files of materialised tables."""

import random
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chain, ledger, reconcile
from tidemark.plans import registry
from tidemark.plans.registry import Metric
from tidemark.sources import tables
from tidemark.sources.files import Files
from tidemark.sources.schemas import SCHEMAS
from tidemark.streaming import streams

LEGS = "coldkey string, block_number long, delta decimal(38,0)"
SEEN = "window_index long, coldkey string, balance_rao decimal(38,0)"
HOUR = 3_600_000


def rows_of(df):
    return sorted(map(tuple, df.select("window_index", "coldkey", "baseline", "delta", "expected", "observed", "matches").collect()))


def ledger_and_observations(spark):
    draw = random.Random(4)
    legs = [(draw.choice("abcd"), draw.randint(1, 1000), Decimal(draw.randint(-9, 20))) for _ in range(300)]
    seen, held = [], {}
    for window in range(10):
        for k, block, delta in legs:
            if (block - 1) // 100 == window:
                held[k] = held.get(k, 0) + int(delta)
        seen += [(window, k, Decimal(v + (window % 4 == 1))) for k, v in held.items()]
    return spark.createDataFrame(legs, LEGS), spark.createDataFrame(seen, SEEN)


def test_resumed_reconciliation_equals_one_pass(spark, tmp_path):
    legs, seen = ledger_and_observations(spark)
    once = rows_of(reconcile.reconcile_checkpoints(legs, seen, 1, 1000, 100))
    for upto in (50, 250, 299, 300, 1000, 1000):
        # What belongs to windows that are done is gone by then.
        done = {250: 0, 299: 2, 300: 2, 1000: 3}.get(upto, 0)
        found = reconcile.reconcile_resumed(legs.where(F.col("block_number") > done * 100), seen.where(F.col("window_index") >= done), 1, upto, 100, str(tmp_path))
        assert rows_of(found) == [r for r in once if r[0] < upto // 100]
    assert any(not r[-1] for r in once)
    log = spark.read.parquet(f"{tmp_path}/1-100/runs").orderBy("from_window").collect()
    assert [(r.from_window, r.upto_window) for r in log] == [(0, 2), (2, 3), (3, 10)]
    assert sum(r.mismatches for r in log) == sum(not r[-1] for r in once)


def test_other_windows_do_not_resume_and_a_stopped_run_is_done_again(spark, tmp_path):
    legs, seen = ledger_and_observations(spark)
    first = rows_of(reconcile.reconcile_resumed(legs, seen, 1, 300, 100, str(tmp_path)))
    other = seen.where("window_index % 2 = 1").withColumn("window_index", F.floor(F.col("window_index") / 2))
    assert rows_of(reconcile.reconcile_resumed(legs, other, 1, 1000, 200, str(tmp_path))) == rows_of(reconcile.reconcile_checkpoints(legs, other, 1, 1000, 200))
    # A run that wrote rows but no log entry counts for nothing.
    spark.createDataFrame([(3, "z", *[Decimal(0)] * 4, True)], "window_index long, coldkey string, baseline decimal(38,0), delta decimal(38,0), expected decimal(38,0), observed decimal(38,0), matches boolean").write.parquet(f"{tmp_path}/1-100/rows/from=3")
    assert rows_of(reconcile.reconcile_resumed(legs, seen, 1, 300, 100, str(tmp_path))) == first
    assert rows_of(reconcile.reconcile_resumed(legs, seen, 1, 1000, 100, str(tmp_path))) == rows_of(reconcile.reconcile_checkpoints(legs, seen, 1, 1000, 100))
    with pytest.raises(ValueError, match="positive"):
        reconcile.reconcile_resumed(legs, seen, 1, 300, 0, str(tmp_path))


def test_the_definition_follows_what_a_metric_calls(monkeypatch):
    build = lambda v, p: ledger.daily_balances(ledger.signed_legs(v["t"], v["b"]))
    before = registry.definition(build)
    assert before == registry.definition(build)
    original = ledger.daily_deltas
    for name in ("daily_balances", "signed_legs", "event_legs", "daily_deltas"):  # called by build, or by what it calls
        with monkeypatch.context() as patch:
            patch.setattr(ledger, name, lambda *a: original(*a).limit(1))
            assert registry.definition(build) != before, name
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "UPTO_HERE", (0, 0))
        assert registry.definition(build) != before
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "every_day", lambda *a: None)  # not reached
        assert registry.definition(build) == before


def test_a_changed_callee_or_input_recomputes_every_bucket(spark, tmp_path, monkeypatch):
    legs = spark.createDataFrame([(f"a{i % 7}", i, (i % 5) * 86_400_000, Decimal(i)) for i in range(100)], "coldkey string, block_number long, timestamp_ms long, delta decimal(38,0)")
    m = Metric("balances", 1, "", build=lambda v, p: ledger.daily_balances(v["legs"]), shard_by="coldkey")
    total = lambda of: sum(r.balance_rao for r in registry.materialise_sharded(spark, m, {"legs": of}, str(tmp_path), 4).collect())
    noted = lambda: {r.fingerprint for r in spark.read.parquet(f"{tmp_path}/balances.manifest").collect()}
    first = total(legs)
    assert total(legs) == first and len(noted()) == 1
    original = ledger.daily_deltas
    monkeypatch.setattr(ledger, "daily_deltas", lambda legs: original(legs).withColumn("delta", F.col("delta") * 2))
    assert total(legs) == 2 * first and len(noted()) == 2
    # Rows that come in pairs cancel in an exclusive or, but count.
    pair = spark.createDataFrame([("a1", 1, 0, Decimal(0))] * 2, legs.schema)
    total(legs.union(pair))
    total(legs.union(pair.limit(0)).union(spark.createDataFrame([("a2", 1, 0, Decimal(0))] * 2, legs.schema)))
    assert len(noted()) == 4


def transfer(to, amount):
    return ("balances", "Transfer", ["a", to, str(amount)])


def silver(spark, tmp_path):
    decoded = [(b, b * 10, 1, [transfer("x", b), transfer("y", b)]) for b in range(40)]
    folder = str(tmp_path / "silver")
    rows = chain.transfers_of(chain.event_rows(spark.createDataFrame(decoded, SCHEMAS["decoded_events"])))
    tables.overwrite_partitions(rows.withColumn("part", F.floor(F.col("block_number") / 10).cast("long")), folder, "part", order=["block_number", "event_index"])
    return decoded, folder


def of_blocks(spark, folder):
    return sorted((r.block_number, r.to_coldkey, int(r.amount_rao), r.part) for r in spark.read.schema(SCHEMAS["transfers"] + ", part long").parquet(folder).collect())


def plan(spark, *blocks):
    return spark.createDataFrame([(b,) for b in blocks], "block_number long")


def test_repair_touches_named_parts_only_and_removes_empty_ones(spark, tmp_path):
    decoded, folder = silver(spark, tmp_path)
    before, files = of_blocks(spark, folder), {p: Files(spark, folder).names(f"{folder}/part={p}") for p in range(4)}
    again = [(b, ms, v, [transfer("z", 7)] if b == 12 else [] if 20 <= b < 30 else e) for b, ms, v, e in decoded]
    changed = chain.repair_blocks(folder, SCHEMAS["transfers"], plan(spark, 12, 13, *range(20, 30)), spark.createDataFrame(again, SCHEMAS["decoded_events"]), chain.transfers_of, 10)
    assert sorted((r.block_number, r.removed, r.added) for r in changed.collect()) == [(12, 2, 1), *((b, 2, 0) for b in range(20, 30))]
    assert of_blocks(spark, folder) == sorted([r for r in before if r[0] != 12 and r[3] != 2] + [(12, "z", 7, 1)])
    now = {p: Files(spark, folder).names(f"{folder}/part={p}") for p in range(4)}
    assert now[0] == files[0] and now[3] == files[3] and now[1] != files[1] and now[2] == []
    assert not [n for n in Files(spark, folder).names(str(tmp_path)) if "swap" in n or "staged" in n or "rebuilt" in n]


@pytest.mark.parametrize("fault", ["undecodable", "missing"])
def test_a_block_that_does_not_decode_leaves_everything_as_it_was(spark, tmp_path, fault):
    decoded, folder = silver(spark, tmp_path)
    before, files = of_blocks(spark, folder), Files(spark, folder).names(f"{folder}/part=1")
    again = [(b, ms, v, None if b == 13 else e) for b, ms, v, e in decoded if b != 13 or fault == "undecodable"]
    with pytest.raises(ValueError, match="block 13"):
        chain.repair_blocks(folder, SCHEMAS["transfers"], plan(spark, 12, 13), spark.createDataFrame(again, SCHEMAS["decoded_events"]), chain.transfers_of, 10)
    assert of_blocks(spark, folder) == before and Files(spark, folder).names(f"{folder}/part=1") == files


def test_a_repair_that_was_stopped_while_it_moved_parts_is_finished(spark, tmp_path, monkeypatch):
    decoded, folder = silver(spark, tmp_path)
    again = spark.createDataFrame([(b, ms, v, [transfer("z", b)]) for b, ms, v, e in decoded], SCHEMAS["decoded_events"])
    moves, move = [], Files.move

    def failing(self, source, target):
        if "part=" in target:
            moves.append(target)
            if len(moves) == 2:
                raise OSError("stopped")
        move(self, source, target)

    monkeypatch.setattr(Files, "move", failing)
    with pytest.raises(OSError, match="stopped"):
        chain.repair_blocks(folder, SCHEMAS["transfers"], plan(spark, 1, 11, 21), again, chain.transfers_of, 10)
    assert chain.finish_swaps(spark, folder) == 1 and chain.finish_swaps(spark, folder) == 0
    repaired = {b: to for b, to, _, _ in of_blocks(spark, folder)}
    assert [b for b, to in repaired.items() if to == "z"] == [1, 11, 21] and len(repaired) == 40


def test_a_repair_computes_the_plan_and_the_blocks_once(spark, tmp_path):
    decoded, folder = silver(spark, tmp_path)
    seen = {"plan": spark.sparkContext.accumulator(0), "decoded": spark.sparkContext.accumulator(0)}

    def counted(df, name):
        added = seen[name]

        def count(block):
            added.add(1)
            return True

        return df.where(F.udf(count, "boolean")("block_number"))

    again = spark.createDataFrame([(b, ms, v, [transfer("z", b)]) for b, ms, v, e in decoded], SCHEMAS["decoded_events"])
    changed = chain.repair_blocks(folder, SCHEMAS["transfers"], counted(plan(spark, 1, 11, 21), "plan"), counted(again, "decoded"), chain.transfers_of, 10)
    assert sorted(r.block_number for r in changed.collect()) == [1, 11, 21]
    assert seen["plan"].value == 3 and seen["decoded"].value < 80  # 40 blocks, those of the plan perhaps again
    assert not [n for n in Files(spark, folder).names(str(tmp_path)) if "asked" in n or "again" in n]


def test_many_parts_are_listed_written_and_moved_by_several_tasks(spark, tmp_path, monkeypatch):
    context, folder = spark.sparkContext, str(tmp_path / "many")

    def tasks(group, run):
        context.setJobGroup(group, group)
        try:
            out = run()
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        status = context.statusTracker()
        return out, [status.getStageInfo(n).numTasks for j in status.getJobIdsForGroup(group) for n in status.getJobInfo(j).stageIds if status.getStageInfo(n)]

    rows = spark.range(2000).select(F.col("id").alias("block_number"), F.floor(F.col("id") / 20).cast("long").alias("part"))
    _, wrote = tasks("wrote", lambda: tables.overwrite_partitions(rows, folder, "part", order=["block_number"]))
    assert max(wrote[1:]) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # not one task for so few bytes
    before = spark.conf.get(tables.LISTING)
    found, listed = tasks("listed", lambda: tables.read_partitions(spark, folder, "block_number long, part long"))
    assert 0 < sum(listed) <= 4 * context.defaultParallelism < 100 and spark.conf.get(tables.LISTING) == before
    assert sorted(map(tuple, found.collect())) == [(k, k // 20) for k in range(2000)]
    staged, movers, move = f"{folder}.staged", set(), Files.move
    tables.overwrite_partitions(rows.withColumn("block_number", -F.col("block_number")), staged, "part")

    def noting(self, source, target):
        movers.add(threading.get_ident())
        move(self, source, target)

    monkeypatch.setattr(Files, "move", noting)
    chain._swap(spark, folder, staged, [str(k) for k in range(101)], "part")
    assert len(movers) > 1 and Files(spark, folder).names(str(tmp_path)) == ["many"]
    assert sorted(map(tuple, spark.read.schema("block_number long, part long").parquet(folder).collect())) == sorted((-k, k // 20) for k in range(2000))


def test_decoding_stops_without_metadata(spark):
    decoded = spark.createDataFrame([(1, 10, 1, [transfer("x", 1)]), (2, 20, 2, [transfer("x", 2)]), (3, 30, 2, [transfer("x", 3)])], SCHEMAS["decoded_events"])
    metadata = spark.createDataFrame([(1, "0x01", 5), (1, "0x00", 4)], SCHEMAS["chain_metadata"])
    with pytest.raises(ValueError, match="no metadata for version 2, which block 3 needs"):  # block 2 decodes by version 1
        chain.chain_silver(decoded, metadata)
    both = metadata.union(spark.createDataFrame([(2, "0x02", 9)], metadata.schema))
    assert chain.chain_silver(decoded, both)["transfers"].count() == 3
    blocks = decoded.select("block_number", "spec_version")
    found = chain.with_metadata(blocks, chain.checked_plan(blocks), both).orderBy("block_number").collect()
    assert [(r.block_number, r.decode_spec, r.metadata_hex) for r in found] == [(1, 1, "0x00"), (2, 1, "0x00"), (3, 2, "0x02")]


def test_sources_are_built_once_and_only_if_read(spark, tmp_path):
    built = []

    def source(name):
        def make():
            built.append(name)
            return spark.range(3)

        return make

    entries = [Metric("a", 1, "", sql="SELECT id FROM x", reads=("x",)), Metric("b", 1, "", build=lambda v, p: v["x"].union(v["a"]), reads=("x",), depends_on=("a",))]
    done = registry.materialise(spark, entries, {"x": source("x"), "y": source("y")}, str(tmp_path))
    assert built == ["x"] and done.rows == {"a": 3, "b": 6}
    assert sorted(map(tuple, registry.row_counts(done).collect())) == [("a", 3), ("b", 6)]
    with pytest.raises(ValueError, match="unknown source: z"):
        registry.materialise(spark, [Metric("c", 1, "", sql="SELECT 1", reads=("z",))], {}, str(tmp_path))


def test_partition_files_are_sorted(spark, tmp_path):
    rows = spark.range(0, 4000).select((F.col("id") * 7919 % 4000).alias("t"), (F.col("id") % 3).alias("p"))
    tables.overwrite_partitions(rows, f"{tmp_path}/a", "p", order=["t"])
    found = tables.out_of_order(spark.read.schema("t long, p long").parquet(f"{tmp_path}/a"), "t").collect()
    assert len(found) == 3 and sum(r.rows for r in found) == 4000 and not any(r.out_of_order for r in found)
    tables.overwrite_partitions(rows, f"{tmp_path}/b", "p")
    assert any(r.out_of_order for r in tables.out_of_order(spark.read.schema("t long, p long").parquet(f"{tmp_path}/b"), "t").collect())


def test_a_clock_reports_that_all_series_stopped(spark, tmp_path):
    land = lambda rows: spark.createDataFrame([(k, h * HOUR) for k, h in rows], "series string, timestamp_ms long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    tick = lambda h: spark.createDataFrame([(h * HOUR,)], "timestamp_ms long").write.mode("append").parquet(f"{tmp_path}/clock")

    def run():
        ticks, clock = streams.landed(spark, f"{tmp_path}/in", "series string, timestamp_ms long"), streams.landed(spark, f"{tmp_path}/clock", "timestamp_ms long")
        streams.run_available(streams.silence_alarms(ticks, HOUR, clock=clock), f"{tmp_path}/out", f"{tmp_path}/c")
        return sorted(map(tuple, spark.read.schema("series string, silent_from_ms long").parquet(f"{tmp_path}/out").collect()))

    land([("a", 10), ("b", 11)])
    tick(11)
    assert run() == []
    tick(13)  # the watermark is at 12: a's next tick was due at 11, b's is at 12
    assert run() == [("a", 11 * HOUR)]
    tick(19)
    assert run() == [("a", 11 * HOUR), ("b", 12 * HOUR)]
