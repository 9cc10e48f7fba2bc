"""Registry, sinks, streams, and some catalogue queries against their oracles."""

from __future__ import annotations

import json
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.functions.time_buckets import DAY, HOUR
from tidemark.operators import chain, ledger, quality
from tidemark.plans import catalog, metrics, registry
from tidemark.plans.registry import Metric
from tidemark.sources import tables
from tidemark.sources.schemas import SCHEMAS
from tidemark.streaming import streams

CANDLE = SCHEMAS["ohlcv_1m"]


def candle(t, close, volume, exchange="binance", pair="TAOUSDT"):
    return (exchange, pair, t, close, close, close, close, volume, close * volume, False)


def test_order_and_errors():
    a, b = Metric("a", 1, "", sql="select 1", depends_on=("b",)), Metric("b", 1, "", sql="select 1")
    assert [m.name for m in registry.ordered([a, b])] == ["b", "a"]
    with pytest.raises(ValueError, match="unknown"):
        registry.ordered([a])
    with pytest.raises(ValueError, match="each other"):
        registry.ordered([a, Metric("b", 1, "", sql="select 1", depends_on=("a",))])
    with pytest.raises(ValueError):
        Metric("x", 0, "", sql="select 1")
    with pytest.raises(ValueError):
        Metric("x", 1, "")
    assert len(metrics.metrics()) == 15 and len(registry.ordered(metrics.metrics())) == 15


def sources(spark):
    empty = {n: registry.empty(spark, n) for n in ("balance_events", "account_snapshots", "pallet_accounts", "google_trends")}
    candles = [candle(0, 500.0, 10.0), candle(MIN := 60_000, 510.0, 10.0), candle(0, 50_000.0, 1.0, pair="BTCUSDT"), candle(MIN, 51_000.0, 1.0, pair="BTCUSDT")]
    rows = [(1, 0, 0, "A", "B", Decimal(10)), (2, 0, DAY, "B", "C", Decimal(4)), (3, 0, DAY, "C", "A", Decimal(1))]
    labels = spark.createDataFrame([("B", "Kraken", "high", "2024-01-01", "")], SCHEMAS["exchange_labels"])
    return empty | {"ohlcv_1m": spark.createDataFrame(candles, CANDLE), "transfers": spark.createDataFrame(rows, SCHEMAS["transfers"]), "exchange_labels": labels}


def test_materialise_and_export(spark, tmp_path):
    entries = metrics.metrics()
    done = registry.materialise(spark, entries, sources(spark), str(tmp_path / "gold"))
    value = lambda n: [r.value for r in done[n].orderBy("timestamp_ms").collect()]
    assert value("price_composite_usd_daily") == [510.0] and value("price_composite_btc") == [0.01, 0.01]
    assert value("volume_usd_daily") == [10_100.0] and value("transfer_count_daily") == [1, 2]
    assert value("wallet_count_free_balance") == [1, 2] and value("exchange_balances_daily") == [1e-8, 6e-9]
    assert {(r.metric, r.version) for r in done["account_balances_daily"].collect()} == {("account_balances_daily", 3)}
    rows = registry.export(done, entries)
    registry.write_export(rows, str(tmp_path / "export"))
    (part,) = Path(tmp_path / "export").glob("part-*")
    data = json.loads(part.read_text())
    names = [s["metric"] for s in data["series"]]
    assert "price_composite_usd" not in names and len(names) == 11
    daily = next(s for s in data["series"] if s["metric"] == "price_composite_usd_daily")
    assert daily == {"metric": "price_composite_usd_daily", "version": 1, "points": [{"timestampMs": 0, "value": 510.0}]}


def test_points_of_a_series_of_any_length_are_exported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "MOST_POINTS", 5)
    entries = [Metric("long", 2, "", sql="SELECT id AS timestamp_ms, nullif(id, 3) AS value FROM range(40)"), Metric("none", 1, "", sql="SELECT id AS timestamp_ms, id AS value FROM range(0)")]
    done = registry.materialise(spark, entries, {}, str(tmp_path / "gold"))
    rows = sorted(map(tuple, registry.exported_points(done, entries).collect()))
    assert rows == [(0, "long", 2, k, 0.0 if k == 3 else float(k)) for k in range(40)]


def test_the_registered_export_has_no_bound_on_points(spark, monkeypatch):
    monkeypatch.setattr(registry, "MOST_POINTS", 5)
    assert catalog.registry_export(spark, "/root/testdata/sf0.001").where("metric = 'social_trends_weekly'").count() > 5


def test_a_large_bucket_is_cut_by_several_tasks(spark, tmp_path):
    legs = spark.range(0, 40_000, 1, 4).selectExpr("'a' AS coldkey", "id AS block_number", "id * 86400000 AS timestamp_ms", "CAST(id AS decimal(38,0)) AS delta")
    m = Metric("balances", 1, "", build=lambda v, p: ledger.daily_balances(v["legs"]), shard_by="coldkey")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "50k")
    try:
        found = registry.materialise_sharded(spark, m, {"legs": legs}, str(tmp_path), 2)
    finally:
        spark.conf.unset(size)
    assert found.count() == 40_000 and len(list(Path(tmp_path).glob("balances.shards/*/legs/_bucket=*/part-*"))) > 1


def test_same_rows_counts_repeats_and_is_exact(spark, monkeypatch):
    frame = lambda rows: spark.createDataFrame(rows, "a int, b double")
    rows = [(1, None), (1, None), (2, float("nan")), (None, 0.0)]
    assert tables.same_rows(frame(rows), frame(rows[::-1])) and tables.same_rows(frame([]), frame([]))
    assert tables.same_rows(frame([(1, 0.0)]), frame([(1, -0.0)]))
    assert not tables.same_rows(frame(rows), frame(rows[1:])) and not tables.same_rows(frame(rows), frame([rows[0], *rows[2:], rows[2]]))
    assert not tables.same_rows(frame(rows), frame([])) and not tables.same_rows(frame([]), frame(rows))
    # Digests that agree are no proof: the rows themselves decide.
    monkeypatch.setattr(tables.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    assert tables.same_rows(frame(rows), frame(rows[::-1])) and not tables.same_rows(frame(rows), frame([(9, None), *rows[1:]]))


def test_same_rows_compares_wide_decimals_without_making_them_objects(spark, monkeypatch):
    schema = "a decimal(20,0), b string, c decimal(38,0), d decimal(38,2)"
    frame = lambda *values: spark.createDataFrame([(Decimal(x) if x is not None else None, "x", Decimal(y), Decimal("1.25")) for x, y in values], schema)
    long, beyond = 2**63 - 1, 2**63
    rows = [(1, 5), (1, 5), (None, 5), (long, -long - 1), (beyond, beyond), (-beyond - 1, 10**37)]
    for digest in (None, 7):  # digests that differ, and digests that tell nothing
        if digest is not None:
            monkeypatch.setattr(tables.F, "xxhash64", lambda *columns: F.lit(digest).cast("long"))
        assert tables.same_rows(frame(*rows), frame(*rows[::-1]))
        for k, other in ((0, (2, 5)), (2, (0, 5)), (3, (long - 1, -long - 1)), (4, (beyond + 1, beyond)), (4, (beyond, beyond + 1)), (4, (None, beyond)), (5, (-beyond - 2, 10**37)), (1, rows[2])):
            assert not tables.same_rows(frame(*rows), frame(*rows[:k], other, *rows[k + 1 :])), (digest, k, other)
    kinds = [f.dataType.simpleString() for f in frame(*rows).select(*tables.plain_columns(frame(*rows))).schema.fields]
    assert kinds == ["string", "bigint", "string", "string", "bigint", "decimal(38,2)"]


def test_snapshots_are_dated_where_they_are(spark, tmp_path, monkeypatch):
    """Times of blocks are found once for all passes over the snapshots, which are not shuffled by block."""
    facts = spark.createDataFrame([(1, 100), (10, 150), (12, 200), (50, 190)], "block_number long, timestamp_ms long")
    records = spark.createDataFrame([(b, f"C{k}", "0x" + "00" * 16 + f"{k:02x}" + "00" * 15) for b in (0, 10, 99) for k in range(3)], "block_number long, coldkey string, account_info_hex string")
    plans, asked, write, dates = [], [], chain.write_if_changed, chain.block_dates
    monkeypatch.setattr(chain, "write_if_changed", lambda df, *rest: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *rest))[1])
    monkeypatch.setattr(chain, "block_dates", lambda *tables_: (asked.append(1), dates(*tables_))[1])
    want = sorted(tuple(r) for r in chain.snapshot_silver(records, facts).collect())
    asked.clear()
    for blocks in (None, records.select("block_number").distinct()):
        path = str(tmp_path / f"silver{blocks is None}")
        assert chain.materialise_snapshots(records, path, facts, blocks=blocks) and not chain.materialise_snapshots(records, path, facts, blocks=blocks)
        assert sorted(tuple(r) for r in tables.read(spark, "account_snapshots", path).collect()) == want and len(want) == 9
        assert not list(tmp_path.glob("*dates*"))
    assert len(asked) == 4 and all("BroadcastHashJoin" in p and "hashpartitioning(block_number" not in p for p in plans)


def test_a_first_write_compares_nothing(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(tables, "same_rows", lambda a, b: seen.append(1))
    rows, path = spark.createDataFrame([candle(0, 1.0, 1.0)], CANDLE), str(tmp_path / "t")
    assert not tables.write_if_changed(rows.where("false"), "ohlcv_1m", path)
    assert tables.write_if_changed(rows, "ohlcv_1m", path) and not seen


@pytest.mark.parametrize("buckets", [1, 5])
def test_sharded_equals_one_pass(spark, tmp_path, buckets):
    legs = spark.createDataFrame([(f"a{i % 7}", i, (i % 5) * DAY, Decimal(i)) for i in range(100)], "coldkey string, block_number long, timestamp_ms long, delta decimal(38,0)")
    m = Metric("balances", 1, "", build=lambda v, p: ledger.daily_balances(v["legs"]), shard_by="coldkey")
    once = sorted(map(tuple, ledger.daily_balances(legs).collect()))
    if buckets > 1:  # stopped half-way, then taken up again
        registry.materialise_sharded(spark, m, {"legs": legs}, str(tmp_path), buckets, only=[0, 2])
    out = registry.materialise_sharded(spark, m, {"legs": legs}, str(tmp_path), buckets)
    assert sorted(map(tuple, out.select("coldkey", "timestamp_ms", "balance_rao").collect())) == once


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "candles")
    tables.upsert_candles(spark.createDataFrame([candle(k * 60_000, 1.0, 1.0) for k in range(3)], CANDLE), path)
    tables.upsert_candles(spark.createDataFrame([candle(2 * 60_000, 9.0, 1.0), candle(3 * 60_000, 4.0, 1.0), candle(40 * DAY, 5.0, 1.0)], CANDLE), path)
    got = spark.read.parquet(path).orderBy("timestamp_ms").collect()
    assert [r.close for r in got] == [1.0, 1.0, 9.0, 4.0, 5.0] and {r.month for r in got} == {"1970-01", "1970-02"}


def test_an_upsert_is_one_job_without_a_copy_and_a_stopped_one_leaves_the_table(spark, tmp_path):
    path, seen = str(tmp_path / "candles"), spark.sparkContext.accumulator(0)

    def counted(fail=False):
        def count(ms):
            if fail and ms >= 40 * DAY:
                raise ValueError("stopped")
            seen.add(1)
            return True

        return F.udf(count, "boolean")

    first = spark.createDataFrame([candle(k * DAY, 1.0, 1.0) for k in range(80)], CANDLE)
    tables.upsert_candles(first.where(counted()("timestamp_ms")), path)
    assert seen.value == 80  # a first write reads its rows once
    assert [f.name for f in tmp_path.iterdir()] == ["candles"]
    held = lambda: [(r.timestamp_ms // DAY, r.close, r.month) for r in spark.read.parquet(path).orderBy("timestamp_ms").collect()]
    before, files = held(), sorted(str(f) for f in tmp_path.rglob("*.parquet"))
    later = spark.createDataFrame([candle(k * DAY, 2.0, 1.0) for k in (3, 40, 41)], CANDLE)
    with pytest.raises(Exception, match="stopped"):
        tables.upsert_candles(later.where(counted(fail=True)("timestamp_ms")), path)
    assert held() == before and sorted(str(f) for f in tmp_path.rglob("*.parquet")) == files
    tables.upsert_candles(later, path)  # reads and replaces January and February, March stays
    assert held() == [(k, 2.0 if k in (3, 40, 41) else 1.0, m) for k, _, m in before]
    now = sorted(str(f) for f in tmp_path.rglob("*.parquet"))
    assert [f for f in now if f in files] == [f for f in files if "1970-03" in f] and len(now) == len(files)


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_or_empty(spark, "runtime_versions", path).count() == 0
    df = spark.createDataFrame([(1, 2, 3)], SCHEMAS["runtime_versions"])
    assert tables.write_if_changed(df, "runtime_versions", path) and not tables.write_if_changed(df, "runtime_versions", path)
    tables.append(df, path)
    assert tables.read_or_empty(spark, "runtime_versions", path).count() == 2
    tables.write_sorted(df, str(tmp_path / "s"), "from_block")
    tables.append_json(df, str(tmp_path / "j"))
    (tmp_path / "labels.json").write_text(json.dumps([{"coldkey": "A", "exchange": "x", "confidence": "high", "date_added": "d", "evidence": "e"}]))
    assert tables.read_labels(spark, str(tmp_path / "labels.json")).first().exchange == "x"
    blocks = spark.createDataFrame([(b, "h", "0x", None, 1) for b in range(10)], SCHEMAS["chain_events"])
    blocks.write.parquet(str(tmp_path / "b"))
    assert tables.read_blocks(spark, str(tmp_path / "b"), 2, 5).count() == 4 and tables.read_blocks(spark, str(tmp_path / "b"), blocks=[1, 99]).count() == 1


def land(df, folder, n):
    df.coalesce(1).write.mode("append").parquet(str(folder))
    return n


def test_streams_equal_batch(spark, tmp_path):
    schema = "series string, timestamp_ms long, pair string, close double, quote_volume double"
    rows = [(f"s{i % 2}", (i + 3 * (i // 5)) * HOUR, "p", float(i), 1.0) for i in range(60)]
    land(spark.createDataFrame(rows[:30], schema), tmp_path / "in", 1)
    source = lambda: streams.landed(spark, str(tmp_path / "in"), schema)
    alarms = lambda: streams.run_available(streams.gap_alarms(source(), HOUR), str(tmp_path / "gaps"), str(tmp_path / "c1"))
    alarms()
    land(spark.createDataFrame(rows[30:], schema), tmp_path / "in", 2)
    alarms()  # goes on where it was
    batch = quality.gaps(spark.createDataFrame(rows, schema), HOUR, "series")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "gaps")).collect())) == sorted(map(tuple, batch.collect()))

    streams.run_available(streams.daily_figures(source(), late="0 seconds"), str(tmp_path / "days"), str(tmp_path / "c2"))
    got = {r.timestamp_ms: (r.close, r.volume) for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    want = {r.d: (r.close, r.v) for r in spark.createDataFrame(rows, schema).groupBy((F.floor(F.col("timestamp_ms") / DAY) * DAY).alias("d")).agg(F.max_by("close", "timestamp_ms").alias("close"), F.sum("quote_volume").alias("v")).collect()}
    assert got and all(want[d] == v for d, v in got.items()) and len(got) >= len(want) - 1
    weeks = streams.daily_figures(source(), width="7 days", start="4 days")
    assert weeks.isStreaming


def test_streamed_balances_dedupe_and_rates(spark, tmp_path):
    schema = "coldkey string, delta decimal(20,0)"
    big = 2**60
    land(spark.createDataFrame([("A", Decimal(big)), ("B", Decimal(-3))], schema), tmp_path / "in", 1)
    write = lambda batch, n: batch.withColumn("n", F.lit(n)).write.mode("append").parquet(str(tmp_path / "out"))
    go = lambda: streams.run_batches(streams.running_balances(streams.landed(spark, str(tmp_path / "in"), schema)), write, str(tmp_path / "c"))
    go()
    land(spark.createDataFrame([("A", Decimal(1))], schema), tmp_path / "in", 2)
    go()
    last = {r.coldkey: int(r.b) for r in spark.read.parquet(str(tmp_path / "out")).groupBy("coldkey").agg(F.max_by("balance_rao", "n").alias("b")).collect()}
    assert last == {"A": big + 1, "B": -3}

    keys = "block_number long, event_index int, timestamp_ms long"
    land(spark.createDataFrame([(1, 0, 5), (1, 0, 5), (1, 1, 6)], keys), tmp_path / "e", 1)
    streams.run_available(streams.deduplicated(streams.landed(spark, str(tmp_path / "e"), keys), ["block_number", "event_index"]), str(tmp_path / "u"), str(tmp_path / "c3"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2

    series = "timestamp_ms long, value double"
    land(spark.createDataFrame([(DAY, 10.0), (DAY + HOUR, 20.0)], series), tmp_path / "a", 1)
    land(spark.createDataFrame([(DAY, 5.0), (DAY + HOUR, 0.0)], series), tmp_path / "b", 1)
    rate = streams.live_rate(streams.landed(spark, str(tmp_path / "a"), series), streams.landed(spark, str(tmp_path / "b"), series))
    streams.run_available(rate, str(tmp_path / "r"), str(tmp_path / "c4"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [(DAY, 2.0)]

    candles = spark.createDataFrame([candle(0, 1.0, 1.0), candle(60_000, 2.0, 1.0)], CANDLE)
    land(candles, tmp_path / "k", 1)
    streams.upserted_candles(streams.landed(spark, str(tmp_path / "k"), CANDLE), str(tmp_path / "table"), str(tmp_path / "c5"))
    land(candles.limit(1).withColumn("close", F.lit(7.0)), tmp_path / "k", 2)
    streams.upserted_candles(streams.landed(spark, str(tmp_path / "k"), CANDLE), str(tmp_path / "table"), str(tmp_path / "c5"))
    assert sorted(r.close for r in spark.read.parquet(str(tmp_path / "table")).collect()) == [2.0, 7.0]


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["m02_price_composite_daily", "m11_account_balances_daily", "m12_wallet_count", "m15_labelled_totals", "d05_decode_plan", "d13_reconcile_checkpoints", "d16_coverage", "j11_snapshot_dates"])
def test_catalogue(spark, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = catalog.QUERIES[name](spark, SF)
    want = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    text = lambda rows: sorted(str(r) for r in rows)
    assert text(tuple(r) for r in got.select(*columns).collect()) == text(want.fetchall())


def test_silence_is_reported_before_it_ends(spark, tmp_path):
    schema = "series string, timestamp_ms long"
    land = lambda rows: spark.createDataFrame([(k, h * HOUR) for k, h in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: streams.run_available(streams.silence_alarms(streams.landed(spark, str(tmp_path / "in"), schema), HOUR), str(tmp_path / "out"), str(tmp_path / "c"))
    found = lambda: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    land([("a", 0), ("a", 1), ("b", 0), ("b", 1)])
    run()
    land([("a", 1), ("b", 1)])  # ticks that are no news keep the timer
    run()
    land([("b", h) for h in range(2, 10)])
    run()
    assert found() == [("a", 2 * HOUR)]
    land([("b", h) for h in range(10, 20)])  # still the same silence
    run()
    assert found() == [("a", 2 * HOUR)]
    land([("a", 19), ("b", 20)])
    run()
    land([("b", h) for h in range(21, 30)])
    run()
    assert found() == [("a", 2 * HOUR), ("a", 20 * HOUR)]


@pytest.fixture(scope="module")
def part_files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    for name in ("lineitem", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["t01_incremental_transfers", "t02_deduplicated_events", "t04_daily_figures", "t05_running_balances", "t06_gap_alarms"])
def test_streams_read_files_and_folders(spark, part_files, name):
    rows = lambda folder: sorted(catalog.QUERIES[name](spark, folder).collect(), key=str)
    file, parts = rows("/root/testdata/sf0.001"), rows(part_files)
    assert parts == file and (file or name == "t06_gap_alarms")


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
