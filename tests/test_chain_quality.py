"""Raw blocks, decoding, gaps, coverage and constraint checks."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import decode
from tidemark.operators import chain, quality
from tidemark.sources.schemas import SCHEMAS

MIN = 60_000


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("minutes, want", [([0, 1, 5, 6], [(2, 4, 3)]), ([0, 2, 3, 6], [(1, 1, 1), (4, 5, 2)]), ([0, 1, 2], []), ([], [])])
def test_gaps(spark, minutes, want):
    df = spark.createDataFrame([("v", m * MIN) for m in minutes], "venue string, timestamp_ms long")
    assert rows(quality.gaps(df, MIN, "venue"), "gap_start_ms", "gap_end_ms", "missing") == [(a * MIN, b * MIN, n) for a, b, n in want]


def test_gap_log_and_coverage(spark):
    df = spark.createDataFrame([("k", "p", 0), ("k", "p", 3 * MIN), ("b", "p", 0)], "exchange string, pair string, timestamp_ms long")
    venues = spark.createDataFrame([("k", "p"), ("b", "p"), ("none", "p")], "exchange string, pair string")
    assert rows(quality.gap_log(df, venues, MIN, 9), "exchange", "rows_fetched", "missing_buckets") == [("b", 1, 0), ("k", 2, 2), ("none", 0, 0)]
    out = quality.coverage(df, venues, quality.gaps(df, MIN, "exchange", "pair"))
    assert rows(out, "exchange", "rows", "gaps", "missing", "status") == [("b", 1, 0, 0, "OK"), ("k", 2, 1, 2, "OK"), ("none", 0, 0, 0, "NO DATA")]


def test_segments(spark):
    spec = lambda b: 1 if b < 130 else 2 if b < 170 else 3 if b < 190 else 4
    df = spark.createDataFrame([(b, spec(b)) for b in range(100, 201)], "block_number long, spec_version int")
    want = [(100, 129, 1), (130, 169, 2), (170, 189, 3), (190, 200, 4)]
    assert rows(quality.segments(df, "block_number", "spec_version"), "from_block", "to_block", "spec_version") == want
    back = spark.createDataFrame([("s", i, v) for i, v in enumerate([1, 1, 2, 1, None, None])], "s string, at int, v int")
    assert [(r.first, r["last"], r.v) for r in quality.islands(back, ["s"], "at", "v").orderBy("first").collect()] == [(0, 1, 1), (2, 2, 2), (3, 3, 1), (4, 5, None)]


def test_decode_plan(spark):
    stamps = [(1, 101), (2, 101), (3, 101), (2, 102), (3, 102)]
    plan = chain.decode_plan(spark.createDataFrame(stamps, "block_number long, spec_version int"))
    assert [r.block_number for r in plan.where("is_conflict").orderBy("block_number").collect()] == [2, 3]
    assert rows(plan.where("is_transition"), "block_number", "decode_spec") == [(2, 101)]
    assert plan.where("goes_back").count() == 0
    back = chain.decode_plan(spark.createDataFrame([(1, 101), (2, 102), (3, 101)], "block_number long, spec_version int"))
    assert back.where("goes_back").count() == 1
    blocks = spark.createDataFrame([(1, 101), (2, 102), (3, 102)], "block_number long, spec_version int")
    assert rows(chain.with_decode_spec(blocks, plan), "block_number", "decode_spec") == [(1, 101), (2, 101), (3, 102)]
    assert chain.missing_specs(chain.with_decode_spec(blocks, plan), spark.createDataFrame([(101,)], "spec_version int")).count() == 1


def test_hex_decoding(spark):
    df = spark.createDataFrame([("0x0987590087010000",), (None,)], "h string")
    assert [r[0] for r in df.select(decode.block_timestamp("h")).collect()] == [1679338080009, None]
    info = "00" * 16 + (53156294875).to_bytes(8, "little").hex() + (2**64 - 1).to_bytes(8, "little").hex()
    out = decode.account_balances(spark.createDataFrame([("0x" + info,), (None,)], "account_info_hex string")).collect()
    assert [(r.free_rao, r.reserved_rao) for r in out] == [(Decimal(53156294875), Decimal(2**64 - 1)), (Decimal(0), Decimal(0))]
    key = "0x" + "11" * 48 + "ab" * 32
    assert spark.createDataFrame([(key,)], "k string").select(decode.account_id("k")).first()[0] == "ab" * 32


def base58(data):
    n, out = int.from_bytes(data, "big"), ""
    while n:
        n, r = divmod(n, 58)
        out = decode.BASE58[r] + out
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + out


def test_protocol_accounts(spark):
    address = base58(b"\x2a" + b"modlsubtensr" + bytes(20) + b"\1\2")
    ordinary = base58(b"\x2a" + bytes(range(1, 33)) + b"\1\2")
    wide = base58(b"\x50\x01" + b"modlpy/trsry" + bytes(20) + b"\1\2")
    assert [decode.pallet_of(x) for x in (address, wide, ordinary, "", "5Alice", None)] == ["subtensr", "py/trsry", None, None, None, None]
    legs = spark.createDataFrame([(address, ordinary), (ordinary, None), (address, wide)], "from_coldkey string, to_coldkey string")
    assert rows(decode.protocol_accounts(legs, "from_coldkey", "to_coldkey"), "coldkey", "pallet_id") == sorted([(address, "subtensr"), (wide, "py/trsry")])


def test_chain_silver(spark):
    e = lambda s, m, *d: (s, m, list(d))
    found = [e("Balances", "Transfer", "a", "b", "18446744073709551615"), e("system", "Other"), e("balances", "DustLost", "c", "2"), e("subtensorModule", "StakeAdded", "h", "3"), e("subtensorModule", "StakeRemoved", "h", "x", "3")]
    df = spark.createDataFrame([(1, 10, 1, found), (1, 10, 1, found), (2, 20, 1, None)], SCHEMAS["decoded_events"])
    out = chain.chain_silver(df)
    assert rows(out["transfers"], "block_number", "event_index", "amount_rao") == [(1, 0, Decimal(2**64 - 1))]
    assert rows(out["balance_events"], "event_index", "kind", "coldkey") == [(2, "withdraw", "c")]
    assert rows(out["stake_events"], "event_index", "kind", "hotkey") == [(3, "stakeAdded", "h")]
    assert rows(out["bad_blocks"], "block_number") == [(2,)]


def test_repair(spark, tmp_path):
    schema = "block_number long, amount long, part long"
    old = spark.createDataFrame([(1, 5, 0), (2, 6, 0), (11, 7, 1)], schema)
    path = str(tmp_path / "silver")
    old.write.partitionBy("part").parquet(path)
    new = spark.createDataFrame([(1, 5, 0), (2, 9, 0)], schema)
    none = spark.createDataFrame([], "block_number long")
    with pytest.raises(ValueError):
        chain.repair(old.where("part = 0"), new, spark.createDataFrame([(3,)], "block_number long"), path)
    changed = chain.repair(old.where("part = 0"), new, none, path)
    assert rows(changed, "block_number", "removed", "added") == [(2, 1, 1)]
    assert rows(spark.read.parquet(path), "block_number", "amount") == [(1, 5), (2, 9), (11, 7)]


def test_snapshot_dates(spark):
    snaps = spark.createDataFrame([(0, "x"), (10, "x"), (99, "x")], "block_number long, coldkey string")
    facts = spark.createDataFrame([(1, 100), (10, 150), (12, 200), (50, 190)], "block_number long, timestamp_ms long")
    assert rows(chain.date_snapshots(snaps, facts), "block_number", "timestamp_ms") == [(0, 100), (10, 190), (99, None)] or [tuple(r) for r in chain.date_snapshots(snaps, facts).select("block_number", "timestamp_ms").orderBy("block_number").collect()] == [(0, 100), (10, 190), (99, None)]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (-1, "a"), (None, "b")], "n long, k string")
    assert rows(quality.violations(df, positive="n >= 0", named="k is not null"), "check", "violations") == [("named", 0), ("positive", 2)]
    assert rows(quality.duplicates(df, "k"), "k", "copies") == [("a", 2)]
    assert not any(quality.has_plain_address(spark.createDataFrame([], s)) for s in SCHEMAS.values())
    same = quality.changed_keys(df, df.select("n", "k").orderBy(F.desc("n")), "k")
    assert same.count() == 0


def test_records_are_dealt_out_and_their_digits_cut_once(spark, monkeypatch):
    from tidemark.functions import decode
    from tidemark.plans import roundtrips

    monkeypatch.setattr(roundtrips, "TASK_RECORDS", 2)
    raw = roundtrips.raw_snapshots(spark, "/root/testdata/sf0.001")
    assert raw.rdd.getNumPartitions() > 6  # the tasks are not bounded by the join's six remainders
    free, whole = "0100000000000000", "00" * 16
    rows = spark.createDataFrame([(whole + free + "02" + "00" * 7,), ("0x" + whole + free + "ff" * 8,), (whole + free,), (whole + free[:-2],), ("",), (None,)], "account_info_hex string")
    found = [tuple(None if v is None else int(v) for v in r) for r in decode.account_balances(rows).select("free_rao", "reserved_rao").collect()]
    assert found == [(1, 2), (1, 2**64 - 1), (1, None), (None, None), (None, None), (0, 0)]


def test_an_accounts_record_is_decoded_once_for_all_of_its_snapshots(spark):
    from tidemark.plans import roundtrips
    from tidemark.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.001"
    found = QUERIES["p17_account_balances"](spark, sf)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Join") < plan.index("conv(")  # decoded below the join with the blocks
    one_by_one = roundtrips.longs(roundtrips.decode.account_balances(roundtrips.raw_snapshots(spark, sf)), "free_rao", "reserved_rao")
    every = lambda df: sorted(tuple(r) for r in df.select("block_number", "coldkey", "free_rao", "reserved_rao").collect())
    assert every(found) == every(one_by_one) and found.count() > 0
