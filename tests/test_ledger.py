"""Ledger, reconciliation and permutation properties."""

from __future__ import annotations

import random
from decimal import Decimal

from tidemark.functions.time_buckets import DAY
from tidemark.operators import ledger, quality, reconcile

T = "block_number long, event_index int, timestamp_ms long, from_coldkey string, to_coldkey string, amount_rao decimal(20,0)"
E = "block_number long, event_index int, timestamp_ms long, kind string, coldkey string, amount_rao decimal(20,0)"
S = "block_number long, timestamp_ms long, coldkey string, free_rao decimal(20,0), reserved_rao decimal(20,0)"


def transfers(spark, *rows):
    return spark.createDataFrame([(b, i, t, f, to, Decimal(a)) for i, (b, t, f, to, a) in enumerate(rows)], T)


def events(spark, *rows):
    return spark.createDataFrame([(b, i, t, k, c, Decimal(a)) for i, (b, t, k, c, a) in enumerate(rows)], E)


def got(df, *columns):
    return sorted(tuple(int(v) if isinstance(v, Decimal) else v for v in r) for r in df.select(*columns).collect())


def test_daily_balances(spark):
    tr = transfers(spark, (2, DAY, "A", "B", 4_990_000_000), (3, 2 * DAY, "B", "C", 4_990_000_000))
    ev = events(spark, (1, 0, "deposit", "A", 5_000_000_000), (4, 3 * DAY, "withdraw", "A", 10_000_000))
    out = ledger.daily_balances(ledger.signed_legs(tr, ev))
    assert got(out, "coldkey", "timestamp_ms", "balance_rao") == [
        ("A", 0, 5_000_000_000), ("A", DAY, 10_000_000), ("A", 3 * DAY, 0), ("B", DAY, 4_990_000_000), ("B", 2 * DAY, 0), ("C", 2 * DAY, 4_990_000_000),
    ]


def test_self_transfer(spark):
    out = ledger.daily_balances(ledger.signed_legs(transfers(spark, (2, DAY, "A", "A", 90_000_000)), events(spark, (1, 0, "deposit", "A", 10**9))))
    assert got(out, "timestamp_ms", "balance_rao") == [(0, 10**9), (DAY, 10**9)]


def test_genesis_seed(spark):
    snaps = spark.createDataFrame([(0, 0, "Genesis", Decimal(700), Decimal(300)), (0, 0, "Zero", Decimal(0), Decimal(0)), (50, 5, "Late", Decimal(9), Decimal(0)), (0, None, "Undated", Decimal(9), Decimal(0))], S)
    out = ledger.daily_balances(ledger.signed_legs(transfers(spark, (2, DAY, "Genesis", "Bob", 400)), events(spark), snaps))
    assert got(out, "coldkey", "timestamp_ms", "balance_rao") == [("Bob", DAY, 400), ("Genesis", 0, 1000), ("Genesis", DAY, 600)]


def test_beyond_two_to_the_53(spark):
    big = 2**53 + 1
    out = ledger.daily_balances(ledger.signed_legs(transfers(spark), events(spark, (1, 0, "deposit", "A", big))))
    assert got(out, "balance_rao") == [(big,)]


def test_holder_counts(spark):
    rows = [("A", 0, 5 * 10**9), ("A", DAY, 10**7), ("B", DAY, 499 * 10**7), ("B", 2 * DAY, 0), ("C", 2 * DAY, 499 * 10**7), ("A", 3 * DAY, 0)]
    df = spark.createDataFrame([(k, t, Decimal(b)) for k, t, b in rows], "coldkey string, timestamp_ms long, balance_rao decimal(38,0)")
    assert [v for _, v in got(ledger.holder_counts(df, 0), "timestamp_ms", "value")] == [1, 2, 2, 1]
    assert [v for _, v in got(ledger.holder_counts(df, 10**7), "timestamp_ms", "value")] == [1, 1, 1, 1]
    assert ledger.holder_counts(df.limit(0)).count() == 0


def test_labelled_totals(spark):
    rows = [("K", 0, 100), ("B", DAY, 50), ("K", 2 * DAY, 80), ("X", 0, 999)]
    df = spark.createDataFrame([(k, t, Decimal(b * 10**9)) for k, t, b in rows], "coldkey string, timestamp_ms long, balance_rao decimal(38,0)")
    labels = spark.createDataFrame([("K", "Kraken"), ("B", "Binance")], "coldkey string, exchange string")
    assert got(ledger.labelled_totals(df, labels), "timestamp_ms", "value") == [(0, 100.0), (DAY, 150.0), (2 * DAY, 130.0)]
    assert ledger.labelled_totals(df, labels.limit(0)).count() == 0


def test_transfer_counts(spark):
    tr = transfers(spark, (1, 0, "a", "b", 1), (2, 0, "P", "b", 1), (3, 0, "a", "Q", 1), (4, 0, "b", "a", 1), (5, DAY, "a", "b", 1), (6, DAY, "P", "Q", 1))
    protocol = spark.createDataFrame([("P", "x"), ("Q", "y")], "coldkey string, pallet_id string")
    user, other = ledger.user_transfers(tr, protocol), ledger.protocol_transfers(tr, protocol)
    assert got(ledger.daily_count(user), "timestamp_ms", "value") == [(0, 2), (DAY, 1)]
    assert got(ledger.daily_count(other), "timestamp_ms", "value") == [(0, 2), (DAY, 1)]
    nothing = transfers(spark, (1, 0, None, "b", 1))
    assert ledger.user_transfers(nothing, protocol).count() == 0 and ledger.user_transfers(nothing, protocol.limit(0)).count() == 1


def test_net_deltas(spark):
    tr = transfers(spark, (12, 0, "A", "B", 40), (15, 0, "C", "C", 5), (5, 0, "A", "B", 99))
    ev = events(spark, (13, 0, "withdraw", "B", 3), (14, 0, "deposit", "D", 9), (25, 0, "deposit", "D", 9))
    assert got(ledger.net_deltas(ledger.signed_legs(tr, ev), 10, 20), "coldkey", "delta") == [("A", -40), ("B", 37), ("C", 0), ("D", 9)]


def test_transfers_commute_and_conserve(spark):
    rnd = random.Random(1)
    rows = [(i, i * 1000, f"a{rnd.randrange(5)}", f"a{rnd.randrange(5)}", rnd.randrange(10**12)) for i in range(60)]
    first = got(ledger.fold_balances(ledger.transfer_legs(transfers(spark, *rows))), "coldkey", "balance_rao")
    rnd.shuffle(rows)
    df = transfers(spark, *rows)
    assert got(ledger.fold_balances(ledger.transfer_legs(df.repartition(5))), "coldkey", "balance_rao") == first
    assert sum(b for _, b in first) == 0 and quality.conservation(df).first().net_rao == 0


def test_fold_with_opening_balances(spark):
    opening = spark.createDataFrame([("A", Decimal(10)), ("Z", Decimal(1))], "coldkey string, balance_rao decimal(38,0)")
    out = ledger.fold_balances(ledger.transfer_legs(transfers(spark, (1, 0, "A", "B", 25))), opening)
    assert got(out, "coldkey", "balance_rao") == [("A", -15), ("B", 25), ("Z", 1)]


def test_checkpoints_do_not_cascade(spark):
    legs = ledger.transfer_legs(transfers(spark, (50, 0, "A", "B", 100), (150, 0, "B", "C", 30), (240, 0, "A", "B", 7)))
    opening = spark.createDataFrame([("A", Decimal(1000))], "coldkey string, balance_rao decimal(38,0)")
    seen = [("A", 0, 900), ("B", 0, 105), ("B", 1, 75), ("C", 1, 30)]
    observed = spark.createDataFrame([(k, w, Decimal(b)) for k, w, b in seen], "coldkey string, window_index long, balance_rao decimal(38,0)")
    out = reconcile.reconcile_checkpoints(legs, observed, 1, 250, 100, opening)
    assert got(out.where("not matches"), "window_index", "coldkey", "expected", "observed") == [(0, "B", 100, 105)]
    assert got(reconcile.checkpoint_summary(out), "window_index", "touched", "mismatches") == [(0, 2, 1), (1, 2, 0)]


def test_reconcile_window_carries(spark):
    legs = ledger.transfer_legs(transfers(spark, (5, 0, "A", "B", 10)))
    table = lambda *r: spark.createDataFrame([(k, Decimal(b)) for k, b in r], "coldkey string, balance_rao decimal(38,0)")
    rows = reconcile.reconcile_window(legs, 1, 10, table(("A", 50)), table(("A", 1), ("B", 3)), table(("A", 40), ("B", 12)))
    assert got(rows, "coldkey", "baseline", "expected", "observed", "matches") == [("A", 50, 40, 40, True), ("B", 3, 13, 12, False)]
    assert got(reconcile.carried(table(("A", 50), ("Z", 2)), rows), "coldkey", "balance_rao") == [("A", 40), ("B", 12), ("Z", 2)]


def test_sizing(spark):
    touches = spark.createDataFrame([("A", 1), ("B", 1), ("A", 5), ("A", 15), ("B", 15)], "coldkey string, block_number long")
    out = reconcile.reconciliation_sizing(touches, 1, 20, 10, 2)
    assert got(out, "window_index", "touched", "new", "calls") == [(0, 2, 2, 6), (1, 2, 0, 4)]
    late = spark.createDataFrame([("A", 8)], "coldkey string, block_number long")
    assert got(reconcile.reconciliation_sizing(late, 1, 20, 10), "window_index", "touched") == [(0, 1), (1, 0)]


def test_hot_account_is_combined_before_the_window(spark):
    rows = [(i, (i % 3) * DAY, "hot", f"c{i % 7}", 1) for i in range(3000)]
    out = ledger.daily_balances(ledger.transfer_legs(transfers(spark, *rows)))
    assert got(out.where("coldkey = 'hot'"), "timestamp_ms", "balance_rao") == [(0, -1000), (DAY, -2000), (2 * DAY, -3000)]


def test_emptied_and_staked(spark):
    b = spark.createDataFrame([("A", 0, Decimal(5)), ("A", DAY, Decimal(0)), ("B", 0, Decimal(1))], "coldkey string, timestamp_ms long, balance_rao decimal(38,0)")
    labels = spark.createDataFrame([("A", "x"), ("B", "y")], "coldkey string, exchange string")
    assert got(ledger.emptied_for_good(b, labels), "coldkey", "since_ms") == [("A", DAY)]
    stake = spark.createDataFrame([(1, 0, 0, "stakeAdded", "h1", Decimal(5)), (2, 0, DAY, "stakeRemoved", "h1", Decimal(5)), (3, 0, DAY, "stakeAdded", "h2", Decimal(1))], E.replace("coldkey", "hotkey"))
    owners = spark.createDataFrame([("h1", "A"), ("h2", "B")], "hotkey string, coldkey string")
    assert got(ledger.staked_accounts(stake, owners), "timestamp_ms", "value") == [(0, 1), (DAY, 1)]
