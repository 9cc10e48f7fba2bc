"""Cost basis and supply in profit against plain Python, account by account and day by day."""

import random
from decimal import Decimal

import pytest

from tidemark.functions.time_buckets import DAY
from tidemark.operators import cost_basis
from tidemark.sources.schemas import SCHEMAS

LEGS = "coldkey string, timestamp_ms long, block_number long, event_index int, delta decimal(20,0), emission boolean, price long"


def legs_of(spark, rows):
    return spark.createDataFrame([(*r[:4], Decimal(r[4]), *r[5:]) for r in rows], LEGS)


def folded(rows):
    """(coldkey, day) -> (balance, cost), by the definition."""
    found, state = {}, {}
    for coldkey, ts, block, index, delta, emission, price in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[4], r[5])):
        q, c = state.get(coldkey, (0, 0))
        if delta >= 0:
            c = c + delta * price if q >= 0 else max(q + delta, 0) * price
        else:
            c = c - c * -delta // q if q + delta > 0 else 0
        state[coldkey] = found[coldkey, ts // DAY * DAY] = q + delta, c
    return found


def random_legs(n, seed):
    draw = random.Random(seed)
    accounts = ["hot"] * 6 + ["a", "b", "c", "d"]
    return [(draw.choice(accounts), draw.randrange(30) * DAY + draw.randrange(5), draw.randrange(100), draw.randrange(4), draw.randint(-50, 80), draw.random() < 0.3, draw.randint(0, 9)) for _ in range(n)]


def test_daily_cost_equals_a_fold_leg_by_leg_also_for_an_account_with_most_legs(spark):
    rows = random_legs(4_000, 1)
    got = {(r["coldkey"], r["timestamp_ms"]): (int(r["balance_rao"]), int(r["cost"])) for r in cost_basis.daily_cost(legs_of(spark, rows).repartition(5)).collect()}
    assert got == folded(rows)


def test_amounts_beyond_64_bits_stay_exact(spark):
    big = (1 << 64) - 1
    rows = [("a", 0, 1, 0, big, False, 7), ("a", 1, 2, 0, big, False, 2), ("a", 2, 3, 0, -big, False, 9), ("a", DAY, 4, 0, -3, False, 9)]
    got = {(r["coldkey"], r["timestamp_ms"]): (int(r["balance_rao"]), int(r["cost"])) for r in cost_basis.daily_cost(legs_of(spark, rows)).collect()}
    assert got == folded(rows)


def test_empty_legs_give_no_days(spark):
    assert cost_basis.daily_cost(spark.createDataFrame([], LEGS)).count() == 0
    states = spark.createDataFrame([], "coldkey string, timestamp_ms long, balance_rao decimal(38,0), cost decimal(38,0)")
    assert cost_basis.supply_in_profit(states, spark.createDataFrame([(0, 1)], "timestamp_ms long, price long")).count() == 0


@pytest.mark.parametrize(("rule", "cost"), [("market", 30 * 5 + 10 * 7), ("zero", 30 * 5)])
def test_emission_enters_by_the_rule(spark, rule, cost):
    transfers = spark.createDataFrame([(1, 0, 10, "x", "a", 30), (3, 0, 30, "a", "a", 25)], SCHEMAS["transfers"].replace("decimal(20,0)", "long"))
    events = spark.createDataFrame([(2, 0, 20, "deposit", "a", 10)], SCHEMAS["balance_events"].replace("decimal(20,0)", "long"))
    prices = spark.createDataFrame([(9, 5), (20, 7), (25, 100)], "timestamp_ms long, price long")
    got = {r["coldkey"]: (int(r["balance_rao"]), int(r["cost"])) for r in cost_basis.daily_cost(cost_basis.priced_legs(transfers, events, prices, rule)).collect()}
    assert got == {"a": (40, cost), "x": (-30, 0)}


def test_an_unknown_emission_rule_is_an_error(spark):
    empty = spark.createDataFrame([], SCHEMAS["transfers"])
    with pytest.raises(ValueError, match="emission rule"):
        cost_basis.priced_legs(empty, spark.createDataFrame([], SCHEMAS["balance_events"]), spark.createDataFrame([], "timestamp_ms long, price long"), "half")


def test_as_of_carries_values_over_ranges_and_ignores_points_without_one(spark):
    points = spark.createDataFrame([(5, 1), (5, 2), (40, None), (1000, 3)], "k long, v long")
    asked = spark.createDataFrame([(4,), (5,), (6,), (6,), (39,), (500,), (999,), (1000,), (5000,), (None,)], "k long")
    got = {r["k"]: r["v"] for r in cost_basis.as_of(asked, points, "k", "v", 10).collect()}
    assert got == {4: None, 5: 2, 6: 2, 39: 2, 500: 2, 999: 2, 1000: 3, 5000: 3}


def test_supply_in_profit_equals_a_table_of_accounts_by_days(spark):
    legs = random_legs(600, 2)
    prices = [(d * DAY + 7, p) for d, p in zip(range(3, 30, 2), random.Random(3).choices(range(1, 8), k=14))]
    states = cost_basis.daily_cost(legs_of(spark, legs))
    got = {r["timestamp_ms"]: (int(r["supply_rao"]), None if r["in_profit_rao"] is None else int(r["in_profit_rao"])) for r in cost_basis.supply_in_profit(states, spark.createDataFrame(prices, "timestamp_ms long, price long")).collect()}
    by_day = folded(legs)
    days = range(min(d for _, d in by_day), max(d for _, d in by_day) + DAY, DAY)
    want, state, price = {}, {}, None
    for now in days:
        state |= {a: by_day[a, d] for a, d in by_day if d == now}
        price = next((p for ts, p in prices if ts // DAY * DAY == now), price)
        before = [p for ts, p in prices if ts // DAY * DAY <= now]
        price = before[-1] if before else None
        held = [(q, c) for q, c in state.values() if q > 0]
        want[now] = sum(q for q, _ in held), None if price is None else sum(q for q, c in held if c < q * price)
    assert got == want


def test_packed_rows_are_bounded(spark):
    rows = spark.range(1_000).selectExpr("if(id < 700, 'a', 'b') AS coldkey", "id AS day", "CAST(id AS decimal(38,0)) AS delta", "id * 2 AS price").coalesce(1)
    packs = cost_basis._packed(rows).orderBy("nth").collect()
    assert max(len(p.days) for p in packs) <= 128 and {(len(p.days), len(p.deltas), len(p.prices)) for p in packs} == {(n, n, n) for n in (128, 60, 44)}
    assert [d for p in packs for d in p.days] == list(range(1_000)) and [p.nth for p in packs] == list(range(len(packs)))
    assert [p.coldkey for p in packs] == ["a"] * 6 + ["b"] * 3
