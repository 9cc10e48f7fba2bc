"""Registered queries over cost basis and supply in profit, under both emission rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.time_buckets import DAY
from tidemark.operators import cost_basis
from tidemark.plans import catalog
from tidemark.plans import testbed as t
from tidemark.plans.catalog import longs, register
from tidemark.plans.testbed import oracle
from tidemark.sources import tables
from tidemark.sources.workspace import shared_folder

_SPOT = "SELECT timestamp_ms, CAST(floor(value) AS BIGINT) AS price FROM usd"
_LEGS = """SELECT from_coldkey AS coldkey, timestamp_ms, block_number, event_index, -amount_rao AS delta, false AS emission FROM transfers WHERE from_coldkey <> to_coldkey
    UNION ALL SELECT to_coldkey, timestamp_ms, block_number, event_index, amount_rao, false FROM transfers WHERE from_coldkey <> to_coldkey
    UNION ALL SELECT coldkey, timestamp_ms, block_number, event_index, CASE WHEN kind = 'deposit' THEN amount_rao ELSE -amount_rao END, kind = 'deposit' FROM balance_events
    UNION ALL SELECT coldkey, timestamp_ms, block_number, -1, free_rao + reserved_rao, false FROM account_snapshots"""


def _folded(rule: str) -> dict[str, str]:
    """Common tables: the legs with prices, folded one after another by recursion, and each account's last state of a day."""
    price = "coalesce(p.price, 0)" if rule == "market" else "CASE WHEN l.emission THEN 0 ELSE coalesce(p.price, 0) END"
    return {
        "spot": _SPOT, "moves": _LEGS,
        "numbered": f"""SELECT coldkey, l.timestamp_ms // 86400000 * 86400000 AS dayms, CAST(delta AS HUGEINT) AS d, CAST({price} AS HUGEINT) AS p,
            row_number() OVER (PARTITION BY coldkey ORDER BY l.timestamp_ms, block_number, event_index, delta, emission) AS rn FROM moves l ASOF LEFT JOIN spot p ON l.timestamp_ms >= p.timestamp_ms""",
        "folded": """SELECT coldkey, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS dayms, CAST(0 AS HUGEINT) AS q, CAST(0 AS HUGEINT) AS c FROM (SELECT DISTINCT coldkey FROM numbered)
            UNION ALL SELECT n.coldkey, n.rn, n.dayms, f.q + n.d, CASE WHEN n.d >= 0 AND f.q >= 0 THEN f.c + n.d * n.p WHEN n.d >= 0 THEN greatest(f.q + n.d, 0) * n.p
                WHEN f.q + n.d <= 0 THEN 0 ELSE f.c - (f.c * -n.d) // f.q END FROM folded f JOIN numbered n ON n.coldkey = f.coldkey AND n.rn = f.rn + 1""",
        "states": "SELECT coldkey, dayms, q, c FROM folded WHERE rn > 0 QUALIFY row_number() OVER (PARTITION BY coldkey, dayms ORDER BY rn DESC) = 1",
    }


def _oracle(rule: str, body: str, **more: str) -> str:
    sql = oracle(["transfers", "balance_events", "account_snapshots", "usd"], body, **_folded(rule), **more)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def prices(s, d):
    return cost_basis.whole_prices(catalog.usd(s, d))


def legs(s, d, rule: str):
    return cost_basis.priced_legs(t.transfers(s, d), t.balance_events(s, d), prices(s, d), rule, t.account_snapshots(s, d))


def states(s, d, rule: str):
    """Daily costs as a table: the days, the supply and the levels are all made from them."""
    folder = shared_folder(s, "cost")
    tables.append(cost_basis.daily_cost(legs(s, d, rule)), folder)
    return s.read.schema("coldkey string, timestamp_ms long, balance_rao decimal(38,0), cost decimal(38,0)").parquet(folder)


@register("j14_price_as_of", oracle(["transfers", "usd"], "SELECT x.timestamp_ms, p.price FROM (SELECT DISTINCT timestamp_ms - 1 AS timestamp_ms FROM transfers) x ASOF LEFT JOIN spot p ON x.timestamp_ms >= p.timestamp_ms", spot=_SPOT))
def price_as_of(s, d):
    """The price as of a millisecond before each transfer."""
    asked = t.transfers(s, d).select((F.col("timestamp_ms") - 1).alias("timestamp_ms"))
    return cost_basis.as_of(asked, prices(s, d), "timestamp_ms", "price", DAY)


def cost(rule: str):
    return lambda s, d: longs(cost_basis.daily_cost(legs(s, d, rule)), "balance_rao", "cost")


def profit(rule: str):
    return lambda s, d: longs(cost_basis.supply_in_profit(states(s, d, rule), prices(s, d)), "supply_rao", "in_profit_rao")


for _rule in cost_basis.EMISSION_RULES:
    register(f"x01_cost_basis_{_rule}", _oracle(_rule, "SELECT coldkey, dayms AS timestamp_ms, CAST(q AS BIGINT) AS balance_rao, CAST(c AS BIGINT) AS cost FROM states"))(cost(_rule))
    register(
        f"x01_supply_in_profit_{_rule}",
        _oracle(
            _rule,
            """SELECT dayms AS timestamp_ms, CAST(supply AS BIGINT) AS supply_rao, CAST(CASE WHEN price IS NOT NULL THEN gained END AS BIGINT) AS in_profit_rao,
            CASE WHEN supply > 0 AND price IS NOT NULL THEN gained::DOUBLE / supply::DOUBLE END AS value FROM held""",
            closes="SELECT timestamp_ms // 86400000 * 86400000 AS dayms, arg_max(price, timestamp_ms) AS price FROM spot GROUP BY 1",
            days="SELECT unnest(generate_series(min(dayms), max(dayms), 86400000)) AS dayms FROM states",
            spots="SELECT d.dayms, c.price FROM days d ASOF LEFT JOIN closes c ON d.dayms >= c.dayms",
            dense="SELECT g.dayms, g.price, s.q, s.c FROM (SELECT * FROM spots, (SELECT DISTINCT coldkey FROM states)) g ASOF LEFT JOIN states s ON g.coldkey = s.coldkey AND g.dayms >= s.dayms",
            held="SELECT dayms, any_value(price) AS price, coalesce(sum(q) FILTER (q > 0), 0) AS supply, coalesce(sum(q) FILTER (q > 0 AND c < q * price), 0) AS gained FROM dense GROUP BY 1",
        ),
    )(profit(_rule))
