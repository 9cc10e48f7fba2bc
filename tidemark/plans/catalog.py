"""All registered queries and their oracle SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import HOUR, millis, month_key
from tidemark.operators import chain, ledger, prices, quality, reconcile
from tidemark.plans import testbed as t
from tidemark.plans.testbed import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

D = "// 86400000 * 86400000"
W = "(timestamp_ms + 259200000) // 604800000 * 604800000 - 259200000"


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def longs(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as longs, which is how the oracle has them."""
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# --- prices -----------------------------------------------------------------------------------------------------------


def usd(spark, d):
    return prices.vwap(t.candles(spark, d).where(F.col("pair").isin("A", "R")))


def reference(spark, d):
    return prices.vwap(t.candles(spark, d).where("pair = 'N'"))


def btc(spark, d):
    return prices.cross_rate(usd(spark, d), reference(spark, d))


def _close(view: str, bucket: str) -> str:
    return f"SELECT {bucket} AS timestamp_ms, arg_max(value, timestamp_ms) AS value FROM {view} GROUP BY 1"


register("m01_price_composite", oracle(["usd"], "SELECT * FROM usd"))(usd)
register("m07_reference_price", oracle(["reference"], "SELECT * FROM reference"))(reference)
register("m04_cross_rate", oracle(["btc"], "SELECT * FROM btc"))(btc)
register("m02_price_composite_daily", oracle(["usd"], _close("usd", f"timestamp_ms {D}")))(lambda s, d: prices.daily_close(usd(s, d)))
register("m03_price_composite_weekly", oracle(["usd"], _close("usd", W)))(lambda s, d: prices.weekly_close(prices.daily_close(usd(s, d))))
register("m05_cross_rate_daily", oracle(["btc"], _close("btc", f"timestamp_ms {D}")))(lambda s, d: prices.daily_close(btc(s, d)))
register("m06_cross_rate_weekly", oracle(["btc"], _close("btc", W)))(lambda s, d: prices.weekly_close(prices.daily_close(btc(s, d))))


@register("m08_volume_daily", oracle(["candles"], f"SELECT timestamp_ms {D} AS timestamp_ms, CAST(sum(quote_volume) AS BIGINT) AS value FROM candles WHERE exchange = 'O1' AND pair IN ('A', 'N') GROUP BY 1"))
def volume_daily(s, d):
    return prices.daily_sum(t.candles(s, d).where(F.col("exchange") == "O1").where(F.col("pair").isin("A", "N")), "quote_volume")


@register("m14_trends_series", oracle(["trends"], "SELECT week_start_ms AS timestamp_ms, value, row_id FROM trends WHERE keyword = '2-HIGH'"))
def trends_series(s, d):
    return t.trends(s, d).where("keyword = '2-HIGH'").select(F.col("week_start_ms").alias("timestamp_ms"), "value", "row_id")


QUOTES = "SELECT pair, exchange, at_ms AS timestamp_ms, close AS price, event_id % 7 AS volume FROM ticks"


@register(
    "a18_composite_staleness",
    oracle(["ticks"], """SELECT pair, sum(price * volume) FILTER (ok)::DOUBLE / sum(volume) FILTER (ok)::DOUBLE AS price,
        coalesce(array_to_string(list_sort(list(DISTINCT exchange) FILTER (ok)), ','), '') AS venues FROM
        (SELECT *, volume > 0 AND 1705276800000 - timestamp_ms <= 43200000 AS ok FROM quotes) GROUP BY pair""", quotes=QUOTES),
)
def composite_staleness(s, d):
    quotes = t.ticks(s, d).select("pair", "exchange", F.col("at_ms").alias("timestamp_ms"), F.col("close").alias("price"), F.pmod("event_id", F.lit(7)).alias("volume"))
    return prices.composite(quotes, 1_705_276_800_000, 12 * HOUR, ["pair"]).select("pair", "price", F.array_join("venues", ",").alias("venues"))


OBSERVED = "SELECT timestamp_ms, value * (1 + 0.0625 * (timestamp_ms // 60000 % 3)) AS value FROM btc"


@register("d11_cross_rate_check", oracle(["btc"], "SELECT timestamp_ms, implied, observed, abs(implied - observed) / abs(observed) AS divergence FROM (SELECT b.timestamp_ms, b.value AS implied, o.value AS observed FROM btc b JOIN observed o USING (timestamp_ms) WHERE o.value <> 0) WHERE abs(implied - observed) / abs(observed) > 0.05", observed=OBSERVED))
def cross_rate_check(s, d):
    off = F.lit(1) + F.pmod(F.col("timestamp_ms") / 60_000, F.lit(3.0)).cast("long") * F.lit(0.0625)
    observed = btc(s, d).select("timestamp_ms", (F.col("value") * off).alias("value"))
    return prices.cross_rate_check(usd(s, d), reference(s, d), observed, 0.05)


@register("d01_candle_silver", oracle(["candles"], "SELECT DISTINCT * FROM candles"))
def candle_silver(s, d):
    return prices.candle_silver(t.candles(s, d))


@register("d03_latest_fetch", oracle(["trends"], "SELECT keyword, week_start_ms, value, row_id, fetched_at_ms FROM (SELECT *, max(fetched_at_ms) OVER (PARTITION BY keyword) AS newest FROM trends) WHERE fetched_at_ms = newest"))
def latest_fetch(s, d):
    return prices.latest_fetch(t.trends(s, d), "keyword", "fetched_at_ms")


@register("p03_month_key", oracle(["candles"], "SELECT strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m') AS month, count(*) AS rows FROM candles GROUP BY 1"))
def months(s, d):
    return t.candles(s, d).groupBy(month_key("timestamp_ms").alias("month")).agg(F.count("*").alias("rows"))


@register("x03_gained_per_day", oracle(["trends"], "SELECT keyword, fetched_at_ms, value - lag(value) OVER (PARTITION BY keyword ORDER BY fetched_at_ms) AS value_gained FROM snaps", snaps="SELECT keyword, fetched_at_ms, CAST(sum(value) AS BIGINT) AS value FROM trends GROUP BY 1, 2"))
def gained(s, d):
    snaps = t.trends(s, d).groupBy("keyword", "fetched_at_ms").agg(F.sum("value").alias("value"))
    return prices.gained_per_day(snaps, "keyword", "fetched_at_ms", "value")


@register("d02_keyed_latest_wins", oracle(["candles"], """SELECT exchange, pair, timestamp_ms, close, quote_volume FROM (SELECT *, row_number() OVER
    (PARTITION BY exchange, pair, timestamp_ms ORDER BY late DESC, close DESC, quote_volume DESC) AS nth FROM versions) WHERE nth = 1""",
    versions="SELECT exchange, pair, timestamp_ms, close, quote_volume, CASE WHEN quote_volume % 3 = 0 THEN 1 ELSE 0 END AS late FROM candles"))
def latest_wins(s, d):
    from tidemark.sources.tables import latest_by_key

    rows = t.candles(s, d).select("exchange", "pair", "timestamp_ms", "close", "quote_volume")
    late = F.col("quote_volume") % 3 == 0
    return latest_by_key(rows.where(~late), rows.where(late), ["exchange", "pair", "timestamp_ms"])


# --- ledger -----------------------------------------------------------------------------------------------------------


def legs(s, d, seeded: bool = False):
    return ledger.signed_legs(t.transfers(s, d), t.balance_events(s, d), t.account_snapshots(s, d) if seeded else None)


def balances(s, d):
    return ledger.daily_balances(legs(s, d, True))


def block_range(s, d) -> tuple[int, int]:
    """The first and the last block of the ledger; reconciliation runs from one to the other."""
    found = t.transfers(s, d).select("block_number").union(t.balance_events(s, d).select("block_number")).agg(F.min("block_number"), F.max("block_number")).first()
    return (0, 0) if found[0] is None else tuple(found)


BOUNDS = "SELECT min(block_number) AS lo, max(block_number) AS hi FROM legs"


@register("u01_signed_legs", oracle(["seeded"], f"SELECT coldkey, timestamp_ms {D} AS timestamp_ms, CAST(sum(delta) AS BIGINT) AS delta FROM seeded GROUP BY 1, 2"))
def signed_legs(s, d):
    return longs(ledger.daily_deltas(legs(s, d, True)), "delta")


@register("m11_account_balances_daily", oracle(["balances"], "SELECT coldkey, timestamp_ms, CAST(balance_rao AS BIGINT) AS balance_rao FROM balances"))
def account_balances_daily(s, d):
    return longs(balances(s, d), "balance_rao")


def _holders(threshold: int) -> str:
    return oracle(["balances"], """SELECT s.timestamp_ms, CAST(sum(net) OVER (ORDER BY s.timestamp_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
        FROM (SELECT unnest(generate_series((SELECT min(timestamp_ms) FROM balances), (SELECT max(timestamp_ms) FROM balances), 86400000)) AS timestamp_ms) s
        LEFT JOIN net USING (timestamp_ms)""",
        above=f"SELECT coldkey, timestamp_ms, CASE WHEN balance_rao > {threshold} THEN 1 ELSE 0 END AS above FROM balances",
        crossing="SELECT timestamp_ms, above - lag(above, 1, 0) OVER (PARTITION BY coldkey ORDER BY timestamp_ms) AS c FROM above",
        net="SELECT timestamp_ms, sum(c) AS net FROM crossing WHERE c <> 0 GROUP BY 1")


register("m12_wallet_count", _holders(0))(lambda s, d: ledger.holder_counts(balances(s, d), 0))
register("m13_wallet_count_dust", _holders(10_000_000))(lambda s, d: ledger.holder_counts(balances(s, d), 10_000_000))

register("m15_labelled_totals", oracle(["balances", "labels_"], """SELECT timestamp_ms, coalesce(sum(f), 0)::DOUBLE / 1e9 AS value FROM (SELECT timestamp_ms, coldkey,
        last_value(balance_rao IGNORE NULLS) OVER (PARTITION BY coldkey ORDER BY timestamp_ms ROWS UNBOUNDED PRECEDING) AS f FROM dense) GROUP BY 1""",
        held="SELECT b.* FROM balances b JOIN labels_ l USING (coldkey)",
        dense="""SELECT s.timestamp_ms, l.coldkey, h.balance_rao FROM (SELECT unnest(generate_series((SELECT min(timestamp_ms) FROM held), (SELECT max(timestamp_ms) FROM held), 86400000)) AS timestamp_ms) s
        CROSS JOIN labels_ l LEFT JOIN held h ON h.coldkey = l.coldkey AND h.timestamp_ms = s.timestamp_ms"""))(
    lambda s, d: ledger.labelled_totals(balances(s, d), t.labels(s, d))
)

_BOTH = "from_coldkey NOT IN (SELECT coldkey FROM protocol) AND to_coldkey NOT IN (SELECT coldkey FROM protocol)"
register("m09_transfer_count", oracle(["transfers", "protocol"], f"SELECT timestamp_ms {D} AS timestamp_ms, count(*) AS value FROM transfers WHERE {_BOTH} GROUP BY 1"))(
    lambda s, d: ledger.daily_count(ledger.user_transfers(t.transfers(s, d), t.protocol(s, d)))
)
register("m10_transfer_count_protocol", oracle(["transfers", "protocol"], f"SELECT timestamp_ms {D} AS timestamp_ms, count(*) AS value FROM transfers WHERE NOT ({_BOTH}) GROUP BY 1"))(
    lambda s, d: ledger.daily_count(ledger.protocol_transfers(t.transfers(s, d), t.protocol(s, d)))
)
register("a07_net_deltas", oracle(["legs"], "SELECT coldkey, CAST(sum(delta) AS BIGINT) AS delta FROM legs, bounds WHERE block_number BETWEEN lo + (hi - lo) // 10 AND hi GROUP BY 1", bounds=BOUNDS))(
    lambda s, d: (lambda lo, hi: longs(ledger.net_deltas(legs(s, d), lo + (hi - lo) // 10, hi), "delta"))(*block_range(s, d))
)
register("a17_balance_fold", oracle(["seeded"], "SELECT coldkey, CAST(sum(delta) AS BIGINT) AS balance_rao FROM seeded GROUP BY 1"))(
    lambda s, d: longs(ledger.fold_balances(legs(s, d, True)), "balance_rao")
)
register("q01_supply_conservation", oracle(["transfers"], "SELECT -CAST(sum(amount_rao) AS BIGINT) AS out_rao, CAST(sum(amount_rao) AS BIGINT) AS in_rao, CAST(0 AS BIGINT) AS net_rao FROM transfers"))(
    lambda s, d: longs(quality.conservation(t.transfers(s, d)), "out_rao", "in_rao", "net_rao")
)
register("q02_duplicate_keys", oracle(["transfers"], "SELECT block_number, event_index, count(*) AS copies FROM transfers GROUP BY 1, 2 HAVING count(*) > 1"))(
    lambda s, d: quality.duplicates(t.transfers(s, d), "block_number", "event_index")
)


@register("q03_constraints", oracle(["transfers"], """SELECT 'blocks' AS "check", count(*) FILTER (WHERE NOT coalesce(block_number >= 0, false)) AS violations FROM transfers UNION ALL
    SELECT 'amounts', count(*) FILTER (WHERE NOT coalesce(amount_rao > 500000, false)) FROM transfers UNION ALL SELECT 'legs', count(*) FILTER (WHERE NOT coalesce(from_coldkey <> to_coldkey, false)) FROM transfers"""))  # fmt: skip
def constraints(s, d):
    return quality.violations(t.transfers(s, d), blocks="block_number >= 0", amounts="amount_rao > 500000", legs="from_coldkey <> to_coldkey")


@register("q03_label_uniqueness", oracle([], "SELECT coldkey, count(*) AS copies FROM listed GROUP BY 1 HAVING count(*) > 1", listed="SELECT 'A' || CAST(s_suppkey % 97 AS VARCHAR) AS coldkey FROM supplier"))
def label_uniqueness(s, d):
    """A list in which suppliers that share an account are named twice."""
    return quality.unique_violations(t.table(s, d, "supplier").select(t.account(F.pmod("s_suppkey", F.lit(97))).alias("coldkey")), "coldkey")


@register("u02_distinct_accounts", oracle(["transfers"], "SELECT from_coldkey AS coldkey FROM transfers UNION SELECT to_coldkey FROM transfers"))
def accounts(s, d):
    return t.transfers(s, d).select(F.explode(F.array("from_coldkey", "to_coldkey")).alias("coldkey")).distinct()


_CLOSED = """SELECT coldkey, timestamp_ms, balance_rao FROM balances UNION ALL SELECT coldkey, max(timestamp_ms) + 86400000, 0 FROM balances WHERE length(coldkey) = 2 GROUP BY 1"""


@register("x04_emptied_accounts", oracle(["balances", "labels_"], "SELECT coldkey, exchange, since_ms FROM (SELECT coldkey, arg_max(balance_rao, timestamp_ms) AS b, max(timestamp_ms) AS since_ms FROM closed GROUP BY 1) JOIN labels_ USING (coldkey) WHERE b = 0", closed=_CLOSED))
def emptied(s, d):
    """Of the labelled accounts, those that were closed: accounts with one digit are emptied on the day after their last one."""
    held = balances(s, d)
    closing = held.where("length(coldkey) = 2").groupBy("coldkey").agg((F.max("timestamp_ms") + 86_400_000).alias("timestamp_ms")).withColumn("balance_rao", F.lit(0).cast("decimal(38,0)"))
    return ledger.emptied_for_good(held.unionByName(closing), t.labels(s, d))


# --- quality ----------------------------------------------------------------------------------------------------------

GAPS = "SELECT pair, before + 3600000 AS gap_start_ms, timestamp_ms - 3600000 AS gap_end_ms, CAST(round((timestamp_ms - before) / 3600000) AS BIGINT) - 1 AS missing FROM (SELECT pair, timestamp_ms, lag(timestamp_ms) OVER (PARTITION BY pair ORDER BY timestamp_ms) AS before FROM (SELECT DISTINCT pair, timestamp_ms FROM ticks)) WHERE timestamp_ms - before > 3600000"
VENUE_GAPS = GAPS.replace("SELECT pair, before", "SELECT exchange, pair, before").replace("(SELECT pair, timestamp_ms, lag", "(SELECT exchange, pair, timestamp_ms, lag").replace("PARTITION BY pair", "PARTITION BY exchange, pair").replace("DISTINCT pair", "DISTINCT exchange, pair")
VENUES = "SELECT DISTINCT exchange, pair FROM ticks UNION ALL SELECT 'v9', 'click'"


def hours(s, d):
    return t.ticks(s, d).select("exchange", "pair", "timestamp_ms")


def venues(s, d):
    return hours(s, d).select("exchange", "pair").distinct().unionByName(s.range(1).select(F.lit("v9").alias("exchange"), F.lit("click").alias("pair")))


register("w09_gaps", oracle(["ticks"], f"SELECT * FROM ({GAPS})"))(lambda s, d: quality.gaps(hours(s, d), HOUR, "pair"))
register("o02_largest_gaps", oracle(["ticks"], f"SELECT * FROM ({VENUE_GAPS}) ORDER BY missing DESC, exchange, pair, gap_start_ms, gap_end_ms LIMIT 10"))(
    lambda s, d: quality.largest_gaps(quality.gaps(hours(s, d), HOUR, "exchange", "pair"), 10)
)
register("d15_gap_log", oracle(["ticks"], """SELECT v.exchange, v.pair, CAST(1706745600000 AS BIGINT) AS run_at_ms, coalesce(r.n, 0) AS rows_fetched, g.gap_start_ms, g.gap_end_ms, coalesce(g.missing, 0) AS missing_buckets
    FROM venues v LEFT JOIN (SELECT exchange, pair, count(*) AS n FROM ticks GROUP BY 1, 2) r USING (exchange, pair) LEFT JOIN gaps g USING (exchange, pair)""", venues=VENUES, gaps=VENUE_GAPS))(
    lambda s, d: quality.gap_log(hours(s, d), venues(s, d), HOUR, 1_706_745_600_000)
)
register("d16_coverage", oracle(["ticks"], """SELECT v.exchange, v.pair, r.first_ms, r.last_ms, coalesce(r.n, 0) AS rows, coalesce(r.months, 0) AS months, coalesce(g.gaps, 0) AS gaps,
    CAST(coalesce(g.missing, 0) AS BIGINT) AS missing, CASE WHEN r.n IS NULL THEN 'NO DATA' ELSE 'OK' END AS status FROM venues v
    LEFT JOIN (SELECT exchange, pair, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms, count(*) AS n, count(DISTINCT strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m')) AS months FROM ticks GROUP BY 1, 2) r USING (exchange, pair)
    LEFT JOIN (SELECT exchange, pair, count(*) AS gaps, sum(missing) AS missing FROM gaps GROUP BY 1, 2) g USING (exchange, pair)""", venues=VENUES, gaps=VENUE_GAPS))(
    lambda s, d: quality.coverage(hours(s, d), venues(s, d), quality.gaps(hours(s, d), HOUR, "exchange", "pair"))
)
register("w10_version_segments", oracle(["stamps"], "SELECT min(block_number) AS from_block, max(block_number) AS to_block, spec_version FROM (SELECT block_number, max(spec_version) AS spec_version FROM stamps GROUP BY 1) GROUP BY 3"))(
    lambda s, d: quality.segments(chain.canonical_blocks(t.stamps(s, d)), "block_number", "spec_version")
)
register("w10_islands", oracle(["ticks"], """SELECT pair, up, min(event_id) AS first, max(event_id) AS last, count(*) AS rows FROM (SELECT *, sum(fresh) OVER (PARTITION BY pair ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n FROM
    (SELECT *, CASE WHEN lag(up) OVER (PARTITION BY pair ORDER BY event_id) IS DISTINCT FROM up THEN 1 ELSE 0 END AS fresh FROM (SELECT pair, event_id, close > 5000 AS up FROM ticks))) GROUP BY pair, n, up"""))(
    lambda s, d: quality.islands(t.ticks(s, d).select("pair", "event_id", (F.col("close") > 5000).alias("up")), ["pair"], "event_id", "up")
)
register("u05_changed_blocks", oracle(["transfers"], """SELECT block_number, CAST(sum(r) AS BIGINT) AS removed, CAST(sum(a) AS BIGINT) AS added FROM (
    SELECT block_number, 1 AS r, 0 AS a FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after) UNION ALL SELECT block_number, 0, 1 FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before)) GROUP BY 1""",
    before="SELECT block_number, event_index, amount_rao FROM transfers", after="SELECT block_number, event_index, CASE WHEN block_number % 97 = 3 THEN amount_rao + 1 ELSE amount_rao END FROM transfers WHERE block_number % 101 <> 5"))(
    lambda s, d: (lambda before: quality.changed_keys(before, before.where("block_number % 101 <> 5").withColumn("amount_rao", F.when(F.col("block_number") % 97 == 3, F.col("amount_rao") + 1).otherwise(F.col("amount_rao"))), "block_number"))(
        longs(t.transfers(s, d).select("block_number", "event_index", "amount_rao"), "amount_rao")
    )
)

# --- raw blocks -------------------------------------------------------------------------------------------------------

register("d05_decode_plan", oracle(["stamps"], """SELECT block_number, spec_version AS stamped, coalesce(previous, spec_version) AS decode_spec, previous IS NOT NULL AS is_transition, versions > 1 AS is_conflict, false AS goes_back FROM
    (SELECT *, CASE WHEN lag(spec_version) OVER (ORDER BY block_number) <> spec_version THEN lag(spec_version) OVER (ORDER BY block_number) END AS previous FROM canonical) WHERE previous IS NOT NULL OR versions > 1""",
    canonical="SELECT block_number, max(spec_version) AS spec_version, count(DISTINCT spec_version) AS versions FROM stamps GROUP BY 1"))(
    lambda s, d: chain.checked_plan(t.stamps(s, d))
)
_GOOD = "block_number % 50 <> 7"
register("d06_transfers", oracle(["decoded"], f"SELECT block_number, event_index, timestamp_ms, u AS from_coldkey, o AS to_coldkey, amount_rao FROM decoded WHERE k = 0 AND {_GOOD}"))(
    lambda s, d: longs(chain.chain_silver(t.decoded(s, d))["transfers"], "amount_rao")
)
register("d06_balance_events", oracle(["decoded"], f"SELECT block_number, event_index, timestamp_ms, CASE k WHEN 1 THEN 'deposit' ELSE 'withdraw' END AS kind, u AS coldkey, amount_rao FROM decoded WHERE k IN (1, 2, 3) AND {_GOOD}"))(
    lambda s, d: longs(chain.chain_silver(t.decoded(s, d))["balance_events"], "amount_rao")
)
register("d06_stake_events", oracle(["decoded"], f"SELECT block_number, event_index, timestamp_ms, 'stakeAdded' AS kind, u AS hotkey, amount_rao FROM decoded WHERE k = 4 AND {_GOOD}"))(
    lambda s, d: longs(chain.chain_silver(t.decoded(s, d))["stake_events"], "amount_rao")
)
register("d06_bad_blocks", oracle(["decoded"], "SELECT DISTINCT block_number FROM decoded WHERE block_number % 50 = 7"))(lambda s, d: chain.chain_silver(t.decoded(s, d))["bad_blocks"])
register("j11_snapshot_dates", oracle(["transfers", "balance_events"], """SELECT s.block_number, (SELECT min(timestamp_ms) FROM (SELECT block_number, timestamp_ms FROM transfers UNION ALL SELECT block_number, timestamp_ms FROM balance_events) f WHERE f.block_number > s.block_number) AS timestamp_ms FROM snaps s""",
    snaps="SELECT o_orderkey AS block_number FROM orders WHERE o_orderkey % 2500 = 0"))(
    lambda s, d: chain.date_snapshots(t.table(s, d, "orders").where("o_orderkey % 2500 = 0").select(F.col("o_orderkey").alias("block_number")), t.transfers(s, d), t.balance_events(s, d))
)
register("x02_staked_accounts", oracle(["decoded"], """SELECT s.timestamp_ms, CAST(sum(net) OVER (ORDER BY s.timestamp_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
    FROM (SELECT unnest(generate_series((SELECT min(ts) FROM first_day), (SELECT max(ts) FROM first_day), 86400000)) AS timestamp_ms) s LEFT JOIN (SELECT first AS timestamp_ms, count(*) AS net FROM firsts GROUP BY 1) USING (timestamp_ms)""",
    first_day=f"SELECT u, timestamp_ms {D} AS ts, sum(amount_rao) AS a FROM decoded WHERE k = 4 AND {_GOOD} GROUP BY 1, 2",
    firsts="SELECT u, min(ts) AS first FROM first_day WHERE a > 0 GROUP BY 1"))(
    lambda s, d: (lambda stake: ledger.staked_accounts(stake, stake.select("hotkey", F.col("hotkey").alias("coldkey")).distinct()))(chain.chain_silver(t.decoded(s, d))["stake_events"])
)

# --- reconciliation ---------------------------------------------------------------------------------------------------

_TRUE = "SELECT coldkey, w, delta, sum(delta) OVER (PARTITION BY coldkey ORDER BY w ROWS UNBOUNDED PRECEDING) AS total FROM (SELECT coldkey, (block_number - lo) // 2000 AS w, sum(delta) AS delta FROM legs, bounds WHERE block_number < lo + (hi - lo + 1) // 2000 * 2000 GROUP BY 1, 2)"
_SEEN = "SELECT coldkey, w, delta, total + CASE WHEN (length(coldkey) + w) % 4 = 1 THEN 1 ELSE 0 END AS observed FROM truth"


def sizing(s, d):
    return reconcile.reconciliation_sizing(reconcile.account_touches(t.transfers(s, d), t.balance_events(s, d)), *block_range(s, d), 1000)


def observed_windows(s, d):
    from pyspark.sql import Window

    lo, hi = block_range(s, d)
    per = legs(s, d).where(F.col("block_number") < lo + (hi - lo + 1) // 2000 * 2000).groupBy("coldkey", F.floor((F.col("block_number") - lo) / 2000).alias("window_index")).agg(F.sum("delta").alias("delta"))
    total = F.sum("delta").over(Window.partitionBy("coldkey").orderBy("window_index").rowsBetween(Window.unboundedPreceding, 0))
    off = F.when((F.length("coldkey") + F.col("window_index")) % 4 == 1, 1).otherwise(0)
    return per.select("coldkey", "window_index", (total + off).cast("decimal(38,0)").alias("balance_rao"))


def checkpoints(s, d):
    return reconcile.reconcile_checkpoints(legs(s, d), observed_windows(s, d), *block_range(s, d), 2000)


def half_window(s, d):
    """The second half of all blocks, against what is observed ten blocks before their end."""
    (lo, hi), every = block_range(s, d), legs(s, d)
    middle = (lo + hi) // 2
    known, none, observed = (ledger.fold_balances(every.where(F.col("block_number") <= x)) for x in (middle, lo - 1, hi - 10))
    return longs(reconcile.reconcile_window(every, middle + 1, hi, known, none, observed), "baseline", "delta", "expected", "observed")


_ROWS = "SELECT w AS window_index, coldkey, coalesce(lag(observed) OVER (PARTITION BY coldkey ORDER BY w), 0) AS baseline, delta, observed FROM seen"
register("d13_reconcile_checkpoints", oracle(["legs"], "SELECT window_index, coldkey, CAST(baseline AS BIGINT) AS baseline, CAST(delta AS BIGINT) AS delta, CAST(baseline + delta AS BIGINT) AS expected, CAST(observed AS BIGINT) AS observed, baseline + delta = observed AS matches FROM rows_", bounds=BOUNDS, truth=_TRUE, seen=_SEEN, rows_=_ROWS))(
    lambda s, d: longs(checkpoints(s, d), "baseline", "delta", "expected", "observed")
)
register("a21_checkpoint_summary", oracle(["legs"], "SELECT window_index, count(*) AS touched, count(*) FILTER (WHERE baseline + delta <> observed) AS mismatches FROM rows_ GROUP BY 1", bounds=BOUNDS, truth=_TRUE, seen=_SEEN, rows_=_ROWS))(
    lambda s, d: reconcile.checkpoint_summary(checkpoints(s, d))
)
register("d12_reconcile_window", oracle(["legs"], """SELECT d.coldkey, CAST(coalesce(k.b, 0) AS BIGINT) AS baseline, CAST(d.delta AS BIGINT) AS delta, CAST(coalesce(k.b, 0) + d.delta AS BIGINT) AS expected,
    CAST(coalesce(o.b, 0) AS BIGINT) AS observed, coalesce(k.b, 0) + d.delta = coalesce(o.b, 0) AS matches FROM (SELECT coldkey, sum(delta) AS delta FROM legs, bounds WHERE block_number > (lo + hi) // 2 GROUP BY 1) d
    LEFT JOIN (SELECT coldkey, sum(delta) AS b FROM legs, bounds WHERE block_number <= (lo + hi) // 2 GROUP BY 1) k USING (coldkey)
    LEFT JOIN (SELECT coldkey, sum(delta) AS b FROM legs, bounds WHERE block_number <= hi - 10 GROUP BY 1) o USING (coldkey)""", bounds=BOUNDS))(
    lambda s, d: half_window(s, d)
)
register("d14_reconciliation_sizing", oracle(["legs"], """SELECT s.w AS window_index, coalesce(p.n, 0) AS touched, coalesce(f.n, 0) AS new, coalesce(p.n, 0) + coalesce(f.n, 0) + 3 AS calls
    FROM (SELECT unnest(generate_series(0, (SELECT (hi - lo) // 1000 FROM bounds))) AS w) s LEFT JOIN (SELECT w, count(*) AS n FROM keyed GROUP BY 1) p USING (w)
    LEFT JOIN (SELECT w, count(*) AS n FROM (SELECT coldkey, min(w) AS w FROM keyed GROUP BY 1) GROUP BY 1) f USING (w)""",
    touches="SELECT from_coldkey AS coldkey, block_number FROM transfers UNION ALL SELECT to_coldkey, block_number FROM transfers UNION ALL SELECT coldkey, block_number FROM balance_events",
    bounds=BOUNDS, keyed="SELECT DISTINCT coldkey, (block_number - lo) // 1000 AS w FROM touches, bounds"))(
    lambda s, d: sizing(s, d)
)


# --- registry and streams: run, written to the shared folder and read back ----------------------------------------------


_EXPORTED = [
    ("price_composite_usd_daily", 1, "m02_price_composite_daily"), ("price_composite_usd_weekly", 1, "m03_price_composite_weekly"), ("price_composite_btc_daily", 1, "m05_cross_rate_daily"),
    ("price_composite_btc_weekly", 1, "m06_cross_rate_weekly"), ("volume_usd_daily", 2, None), ("transfer_count_daily", 3, "m09_transfer_count"), ("transfer_count_protocol_daily", 1, "m10_transfer_count_protocol"),
    ("wallet_count_free_balance", 2, "m12_wallet_count"), ("wallet_count_dust_filtered", 2, "m13_wallet_count_dust"), ("social_trends_weekly", 1, "m14_trends_series"), ("exchange_balances_daily", 2, "m15_labelled_totals"),
]
_OWN = {None: oracle(["candles"], f"SELECT timestamp_ms {D} AS timestamp_ms, sum(quote_volume) AS value FROM candles WHERE exchange = 'O1' AND pair = 'A' GROUP BY 1")}
#: Each exported metric by its own oracle.
EXPORTED = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS metric, {version} AS version, timestamp_ms AS \"timestampMs\", coalesce(CAST(value AS DOUBLE), 0.0) AS value FROM ({_OWN.get(q) or ORACLES[q]})" for name, version, q in _EXPORTED
)


def registry_sources(s, d):
    from tidemark.plans.registry import empty

    candles = t.candles(s, d)
    return {
        "ohlcv_1m": candles, "transfers": t.transfers(s, d), "balance_events": t.balance_events(s, d), "account_snapshots": t.account_snapshots(s, d),
        "pallet_accounts": t.protocol(s, d), "exchange_labels": t.labels(s, d), "google_trends": t.trends(s, d), "stake_events": empty(s, "stake_events"),
    }


@register("d09_registry_export", EXPORTED)
def registry_export(s, d):
    """All metrics in dependency order, and what of them is exported, one row per point."""
    from tidemark.plans.metrics import metrics
    from tidemark.plans.registry import exported_points, materialise
    from tidemark.sources.workspace import shared_folder

    entries = metrics("A,R", "N", "O1", "A", "2-HIGH")
    done = materialise(s, entries, registry_sources(s, d), shared_folder(s, "gold"))
    return exported_points(done, entries).drop("position")


def _stream(s, d, name):
    """A stream of a table, be it one file or a folder of part files, and a folder for what is made of it."""
    from tidemark.sources.workspace import shared_folder
    from tidemark.streaming.streams import landed

    table, file = t.table(s, d, name), f"{name}.parquet"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    parts = [x.split("/") for x in table.inputFiles()]
    # A stream lists folders only, and its filter looks at the names of files: a single file is found through its parent.
    single = len(parts) == 1 and parts[0][-1] == file and parts[0][-2] != file
    rows = landed(s, d, schema, file) if single else landed(s, f"{d}/{file}", schema)
    return rows, shared_folder(s, f"stream-{name}")


@register("t01_incremental_transfers", oracle(["transfers"], "SELECT * FROM transfers"))
def incremental_transfers(s, d):
    from tidemark.streaming.streams import run_available

    rows, folder = _stream(s, d, "lineitem")
    account = lambda key, n: F.concat(F.lit("A"), F.pmod(key, F.lit(n)).cast("string"))
    silver = rows.select(
        F.col("l_orderkey").alias("block_number"), F.col("l_linenumber").cast("int").alias("event_index"), millis("l_shipdate").alias("timestamp_ms"),
        account("l_suppkey", 97).alias("from_coldkey"), account("l_partkey", 89).alias("to_coldkey"), t.cents("l_extendedprice").alias("amount_rao"),
    )
    run_available(silver, f"{folder}/table", f"{folder}/checkpoint")
    return s.read.schema(silver.schema).parquet(f"{folder}/table")


@register("t02_deduplicated_events", oracle(["ticks"], "SELECT DISTINCT pair, timestamp_ms FROM ticks"))
def deduplicated_events(s, d):
    from tidemark.streaming.streams import deduplicated, run_available

    rows, folder = _stream(s, d, "events")
    keys = rows.select(F.col("event_type").alias("pair"), (F.floor(millis("ts") / HOUR) * HOUR).cast("long").alias("timestamp_ms"))
    run_available(deduplicated(keys, ["pair", "timestamp_ms"], late="60 days"), f"{folder}/table", f"{folder}/checkpoint")
    return s.read.schema("pair string, timestamp_ms long").parquet(f"{folder}/table")


def _streamed_balances(s, d, receiver):
    from tidemark.streaming.streams import run_batches, running_balances

    rows, folder = _stream(s, d, "lineitem")
    amount = t.cents("l_extendedprice")
    both = F.explode(F.array(F.struct(_account("l_suppkey", 97).alias("coldkey"), (-amount).alias("delta")), F.struct(receiver.alias("coldkey"), amount.alias("delta"))))
    changes = running_balances(rows.select(both.alias("leg")).select("leg.*"))
    run_batches(changes, lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{folder}/table"), f"{folder}/checkpoint")
    kept = s.read.schema("coldkey string, balance_rao decimal(38,0), batch long").parquet(f"{folder}/table")
    return longs(kept.groupBy("coldkey").agg(F.max_by("balance_rao", "batch").alias("balance_rao")), "balance_rao")


def _account(key: str, n: int):
    return F.concat(F.lit("A"), F.pmod(key, F.lit(n)).cast("string"))


def _streamed_oracle(receiver: str) -> str:
    return oracle(["transfers"], f"SELECT coldkey, CAST(sum(delta) AS BIGINT) AS balance_rao FROM (SELECT from_coldkey AS coldkey, -amount_rao AS delta FROM transfers UNION ALL SELECT {receiver}, amount_rao FROM transfers) GROUP BY 1")


register("t05_running_balances", _streamed_oracle("to_coldkey"))(lambda s, d: _streamed_balances(s, d, _account("l_partkey", 89)))
#: One account receives everything: it has half of all legs.
register("t05_hot_account", _streamed_oracle("'hot'"))(lambda s, d: _streamed_balances(s, d, F.lit("hot")))


@register("t04_daily_figures", """WITH c AS (SELECT l_returnflag AS pair, epoch_ms(l_shipdate) AS timestamp_ms, CAST(round(l_extendedprice * 100) AS BIGINT) AS close FROM lineitem)
    SELECT timestamp_ms // 86400000 * 86400000 AS timestamp_ms, pair, arg_max(close, (timestamp_ms, close)) AS close, CAST(sum(close) AS BIGINT) AS volume FROM c GROUP BY 1, 2
    HAVING timestamp_ms // 86400000 * 86400000 + 86400000 <= (SELECT max(timestamp_ms) - 172800000 FROM c)""")
def streamed_daily_figures(s, d):
    """Closes and volumes of the days that the watermark has passed; the last days stay open."""
    from tidemark.streaming.streams import daily_figures, run_available

    rows, folder = _stream(s, d, "lineitem")
    candles = rows.select(F.col("l_returnflag").alias("pair"), millis("l_shipdate").alias("timestamp_ms"), t.cents("l_extendedprice").alias("close"), t.cents("l_extendedprice").alias("quote_volume"))
    run_available(daily_figures(candles), f"{folder}/table", f"{folder}/checkpoint")
    return s.read.schema("timestamp_ms long, pair string, close long, volume long").parquet(f"{folder}/table")


@register("t06_gap_alarms", oracle(["ticks"], f"SELECT pair AS series, gap_start_ms, gap_end_ms, missing FROM ({GAPS})"))
def streamed_gap_alarms(s, d):
    from tidemark.streaming.streams import gap_alarms, run_available

    rows, folder = _stream(s, d, "events")
    ticks = rows.select(F.col("event_type").alias("series"), (F.floor(millis("ts") / HOUR) * HOUR).cast("long").alias("timestamp_ms"))
    run_available(gap_alarms(ticks, HOUR, "60 days"), f"{folder}/table", f"{folder}/checkpoint")
    return s.read.schema("series string, gap_start_ms long, gap_end_ms long, missing long").parquet(f"{folder}/table")


register("a10_canonical_blocks", oracle(["stamps"], "SELECT block_number, max(spec_version) AS spec_version, count(DISTINCT spec_version) AS versions FROM stamps GROUP BY 1"))(
    lambda s, d: chain.canonical_blocks(t.stamps(s, d))
)
register("a11_block_range", oracle(["transfers"], "SELECT min(block_number) AS first_block, max(block_number) AS last_block FROM transfers"))(
    lambda s, d: t.transfers(s, d).agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"))
)
register("p09_row_fingerprints", oracle(["transfers"], "SELECT block_number, concat_ws('|', block_number, event_index, coalesce(timestamp_ms, -1), from_coldkey, to_coldkey, amount_rao) AS fingerprint FROM transfers"))(
    lambda s, d: t.transfers(s, d).select("block_number", F.concat_ws("|", "block_number", "event_index", F.coalesce("timestamp_ms", F.lit(-1)), "from_coldkey", "to_coldkey", "amount_rao").alias("fingerprint"))
)
register("p10_window_index", oracle(["transfers"], "SELECT CAST(floor((block_number - 1) / 700) AS BIGINT) AS window_index, count(*) AS rows FROM transfers GROUP BY 1"))(
    lambda s, d: t.transfers(s, d).groupBy(reconcile.window_index("block_number", 1, 700).alias("window_index")).agg(F.count("*").alias("rows"))
)
register("u03_account_touches", oracle(["transfers", "balance_events"], "SELECT coldkey, count(*) AS touches FROM (SELECT from_coldkey AS coldkey FROM transfers UNION ALL SELECT to_coldkey FROM transfers UNION ALL SELECT coldkey FROM balance_events) GROUP BY 1"))(
    lambda s, d: reconcile.account_touches(t.transfers(s, d), t.balance_events(s, d)).groupBy("coldkey").agg(F.count("*").alias("touches"))
)
register("j13_new_accounts", oracle(["transfers", "balance_events"], "SELECT DISTINCT coldkey FROM balance_events WHERE coldkey NOT IN (SELECT to_coldkey FROM transfers)"))(
    lambda s, d: t.balance_events(s, d).select("coldkey").distinct().join(t.transfers(s, d).select(F.col("to_coldkey").alias("coldkey")).distinct(), "coldkey", "left_anti")
)


# Further queries, which write and read back.
from tidemark.plans import profit, roundtrips  # noqa: E402, F401
