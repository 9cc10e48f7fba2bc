"""The fifteen metrics of the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ledger, prices
from tidemark.plans.registry import Metric


def _pairs(views, params):
    return views["ohlcv_1m"].where(F.col("pair").isin(*params["pairs"].split(",")))


def metrics(usd: str = "TAOUSD,TAOUSDT", reference: str = "BTCUSD,BTCUSDT", venue: str = "binance", venue_pair: str = "TAOUSDT", keyword: str = "bittensor", dust: int = 10_000_000) -> list[Metric]:
    """All entries; the parameters name pairs, venues and thresholds."""
    close = lambda source: lambda v, p: prices.daily_close(v[source])
    weekly = lambda source: lambda v, p: prices.weekly_close(v[source])
    legs = lambda v: ledger.signed_legs(v["transfers"], v["balance_events"], v["account_snapshots"])
    return [
        Metric("price_composite_usd", 3, "Volume-weighted price per minute", build=lambda v, p: prices.vwap(_pairs(v, p)), params={"pairs": usd}, export=False, reads=("ohlcv_1m",)),
        Metric("price_composite_usd_daily", 1, "Last price of each day", build=close("price_composite_usd"), depends_on=("price_composite_usd",), reads=()),
        Metric("price_composite_usd_weekly", 1, "Last price of each Monday week", build=weekly("price_composite_usd_daily"), depends_on=("price_composite_usd_daily",), reads=()),
        Metric("reference_btc_usd", 2, "Volume-weighted reference price per minute", build=lambda v, p: prices.vwap(_pairs(v, p)), params={"pairs": reference}, export=False, reads=("ohlcv_1m",)),
        Metric("price_composite_btc", 3, "Implied cross rate per minute", build=lambda v, p: prices.cross_rate(v["price_composite_usd"], v["reference_btc_usd"]), depends_on=("price_composite_usd", "reference_btc_usd"), export=False, reads=()),
        Metric("price_composite_btc_daily", 1, "Last cross rate of each day", build=close("price_composite_btc"), depends_on=("price_composite_btc",), reads=()),
        Metric("price_composite_btc_weekly", 1, "Last cross rate of each Monday week", build=weekly("price_composite_btc_daily"), depends_on=("price_composite_btc_daily",), reads=()),
        Metric(
            "volume_usd_daily", 2, "Quote volume of one venue per day",
            sql="SELECT (timestamp_ms div 86400000) * 86400000 AS timestamp_ms, sum(quote_volume) AS value FROM ohlcv_1m WHERE exchange = :venue AND pair = :pair GROUP BY 1",
            params={"venue": venue, "pair": venue_pair}, reads=("ohlcv_1m",),
        ),
        Metric("transfer_count_daily", 3, "Transfers between ordinary accounts per day", build=lambda v, p: ledger.daily_count(ledger.user_transfers(v["transfers"], v["pallet_accounts"])), reads=("transfers", "pallet_accounts")),
        Metric("transfer_count_protocol_daily", 1, "Transfers with a protocol account per day", build=lambda v, p: ledger.daily_count(ledger.protocol_transfers(v["transfers"], v["pallet_accounts"])), reads=("transfers", "pallet_accounts")),
        Metric("account_balances_daily", 3, "End-of-day balance of each account with activity", build=lambda v, p: ledger.daily_balances(v["legs"] if "legs" in v else legs(v)), export=False, shard_by="coldkey", keyed=lambda v: {"legs": legs(v)}, reads=("transfers", "balance_events", "account_snapshots")),
        Metric("wallet_count_free_balance", 2, "Accounts above zero per day", build=lambda v, p: ledger.holder_counts(v["account_balances_daily"], p["above"]), params={"above": 0}, depends_on=("account_balances_daily",), reads=()),
        Metric("wallet_count_dust_filtered", 2, "Accounts above the dust threshold per day", build=lambda v, p: ledger.holder_counts(v["account_balances_daily"], p["above"]), params={"above": dust}, depends_on=("account_balances_daily",), reads=()),
        Metric("social_trends_weekly", 1, "One keyword's search interest", sql="SELECT week_start_ms AS timestamp_ms, value FROM google_trends WHERE keyword = :keyword", params={"keyword": keyword}, reads=("google_trends",)),
        Metric("exchange_balances_daily", 2, "Total of the labelled accounts per day", build=lambda v, p: ledger.labelled_totals(v["account_balances_daily"], v["exchange_labels"]), depends_on=("account_balances_daily",), reads=("exchange_labels",)),
    ]
