"""The supplied tables in the shape of candles, ledgers and raw blocks.

Each view is given twice, as a DataFrame and as DuckDB SQL, by the same integer arithmetic. Money is in whole cents, so
sums don't depend on their order; a candle's minute comes from its order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time_buckets import HOUR, bucket, div, millis, week
from tidemark.sources.schemas import RAO


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def candles(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_linestatus", F.pmod("l_suppkey", F.lit(5)).cast("string")).alias("exchange"), F.col("l_returnflag").alias("pair"),
        (millis("l_shipdate") + F.pmod("l_orderkey", F.lit(1440)) * 60_000).cast("long").alias("timestamp_ms"),
        F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("long").alias("close"),
        F.col("l_quantity").cast("long").alias("base_volume"), cents("l_extendedprice").alias("quote_volume"),
    )


def ticks(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pair"), F.concat(F.lit("v"), F.pmod("user_id", F.lit(5)).cast("string")).alias("exchange"),
        bucket(millis("ts"), HOUR).alias("timestamp_ms"), millis("ts").alias("at_ms"), cents("value").alias("close"), "event_id",
    )


def account(key):
    return F.concat(F.lit("A"), key.cast("string"))


def transfers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("block_number"), F.col("l_linenumber").cast("int").alias("event_index"), millis("l_shipdate").alias("timestamp_ms"),
        account(F.pmod("l_suppkey", F.lit(97))).alias("from_coldkey"), account(F.pmod("l_partkey", F.lit(89))).alias("to_coldkey"), cents("l_extendedprice").cast(RAO).alias("amount_rao"),
    )


def balance_events(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("block_number"), F.lit(0).alias("event_index"), millis("o_orderdate").alias("timestamp_ms"),
        F.when(F.col("o_orderstatus") == "O", "deposit").otherwise("withdraw").alias("kind"), account(F.pmod("o_custkey", F.lit(97))).alias("coldkey"), cents("o_totalprice").cast(RAO).alias("amount_rao"),
    )


def account_snapshots(spark, sf_dir):
    per = table(spark, sf_dir, "customer").groupBy(account(F.pmod("c_custkey", F.lit(97))).alias("coldkey")).agg(F.sum(cents("c_acctbal")).cast(RAO).alias("free_rao"))
    start = table(spark, sf_dir, "orders").agg(F.min(millis("o_orderdate")).alias("timestamp_ms"))
    return per.crossJoin(start).select(F.lit(0).cast("long").alias("block_number"), "timestamp_ms", "coldkey", "free_rao", F.lit(0).cast(RAO).alias("reserved_rao"))


def protocol(spark, sf_dir):
    asia = table(spark, sf_dir, "region").where("r_name = 'ASIA'").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    return table(spark, sf_dir, "supplier").join(asia, F.col("s_nationkey") == F.col("n_nationkey")).select(account(F.pmod("s_suppkey", F.lit(97))).alias("coldkey")).distinct().where("length(coldkey) = 2")


def labels(spark, sf_dir):
    named = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return named.where("s_suppkey <= 10").select(account(F.col("s_suppkey")).alias("coldkey"), F.col("n_name").alias("exchange"))


def trends(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("keyword"), week(millis("o_orderdate")).alias("week_start_ms"), cents("o_totalprice").alias("value"), F.col("o_orderkey").alias("row_id"),
        millis(F.date_trunc("month", F.col("o_orderdate"))).alias("fetched_at_ms"),
    )


def stamps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    own = orders.select(F.col("o_orderkey").alias("block_number"), div(F.col("o_orderkey"), 1000).cast("int").alias("spec_version"))
    return own.unionByName(own.where(F.pmod("block_number", F.lit(1000)) == 999).withColumn("spec_version", F.col("spec_version") + 1))


def decoded(spark, sf_dir):
    """Decoded blocks of up to eight events; every fiftieth block could not be decoded."""
    user, amount = F.concat(F.lit("U"), F.col("user_id").cast("string")), cents("value").cast("string")
    other = F.concat(F.lit("U"), F.pmod(F.col("user_id") * 7 + 1, F.lit(500)).cast("string"))
    kind = F.pmod("event_id", F.lit(6))
    event = (
        F.when(kind == 0, F.struct(F.lit("balances").alias("section"), F.lit("Transfer").alias("method"), F.array(user, other, amount).alias("data")))
        .when(kind == 1, F.struct(F.lit("Balances").alias("section"), F.lit("Deposit").alias("method"), F.array(user, amount).alias("data")))
        .when(kind == 2, F.struct(F.lit("balances").alias("section"), F.lit("Withdraw").alias("method"), F.array(user, amount).alias("data")))
        .when(kind == 3, F.struct(F.lit("balances").alias("section"), F.lit("DustLost").alias("method"), F.array(user, amount).alias("data")))
        .when(kind == 4, F.struct(F.lit("subtensorModule").alias("section"), F.lit("StakeAdded").alias("method"), F.array(user, amount).alias("data")))
        .otherwise(F.struct(F.lit("subtensorModule").alias("section"), F.lit("StakeRemoved").alias("method"), F.array(user, amount, F.lit("1")).alias("data")))
    )
    rows = table(spark, sf_dir, "events").select(div(F.col("event_id"), 8).cast("long").alias("block_number"), "event_id", millis("ts").alias("ms"), event.alias("e"))
    blocks = rows.groupBy("block_number").agg(F.min("ms").alias("timestamp_ms"), F.sort_array(F.collect_list(F.struct("event_id", "e"))).alias("found"))
    listed = F.when(F.pmod("block_number", F.lit(50)) != 7, F.transform("found", lambda x: x["e"]))
    return blocks.select("block_number", "timestamp_ms", F.lit(1).alias("spec_version"), listed.alias("events"))


#: The same views for DuckDB.
SQL = {
    "candles": """SELECT l_linestatus || CAST(l_suppkey % 5 AS VARCHAR) AS exchange, l_returnflag AS pair,
        epoch_ms(l_shipdate) + (l_orderkey % 1440) * 60000 AS timestamp_ms, CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS close,
        CAST(l_quantity AS BIGINT) AS base_volume, CAST(round(l_extendedprice * 100) AS BIGINT) AS quote_volume FROM lineitem""",
    "ticks": """SELECT event_type AS pair, 'v' || CAST(user_id % 5 AS VARCHAR) AS exchange, epoch_us(ts) // 1000 // 3600000 * 3600000 AS timestamp_ms,
        epoch_us(ts) // 1000 AS at_ms, CAST(round(value * 100) AS BIGINT) AS close, event_id FROM events""",
    "transfers": """SELECT l_orderkey AS block_number, l_linenumber AS event_index, epoch_ms(l_shipdate) AS timestamp_ms,
        'A' || CAST(l_suppkey % 97 AS VARCHAR) AS from_coldkey, 'A' || CAST(l_partkey % 89 AS VARCHAR) AS to_coldkey,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_rao FROM lineitem""",
    "balance_events": """SELECT o_orderkey AS block_number, 0 AS event_index, epoch_ms(o_orderdate) AS timestamp_ms,
        CASE WHEN o_orderstatus = 'O' THEN 'deposit' ELSE 'withdraw' END AS kind, 'A' || CAST(o_custkey % 97 AS VARCHAR) AS coldkey,
        CAST(round(o_totalprice * 100) AS BIGINT) AS amount_rao FROM orders""",
    "account_snapshots": """SELECT 0 AS block_number, (SELECT min(epoch_ms(o_orderdate)) FROM orders) AS timestamp_ms,
        'A' || CAST(c_custkey % 97 AS VARCHAR) AS coldkey, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS free_rao, 0 AS reserved_rao FROM customer GROUP BY 3""",
    "protocol": """SELECT DISTINCT 'A' || CAST(s_suppkey % 97 AS VARCHAR) AS coldkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND s_suppkey % 97 < 10""",
    "labels_": "SELECT 'A' || CAST(s_suppkey AS VARCHAR) AS coldkey, n_name AS exchange FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey <= 10",
    "trends": """SELECT o_orderpriority AS keyword, (epoch_ms(o_orderdate) + 259200000) // 604800000 * 604800000 - 259200000 AS week_start_ms,
        CAST(round(o_totalprice * 100) AS BIGINT) AS value, o_orderkey AS row_id, epoch_ms(CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)) AS fetched_at_ms FROM orders""",
    "stamps": """SELECT o_orderkey AS block_number, CAST(o_orderkey // 1000 AS INTEGER) AS spec_version FROM orders
        UNION ALL SELECT o_orderkey, CAST(o_orderkey // 1000 + 1 AS INTEGER) FROM orders WHERE o_orderkey % 1000 = 999""",
    "decoded": """SELECT event_id // 8 AS block_number, CAST(row_number() OVER (PARTITION BY event_id // 8 ORDER BY event_id) - 1 AS INTEGER) AS event_index,
        min(epoch_us(ts) // 1000) OVER (PARTITION BY event_id // 8) AS timestamp_ms, event_id % 6 AS k, 'U' || CAST(user_id AS VARCHAR) AS u,
        'U' || CAST((user_id * 7 + 1) % 500 AS VARCHAR) AS o, CAST(round(value * 100) AS BIGINT) AS amount_rao FROM events""",
    "legs": """SELECT from_coldkey AS coldkey, block_number, timestamp_ms, -amount_rao AS delta FROM transfers
        UNION ALL SELECT to_coldkey, block_number, timestamp_ms, amount_rao FROM transfers
        UNION ALL SELECT coldkey, block_number, timestamp_ms, CASE WHEN kind = 'deposit' THEN amount_rao ELSE -amount_rao END FROM balance_events""",
    "seeded": """SELECT * FROM legs UNION ALL SELECT coldkey, block_number, timestamp_ms, free_rao + reserved_rao FROM account_snapshots
        WHERE block_number = 0 AND timestamp_ms IS NOT NULL AND free_rao + reserved_rao <> 0""",
    "balances": """SELECT coldkey, ts AS timestamp_ms, sum(d) OVER (PARTITION BY coldkey ORDER BY ts ROWS UNBOUNDED PRECEDING) AS balance_rao
        FROM (SELECT coldkey, timestamp_ms // 86400000 * 86400000 AS ts, sum(delta) AS d FROM seeded GROUP BY 1, 2)""",
    "usd": """SELECT timestamp_ms, sum(close * base_volume)::DOUBLE / sum(base_volume)::DOUBLE AS value FROM candles
        WHERE pair IN ('A', 'R') AND base_volume > 0 GROUP BY 1""",
    "reference": """SELECT timestamp_ms, sum(close * base_volume)::DOUBLE / sum(base_volume)::DOUBLE AS value FROM candles
        WHERE pair = 'N' AND base_volume > 0 GROUP BY 1""",
    "btc": "SELECT a.timestamp_ms, a.value / b.value AS value FROM usd a JOIN reference b USING (timestamp_ms) WHERE b.value <> 0",
}
NEEDS = {
    "legs": ["transfers", "balance_events"], "seeded": ["legs", "account_snapshots"], "balances": ["seeded"],
    "usd": ["candles"], "reference": ["candles"], "btc": ["usd", "reference"],
}


def oracle(views: list[str], body: str, **more: str) -> str:
    """DuckDB SQL: the named views and what they need, further common tables, and the final SELECT."""
    found: dict[str, str] = {}

    def add(name):
        for n in NEEDS.get(name, []):
            add(n)
        found[name] = SQL[name]

    for v in views:
        add(v)
    found |= more
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in found.items()) + "\n" + body
