"""Reading and writing of the persisted tables on any Hadoop path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tidemark.functions.time_buckets import month_key
from tidemark.sources.files import Files
from tidemark.sources.schemas import SCHEMAS

#: The most tasks that list a table's folders; Spark's 10,000 are one for each folder of most tables.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Rows that a task compares.
COMPARED = 500_000


def read(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A persisted table by its fixed schema; local paths, s3a:// and other Hadoop paths alike."""
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table by its schema, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A persisted table, or an empty one of its schema where nothing was written yet."""
    return read_table_or_empty(spark, path, SCHEMAS[name])


def read_partitions(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table of very many partition folders: a few tasks for each core list them, instead of one task for each folder."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, 4 * spark.sparkContext.defaultParallelism)
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(LISTING, before)


def read_blocks(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, blocks: Iterable[int] | None = None) -> DataFrame:
    """Raw block rows in a range or a list; the conditions reach the Parquet scan."""
    found = read(spark, "chain_events", path)
    if first is not None:
        found = found.where(F.col("block_number") >= first)
    if last is not None:
        found = found.where(F.col("block_number") <= last)
    return found if blocks is None else found.where(F.col("block_number").isin(list(blocks)))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Exchange labels from a JSON file that holds an array."""
    return spark.read.schema(SCHEMAS["exchange_labels"]).option("multiLine", True).json(path)


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Overwrite a table, compressed and sorted within its files."""
    df.sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append to a log table."""
    df.write.mode("append").parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    """Append bad records, such as blocks that could not be decoded, as JSON lines."""
    df.write.mode("append").json(path)


def overwrite_partitions(df: DataFrame, path: str, *by: str, order: Iterable[str] = ()) -> None:
    """Replace exactly the partitions that df has rows of; their files are sorted by `order`.

    The sort comes after the exchange and begins with the partition columns, so the writer keeps it. As a write takes its
    time by folders and not by bytes, the number of tasks is the session's: small ones aren't united to one for each core.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(tasks, *by).sortWithinPartitions(*by, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def out_of_order(df: DataFrame, *order: str) -> DataFrame:
    """(file, rows, out_of_order): how many rows of each file of a table come before an earlier one, by their place in the file."""
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = F.lag(F.struct(*order)).over(Window.partitionBy("_file").orderBy("_row"))
    return placed.withColumn("_back", before > F.struct(*order)).groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("rows"), F.count_if("_back").alias("out_of_order"))


def write_ranges(df: DataFrame, path: str, number: str, size: int, name: str = "first") -> None:
    """Raw rows into one partition for each range of `size` numbers, named by the range's first one: a rerun replaces it."""
    first = (F.floor(F.col(number) / size) * size).cast("long")
    overwrite_partitions(df.withColumn(name, first), path, name)


def plain_columns(df: DataFrame) -> list[Column]:
    """df's columns, decimals of more than 18 digits without a fraction as longs; those beyond a long stay digits in a column of their own.

    Equal rows have equal columns and others don't. Such a decimal is an object wherever it is read, hashed or copied.
    """
    found = []
    for k, field in enumerate(df.schema.fields):
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, DecimalType) and kind.scale == 0 and kind.precision > 18:
            number = column.try_cast("long")
            found.append(F.when(number.isNull(), column).cast("string").alias(f"_wide{k}"))
            column = number
        found.append(column.alias(f"_{k}"))
    return found


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, equally often.

    How many rows there are and sums of their digests tell most tables apart without a shuffle; where these agree, the
    rows themselves are compared, each table once, by as many tasks as keep COMPARED rows or so in each.
    """
    both = a.select(*plain_columns(a), F.lit(1).alias("_side")).union(b.select(*plain_columns(b), F.lit(-1).alias("_side")))
    columns = [c for c in both.columns if c != "_side"]
    digest = F.xxhash64(*columns)
    halves = F.sum(F.shiftrightunsigned(digest, 32)), F.sum(digest.bitwiseAND(F.lit(0xFFFFFFFF)))
    sums = both.groupBy("_side").agg(F.count("*").alias("n"), F.bit_xor(digest), *halves).collect()
    if len({tuple(r[1:]) for r in sums}) > 1 or len(sums) == 1:
        return False
    tasks = 1 + sum(r["n"] for r in sums) // COMPARED
    return both.repartition(tasks, *columns).groupBy(*columns).agg(F.sum("_side").alias("_more")).where("_more <> 0").count() == 0


def write_if_changed(df: DataFrame, name: str, path: str) -> bool:
    """Overwrite the table only if its rows change; tells whether it did."""
    old = read_or_empty(df.sparkSession, name, path)
    if df.isEmpty() if old.isEmpty() else same_rows(df, old):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def latest_by_key(old: DataFrame, new: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """One row per key of old and new: the new one, and among equals the one with the largest version.

    Rows with a null in a key column are told apart as if null were a value.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = [F.col("_new").desc(), *([F.col(version).desc_nulls_last()] if version else []), *[F.col(c).desc_nulls_last() for c in old.columns if c not in keys]]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return both.withColumn("_nth", nth).where("_nth = 1").drop("_nth", "_new")


def upsert_candles(new: DataFrame, path: str) -> None:
    """Merge candles into their (exchange, pair, month) partitions; a new row replaces the old one of its minute.

    Only the partitions that new rows fall into are read and written, in one job: Spark puts the new files in place of the
    old ones when all of its tasks have ended, so these can be read until then. Which partitions those are is asked only
    if the table has any. Files are sorted by time.
    """
    spark, by = new.sparkSession, ["exchange", "pair", "month"]
    keyed = new.withColumn("month", month_key("timestamp_ms"))
    if Files(spark, path).exists(path):
        old = spark.read.schema(SCHEMAS["ohlcv_1m"] + ", month string").parquet(path)
        old = old.join(keyed.select(*by).distinct(), by, "left_semi").select(*keyed.columns)
    else:
        old = keyed.where("false")
    # The time comes first, as a sort tells most rows apart by its first column alone.
    overwrite_partitions(latest_by_key(old, keyed, ["timestamp_ms", "exchange", "pair"]), path, *by, order=["timestamp_ms"])
