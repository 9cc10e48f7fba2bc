"""Pieces that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A word is a run of characters other than space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(data: bytes | None) -> list[bytes]:
    """Words of UTF-8 text; bytes.split() without arguments splits at exactly WORD's separators."""
    return data.split() if data else []


def text_bytes(column: str | Column) -> Column:
    """The text as UTF-8 bytes, null read as empty: spares Python the decoding."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("binary"), F.lit(b""))


def schema_with(df: DataFrame, name: str, kind) -> StructType:
    """df's schema and one more field."""
    return StructType([*df.schema.fields, StructField(name, kind)])


def in_slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows of a batch, as many at a time as have about `most` bytes in a column, and that column's values."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for k, n in enumerate(sizes):
        size += n
        if size >= most or k == len(sizes) - 1:
            part = batch.slice(start, k + 1 - start)
            yield part, part.column(column).to_pylist()
            start, size = k + 1, 0


def byte_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, as many at a time as have at most `most` bytes in a column without nulls, or one row that has more."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Only where that setting is missing, as on a laptop, is a temporary folder used; a cluster without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/tidemark-shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: later stages reread it, and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of a graph: edges (a, b) of longs give (node, component), the smallest node that each node reaches.

    Alternates two steps until nothing changes: every node's larger neighbours move to its smallest neighbour, then
    its smaller neighbours do. The number of rounds grows with the logarithm of a component's diameter, each round is
    a grouped minimum (combined before the shuffle) and a join that adaptive execution may split, and every round
    ends in a checkpoint. The joins shuffle: tables that grow with the graph, broadcast once or twice a round, would
    gather in the driver until it collects its garbage. Nodes without edges are not returned; an empty edge table gives an empty result.
    """
    pairs = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
