"""Token ids of documents as ORC files: written in the order of doc_id, read back by stripes.

A file row is a document's ids, or one part of them if it is long. ORC keeps the integers as runs and bit-packed
stretches, a row index with least and largest values of every few thousand rows, and a Bloom filter on doc_id, so a
reader that asks for some documents skips stripes and row groups by their metadata, and one that asks for all of them
reads the stripes of a file in parallel. Every row says how many ids of its file come before its document; a table of
one row for each file (`shards`) says how many ids come before the file.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_slices
from tidemark.llm.pieces import SPACE, Pieces

#: Ids in one file row, and rows in one row group of the index.
PART, GROUP = 65_536, 1_000
#: Pieces of text that a worker remembers the ids of, characters that the tokenizer gets as one text, and texts in a call.
MOST_PIECES, JOINED, CALL = 3 << 18, 2_000, 64
#: Bytes of text that are cut into pieces at a time.
SLICE = 6 << 20

SCHEMA = "doc_id long, doc_at long, n_tokens long, part int, ids array<int>"


class Encoder(Pieces):
    """The tokenizers library behind a table of pieces of text: new pieces are given to it once, many at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        super().__init__([t.content for t in self.library.get_added_tokens_decoder().values()], MOST_PIECES)
        # In the byte alphabet of the vocabulary, these two characters stand for a space and a line feed.
        self.begins = np.zeros(max(self.library.get_vocab(with_added_tokens=True).values()) + 1, bool)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.begins[i] = token[0] in "\u0120\u010a"
        narrow = SPACE.replace("\\x{", "\\u{")
        narrow = re.sub(r"\\u\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", narrow)
        self.pieces = re.compile(f"{narrow}*{narrow.replace('[', '[^', 1)}+|{narrow}+")
        # Pieces that start with one space or line feed, after which there is something else.
        self.plain = re.compile(r"\n?(?!\0|\s).", re.DOTALL)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, keys: list[str]) -> None:
        """Give new pieces to the library: those that start with one space or line feed joined, the others one by one."""
        plain, alone, groups, size = self.plain.match, [], [[]], 0
        for key in keys:
            if plain(key):
                groups[-1].append(key)
                size += len(key)
                if size >= JOINED:
                    groups.append([])
                    size = 0
            else:
                alone.append(key)
        for start in range(0, len(groups), CALL):
            some = [group for group in groups[start : start + CALL] if group]
            for group, ids in zip(some, self._encode(["".join([x if x[0] == "\n" else " " + x for x in group]) for group in some])):
                ids = np.array(ids, np.int32)
                starts = np.flatnonzero(self.begins[ids])
                if len(starts) == len(group) and starts[0] == 0:
                    self.new.keep(group, ids, np.diff(starts, append=len(ids)))
                else:  # a space or line feed inside of a piece
                    alone += group
        for start in range(0, len(alone), CALL):
            some = alone[start : start + CALL]
            found = self._encode([self.piece(key) for key in some])
            self.new.keep(some, np.array([i for ids in found for i in ids], np.int32), np.array([len(ids) for ids in found]))

    def _of_pieces(self, pieces: list[str]) -> np.ndarray:
        numbers = self.numbers(["\0" + x for x in pieces])  # may begin a new table
        return self.new.gathered(numbers)[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts one after another, and where each text's end."""
        odd = self.is_odd(texts)
        if not odd.any():
            return self.encode_plain(texts)
        ids, ends = self.encode_plain(texts.filter(pa.array(~odd)))
        plain = iter(np.split(ids, ends[:-1]))
        found = [self._of_pieces(self.pieces.findall(t)) if o else next(plain) for t, o in zip(texts.to_pylist(), odd)]
        return np.concatenate(found), np.cumsum([len(x) for x in found])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return Encoder(path)


def encoded(ordered: DataFrame, path: str, end_id: int) -> DataFrame:
    """File rows (doc_id, doc_at, n_tokens, part, ids) of (doc_id, text) rows, partition by partition in their order."""

    def run(batches):
        coder, before = encoder(path), 0
        for batch in batches:
            for rows in byte_slices(batch, 1, SLICE):
                ids, ends = coder.encode_all(rows.column(1))
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                counts = ends - starts + 1
                values = np.insert(ids, ends, end_id).astype(np.int32)
                at = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                parts = -(-counts // PART)
                doc = np.repeat(np.arange(len(counts)), parts)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                cuts = np.append(at[doc] + nth * PART, len(values)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(doc)), pa.array(before + at[doc]), pa.array(counts[doc]), pa.array(nth.astype(np.int32)), pa.ListArray.from_arrays(pa.array(cuts), pa.array(values))],
                    names=["doc_id", "doc_at", "n_tokens", "part", "ids"],
                )
                before += int(counts.sum())

    return ordered.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_ids(df: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, stripe_bytes: int = 32 << 20, false_positives: float = 0.01) -> None:
    """Encode whole texts and write their ids, each document's followed by end_id, in ascending order of doc_id.

    path: a tokenizers JSON file with a byte-level pre-tokenizer, which every executor must be able to open. Ranges of
    doc_id become files whose names are in the same order; rows of one doc_id are ordered by a digest of their text, and
    equal rows are dealt out among tasks. Null doc_ids come first, null texts are read as empty and have the end id
    alone. Other columns are not looked at. An empty table gives a folder without ids. The folder must be new.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = rows.select("doc_id", "text", order[1].alias("_of_text"), order[2].alias("_row"))
    ordered = keyed.repartitionByRange("doc_id", "_of_text", "_row").sortWithinPartitions("doc_id", "_of_text", "_row")
    found = encoded(ordered, path, end_id).select(F.spark_partition_id().alias("shard"), "*")
    options = {"orc.stripe.size": stripe_bytes, "orc.create.index": "true", "orc.row.index.stride": GROUP, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": false_positives}
    found.write.options(**options).orc(f"{folder}/ids")
    # One row for each file is all that this window sorts.
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(df.sparkSession, folder).where("part = 0").groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("ids"), F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))
    files.withColumn("base", F.coalesce(F.sum("ids").over(upto), F.lit(0)).cast("long")).write.orc(f"{folder}/shards")


def stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"shard int, {SCHEMA}").orc(f"{folder}/ids")


def read_ids(spark: SparkSession, folder: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, part, ids): the file rows of all documents, or of some; start counts the ids of all documents before.

    Asking for doc_ids, or filtering by any of the columns, reaches the scan: files' and row groups' least and largest
    values and the Bloom filters on doc_id decide what is read.
    """
    rows = stored(spark, folder)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(doc_ids)))
    bases = spark.read.schema("shard int, base long").orc(f"{folder}/shards")
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("doc_at")).alias("start"), "n_tokens", "part", "ids")


def combined_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings, one after the other, from the CRC-32 of each and the second one's length.

    Appending zero bytes to a string acts on its register as a linear map over bits; the map for `size` bytes is put
    together from those for powers of two.
    """
    step = [0xEDB88320] + [1 << k for k in range(31)]  # one zero bit
    apply = lambda m, x: _xor(m[k] for k in range(32) if x >> k & 1)
    bits = 8 * size
    while bits:
        if bits & 1:
            first = apply(step, first)
        step = [apply(step, x) for x in step]
        bits >>= 1
    return first ^ second


def _xor(values: Iterable[int]) -> int:
    out = 0
    for x in values:
        out ^= x
    return out


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in read_ids' rows, counted and summed from the ids themselves.

    Parts are digested where they are read; only documents of several parts meet in a shuffle, with a few numbers for
    each part.
    """

    def of_parts(batches):
        for batch in batches:
            column = batch.column(3)
            values, offsets = column.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), column.offsets.to_numpy()
            found = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], pa.array(np.diff(offsets).astype(np.int64)), pa.array(found, pa.int64())], names=["doc_id", "start", "part", "n", "crc"])

    def joined(batches):
        for batch in batches:
            totals, sums = [], []
            for parts in batch.column(2).to_pylist():
                n = crc = 0
                for part in parts:
                    n, crc = n + part["n"], combined_crc(crc, part["crc"], 4 * part["n"])
                totals.append(n)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals, pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    digested = lambda df: df.select("doc_id", "start", "part", "ids").mapInArrow(of_parts, "doc_id long, start long, part int, n long, crc long")
    single = digested(rows.where(F.col("n_tokens") <= PART)).select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    several = digested(rows.where(F.col("n_tokens") > PART)).groupBy("doc_id", "start").agg(F.sort_array(F.collect_list(F.struct("part", "n", "crc"))).alias("parts"))
    return single.unionByName(several.mapInArrow(joined, "doc_id long, start long, n_tokens long, ids_crc32 long"))
