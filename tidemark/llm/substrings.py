"""Exact substring removal by difference-cover anchors.

Positions whose remainder modulo the period lies in a difference cover are anchors. For any two positions there is a
shift below the period that takes both to anchors, so two equal windows of `window` words always share an anchored
stretch of window - period + 1 words at the same offset. Only these stretches are hashed over the whole corpus. Where a
stretch occurs in more than one document, it is extended: the windows around it, and no others, are hashed whole and
compared by their first document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, text_bytes

#: A period and a perfect difference set for it; each remainder is a difference of two members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Odd bases of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words that a task remembers, and rows that it combines, at a time.
WORDS, ROWS = 1_000_000, 1_000_000


class RollingHashes:
    """Two 64-bit polynomial hashes of every stretch of words, from prefix sums modulo 2^64."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.values = np.empty((2, 0), np.uint64)
        self.power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.inverse = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _powers(self, n: int) -> None:
        if len(self.power[0]) < n:
            size = max(n, 4096, 2 * len(self.power[0]))
            for k, base in enumerate(BASES):
                for table, b in ((self.power, base), (self.inverse, pow(base, -1, 1 << 64))):
                    x = np.full(size, b, np.uint64)
                    x[0] = 1
                    table[k] = np.cumprod(x)

    def of(self, words: list[bytes]) -> list[np.ndarray]:
        """Prefix sums of the words' hashes, one array for each hash, with a leading zero."""
        index = self.index
        if len(index) > WORDS:
            index.clear()
            self.values = np.empty((2, 0), np.uint64)
        at = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
        if len(index) > (known := self.values.shape[1]):
            new = list(index)[known:] if known == 0 else [w for w, _ in zip(reversed(index), range(len(index) - known))][::-1]
            wide = [xxhash.xxh3_128_digest(w) for w in new]
            fresh = np.frombuffer(b"".join(wide), "<u8").reshape(-1, 2).T.astype(np.uint64)
            self.values = np.concatenate([self.values, fresh], axis=1)
        self._powers(len(words) + 1)
        return [np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.values[k][at] * self.power[k][: len(words)]))) for k in (0, 1)]

    def stretches(self, sums: list[np.ndarray], starts: np.ndarray, length: int, which: int) -> np.ndarray:
        return mix64((sums[which][starts + length] - sums[which][starts]) * self.inverse[which][starts])


#: A place is one long: bits for the position in words, for the length of a run, for which of the rows that repeat a
#: doc_id it is in, and a flag for places that need no comparison any more. Short rows keep the shuffles small.
POS_BITS, RUN_BITS, ROW_BITS = 28, 14, 19
SETTLED = 1 << (POS_BITS + RUN_BITS + ROW_BITS)


def packed(row, pos, n):
    return (np.int64(row) << np.int64(POS_BITS + RUN_BITS)) | (np.asarray(n, np.int64) << np.int64(POS_BITS)) | np.asarray(pos, np.int64)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and run length of places."""
    return (
        (place >> np.int64(POS_BITS + RUN_BITS)) & np.int64((1 << ROW_BITS) - 1),
        place & np.int64((1 << POS_BITS) - 1),
        (place >> np.int64(POS_BITS)) & np.int64((1 << RUN_BITS) - 1),
    )


def runs_of(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single places, put together to runs of consecutive positions in one document's row."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    if not len(doc):
        return doc, place
    row, pos, _ = unpacked(place)
    at = np.arange(len(doc))
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(row) != 0) | (np.diff(pos) != 1)))
    since = at - np.maximum.accumulate(np.where(new, at, 0))
    new |= since % ((1 << RUN_BITS) - 1) == 0  # no run is longer than its bits
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(doc)])))
    return doc[first], packed(0, 0, 0) | (row[first] << np.int64(POS_BITS + RUN_BITS)) | (n << np.int64(POS_BITS)) | pos[first]


def combined(hashes: list[np.ndarray], doc: np.ndarray, place: np.ndarray, anchors: bool):
    """What one task can settle among its own rows before the shuffle.

    Returns the rows that other tasks must see, at most one document for each hash, and the rows that are settled: for
    anchors, those whose hash two documents share; for windows, those that a smaller document of this task has too.
    """
    order = np.lexsort((place, doc, *hashes[::-1]))
    hashes, doc, place = [h[order] for h in hashes], doc[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = np.any([h[1:] != h[:-1] for h in hashes], axis=0)
    first = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    own = doc == doc[first]
    if anchors:
        shared = np.zeros(len(doc), bool)
        shared[first[~own]] = True
        done = shared[first]
        seen = own & (~done | new)
    else:
        done, seen = ~own, own
    return [h[seen] for h in hashes], doc[seen], place[seen], runs_of(doc[done], place[done])


def batch_of(hashes, doc, place) -> pa.RecordBatch:
    names = ["h1", "h2"][: len(hashes)] + ["doc", "place"]
    return pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in hashes), pa.array(doc, pa.int64()), pa.array(place, pa.int64())], names=names)


def hashed(batches, starts_of, window: int, anchors: bool):
    """(h1, h2 for windows, doc, place) of the stretches that starts_of picks in each document; each task combines its own rows first.

    An anchor is only a hint and has a hash of 48 bits; a window is told apart by 96 bits.
    """
    rolling, length = RollingHashes(), window - PERIOD + 1 if anchors else window
    bits = (48,) if anchors else (64, 32)
    held: list[tuple] = []
    count = 0

    def flush():
        if not held:
            return
        hashes = [np.concatenate([x[0][k] for x in held]) for k in range(len(bits))]
        hashes, doc, place, (runs_doc, runs) = combined(hashes, np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]), anchors)
        yield batch_of(hashes, doc, place)
        # Settled runs are spread by document, not by hash; a set high bit keeps them apart from all hashes.
        high = np.uint64(1 << 63)
        spread = [mix64(runs_doc.view(np.uint64)) | high, np.full(len(runs), high, np.uint64)]
        yield batch_of(spread[: len(bits)], runs_doc, runs | np.int64(SETTLED))

    for batch in batches:
        for doc, data, row, *more in zip(*(c.to_pylist() for c in batch.columns)):
            if doc is None or (more and not more[0]):
                continue
            words = data.split()
            if len(words) >= 1 << POS_BITS or row >= 1 << ROW_BITS:
                raise ValueError(f"document {doc}: a text of 2^{POS_BITS} words or 2^{ROW_BITS} rows of one doc_id do not fit a place")
            starts = starts_of(len(words), row, *more)
            if not len(starts):
                continue
            sums = rolling.of(words)
            found = [rolling.stretches(sums, starts, length, k) >> np.uint64(64 - n) for k, n in enumerate(bits)]
            held.append((found, np.full(len(starts), doc, np.int64), packed(row, starts, 1)))
            count += len(starts)
            if count >= ROWS:
                yield from flush()
                held, count = [], 0
    yield from flush()


def anchor_starts(n_words: int, window: int = 50) -> np.ndarray:
    """Anchored stretches of a document; texts shorter than a window have none."""
    if n_words < window:
        return np.empty(0, np.int64)
    at = np.arange(n_words - (window - PERIOD + 1) + 1)
    return at[np.isin(at % PERIOD, COVER)]


def marked(n: int, row: int, places, reach: int = 1) -> np.ndarray:
    """Which of n positions lie in the places of this row, each position reaching as far as `reach`."""
    steps = np.zeros(n + 1, np.int64)
    if places:
        of, pos, length = unpacked(np.array(places, np.int64))
        own = of == row
        np.add.at(steps, np.minimum(n, pos[own]), 1)
        np.add.at(steps, np.minimum(n, pos[own] + length[own] - 1 + reach), -1)
    return np.cumsum(steps[:-1]) > 0


def numbered(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, text, row): row counts the rows that repeat a doc_id, by text; only where some do is there anything to sort."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc"), text_bytes(text).alias("text"))
    if docs.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1 and doc is not null").isEmpty():
        return docs.withColumn("row", F.lit(0))
    return docs.withColumn("row", F.when(F.col("doc").isNotNull(), F.row_number().over(Window.partitionBy("doc").orderBy("text")) - 1).otherwise(0))


def remove_repeats(df: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, row, removed): each text and the places of the windows that an earlier document has too.

    A window is `window` consecutive words of one document; a word is removed if a window that covers it has a word
    sequence that also starts in a document with a smaller doc_id. Windows are judged on the input. removed holds packed
    window starts, null if there are none; `kept_words` reads them. Null texts have no words; rows with a null doc_id
    lose nothing and take nothing from others; rows that repeat a doc_id don't remove each other's words, but each loses
    what smaller ids have. Other columns are not looked at.

    Each task combines its rows before a shuffle, so that a hash reaches the next stage once per task and document,
    not once per copy; the texts are shuffled once, by doc_id, and that exchange is used again at the end.
    """
    if window < PERIOD:
        raise ValueError(f"windows must have {PERIOD} words or more")
    docs = numbered(df, doc_id, text)
    settled = F.col("place") >= SETTLED

    anchors = docs.mapInArrow(lambda it: hashed(it, lambda n, row: anchor_starts(n, window), window, True), "h1 long, doc long, place long")
    one = Window.partitionBy("h1")
    shared = (
        anchors.withColumns({"low": F.min("doc").over(one), "high": F.max("doc").over(one)})
        .where(settled | (F.col("low") != F.col("high")))
        .groupBy("doc").agg(F.collect_list("place").alias("places"))
    )

    def windows(n_words, row, places):
        # A window that holds the anchored stretch at p starts at p - (PERIOD - 1) or later, and not after p.
        if n_words < window:
            return np.empty(0, np.int64)
        near = marked(n_words + PERIOD, row, places, PERIOD)
        return np.flatnonzero(near[PERIOD - 1 : PERIOD - 1 + n_words - window + 1])

    # A left join, like the last one, so that both read the same exchange of the texts.
    whole = docs.join(shared, "doc", "left").mapInArrow(lambda it: hashed(it, windows, window, False), "h1 long, h2 long, doc long, place long")
    by_window = Window.partitionBy("h1", "h2")
    repeated = (
        whole.withColumn("low", F.min("doc").over(by_window))
        .where(settled | (F.col("doc") > F.col("low")))
        .groupBy("doc").agg(F.collect_list("place").alias("removed"))
    )
    return docs.join(repeated, "doc", "left").withColumnRenamed("doc", doc_id)


def kept_words(data: bytes, row: int, removed, window: int = 50) -> tuple[list[bytes], int]:
    """The words of a text that are kept, and how many are removed."""
    words = data.split()
    if not removed or not words:
        return words, 0
    gone = marked(len(words), row, removed, window)
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())


def removal_digests(df: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, joined by single spaces."""

    def run(batches):
        for batch in batches:
            n, gone, digests = [], [], []
            for data, row, removed in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                kept, lost = kept_words(data, row, removed, window)
                n.append(len(kept) + lost)
                gone.append(lost)
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return remove_repeats(df, window, doc_id, text).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
