"""Periodic runs in texts: stretches in which the words repeat with a period, found by uniting suffixes.

The suffixes of a text's words are sorted by prefix doubling, and neighbours in that order are joined by their longest
common prefix (LCP), the longest first. A class of suffixes is the ordered set of their positions. When two classes meet
at an LCP of l, positions of both that become neighbours at a distance d <= l begin a stretch with period d: it ends l
words after the second position. No position lies between them, so no period is smaller; and of all pairs with this
period and this end, the first one met, with the largest LCP, is the run's start. Every run of at least two periods is
met so, when its first two repetitions come together.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, text_bytes, words_of

#: Bytes of text whose suffixes are sorted at a time.
SLICE = 4 << 20

RUN = "struct<start:long,length:long,period:long>"


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, one text after another, and where each text ends."""
    table: dict[bytes, int] = {}
    number = table.setdefault
    words = np.fromiter((number(w, len(table)) for text in texts for w in text), np.int64, sum(map(len, texts)))
    return words, np.cumsum([len(t) for t in texts])


def repeating(words: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Texts, by number, in which some stretch of `least` words seems to occur twice: by hashes, so some too many but none too few."""
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    inside = np.flatnonzero(np.arange(len(words)) + least <= ends[text])
    if not len(inside):
        return np.zeros(0, np.int64)
    spread = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    hashes = text[inside].astype(np.uint64)
    for k in range(least):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + spread[inside + k]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    return np.unique(text[inside[order[1:][same]]])


def classes_by_length(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For lengths 1, 2, 4, ...: each position's class, equal exactly for positions of one text whose next so many words
    are equal. The last is the suffix order itself: every position its own class, in each text's order of suffixes."""
    n = len(words)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    end = ends[text]
    key = text * (words.max() + 1) + words
    order = np.argsort(key, kind="stable")
    levels = [_classes(order, key[order], np.arange(n), n)]
    length = 1
    while True:
        rank = levels[-1]
        counts = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(counts[rank] > 1)
        if not len(open_):
            return levels
        after = open_ + length
        beyond = after >= end[open_]
        second = np.where(beyond, 0, rank[np.minimum(after, n - 1)] + 1)
        key = rank[open_] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        # A class's number is the place of its first member in the suffix order, so those that are split keep their places.
        first = rank[open_[order]]
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        place = first + np.arange(len(first)) - np.repeat(starts, np.diff(starts, append=len(first)))
        levels.append(_classes(open_[order], key[order], place, n, rank))
        length *= 2


def _classes(order: np.ndarray, keys: np.ndarray, place: np.ndarray, n: int, before: np.ndarray | None = None) -> np.ndarray:
    """Each position's class: the place of the first of all positions with its key; others keep the class they had."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    found = np.zeros(n, np.int64) if before is None else before.copy()
    found[order] = np.repeat(place[starts], np.diff(starts, append=len(keys)))
    return found


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b, pair by pair, from the classes of halving lengths."""
    a, b, n = a.copy(), b.copy(), len(levels[0])
    found = np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = np.where(same, 1 << k, 0)
        found, a, b = found + step, a + step, b + step
    return found


def united(pairs: Iterator[tuple[int, int, int]], least: int, times: int) -> dict[tuple[int, int], int]:
    """(period, end) -> start of runs, from pairs of positions and their LCP in descending order of LCP.

    Classes are sorted lists of positions; the smaller one is added to the larger one, so a position moves at most
    log2(n) times.
    """
    held: dict[int, list[int]] = {}  # a class's label is one of its positions
    label: dict[int, int] = {}
    runs: dict[tuple[int, int], int] = {}
    for a, b, lcp in pairs:
        one, other = label.get(a, a), label.get(b, b)
        large, small = held.get(one) or [a], held.get(other) or [b]
        if len(large) < len(small):
            large, small, one, other = small, large, other, one
        last = len(small) - 1
        near = []
        for j, x in enumerate(small):
            k = bisect_left(large, x)
            if k and (j == 0 or small[j - 1] < large[k - 1]):
                near.append((large[k - 1], x))
            if k < len(large) and (j == last or small[j + 1] > large[k]):
                near.append((x, large[k]))
        for p, q in near:
            period = q - p
            if period * (times - 1) <= lcp and q + lcp - p >= least:
                runs.setdefault((period, q + lcp), p)
        for x in small:
            if x > large[-1]:
                large.append(x)
            else:
                insort(large, x)
            label[x] = one
        label[one] = one
        held[one] = large
        held.pop(other, None)
    return runs


def find_runs(texts: list[list[bytes]], least: int = 12, times: int = 2) -> dict[int, list[tuple[int, int, int]]]:
    """Text number -> its runs (start, length, period), by start and then period; texts without runs are left out.

    A run of `least` words and `times` >= 2 periods has two suffixes with an LCP of at least half of `least`, so texts
    in which no stretch of so many words repeats are not looked at, nor are shorter LCPs.
    """
    shortest = max(1, -(-least // 2))
    words, ends = numbered(texts)
    some = repeating(words, ends, shortest)
    if not len(some):
        return {}
    starts = np.concatenate([[0], ends[:-1]])
    words = np.concatenate([words[starts[k] : ends[k]] for k in some])
    sizes = ends[some] - starts[some]
    ends, starts = np.cumsum(sizes), np.cumsum(sizes) - sizes
    levels = classes_by_length(words, ends)
    order = np.argsort(levels[-1], kind="stable")
    before, after = order[:-1], order[1:]
    # Neighbours that share no stretch of a power of two below the shortest LCP are no pairs.
    k = min(len(levels) - 1, shortest.bit_length() - 1)
    close = levels[k][before] == levels[k][after]
    before, after = before[close], after[close]
    lcp = common_prefixes(levels, before, after)
    down = np.argsort(-lcp, kind="stable")
    down = down[lcp[down] >= shortest]
    del levels
    runs = united(zip(before[down].tolist(), after[down].tolist(), lcp[down].tolist()), least, times)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for (period, end), start in runs.items():
        k = int(np.searchsorted(ends, start, "right"))
        found.setdefault(int(some[k]), []).append((start - int(starts[k]), end - start, period))
    return {k: sorted(rows, key=lambda r: (r[0], r[2])) for k, rows in found.items()}


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run contains after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.cumsum(edges[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep)]


def periodic_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 12, times: int = 2) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) of each row's whole text.

    runs: array of (start, length, period) with the smallest period, at least `least` words and `times` periods long,
    and not to be extended either way, ordered by start and then period. kept_text: the words that no run contains
    after its first period, joined by one space. Null and empty texts have no words, no runs and an empty kept_text;
    repeated rows give repeated results, an empty table gives none. Other columns are not looked at. Rows are
    independent, so nothing is shuffled; beside its text a row takes some hundred bytes for each word.
    """

    def run(batches):
        for batch in batches:
            for part, data in in_slices(batch, 1, SLICE):
                texts = [words_of(x) for x in data]
                found = find_runs(texts, least, times)
                kept = [b" ".join(collapsed(words, found[k]) if k in found else words) for k, words in enumerate(texts)]
                runs = [[dict(zip(("start", "length", "period"), r)) for r in found.get(k, ())] for k in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_words", "runs", "kept"],
                )

    rows = df.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"))
    found = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, runs array<{RUN}>, kept binary")
    return found.select("doc_id", "n_words", "runs", F.col("kept").cast("string").alias("kept_text"))
