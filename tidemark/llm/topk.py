"""Exact top-k inner products with block-at-a-time pruning.

Rows are kept in blocks: ranges of rows, ordered so that alike vectors are neighbours, with a forward index (the block's
matrix) and each term's largest value. Every dimension counts as two terms, its positive and its negative part. For a
query, the sum of its terms' maxima bounds every score in a block; blocks are scored in the order of their bounds until
the next bound is below the k-th best score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a block, blocks in a range that one task works through at a time, and queries in a batch.
BLOCK, RANGE, BATCH = 256, 32, 512
#: Largest magnitude below which double arithmetic on integers is exact.
EXACT = float(1 << 53)


def scaled(df: DataFrame, scale: int, row_id: str, vector: str) -> DataFrame:
    """(id, v) with v as floor(scale * x); vectors that are null or hold null or non-finite components are left out."""
    value = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return df.where(F.col(vector).isNotNull() & F.col(row_id).isNotNull()).where(~bad).select(F.col(row_id).cast("long").alias("id"), value.alias("v"))


def _matrix(lists, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if all(len(x) == width for x in lists):
        return np.array(lists, np.float64).reshape(len(lists), width)
    out = np.zeros((len(lists), width))
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def packed(vectors: DataFrame, width: int, rows: int, ordered: bool) -> DataFrame:
    """(ids, matrix) of up to `rows` vectors as bytes; ordered: alike vectors become neighbours first, within a task's share."""

    def run(batches):
        held_ids, held = [np.empty(0, np.int64)], [np.empty((0, width))]
        count = 0

        def flush():
            ids, matrix = np.concatenate(held_ids), np.concatenate(held)
            if ordered and len(ids) > BLOCK:
                order = alike(matrix)
                ids, matrix = ids[order], matrix[order]
            found = [(ids[s : s + rows].tobytes(), matrix[s : s + rows].tobytes()) for s in range(0, len(ids), rows)]
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["ids", "matrix"])

        for batch in batches:
            held_ids.append(batch.column(0).to_numpy())
            held.append(_matrix(batch.column(1).to_pylist(), width))
            count += len(held_ids[-1])
            if count >= 64 * BLOCK * RANGE // max(1, width // 64):
                yield flush()
                held_ids, held, count = [np.empty(0, np.int64)], [np.empty((0, width))], 0
        if count:
            yield flush()

    return vectors.mapInArrow(run, "ids binary, matrix binary")


def alike(matrix: np.ndarray) -> np.ndarray:
    """An order that brings alike vectors together: halves again and again, along the direction between two far rows."""
    parts, done = [np.arange(len(matrix))], []
    while parts:
        part = parts.pop()
        if len(part) <= BLOCK:
            done.append(part)
            continue
        rows = matrix[part]
        away = rows[np.argmax(((rows - rows[0]) ** 2).sum(axis=1))]
        other = rows[np.argmax(((rows - away) ** 2).sum(axis=1))]
        half = max(BLOCK, (len(part) // 2) // BLOCK * BLOCK)
        order = np.argsort(rows @ (away - other), kind="stable")
        parts += [part[order[half:]], part[order[:half]]]
    return np.concatenate(done)


def best_in_range(query_ids, queries, ids, matrix, k: int, whole: bool = False, visited: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(query, row, score) of each query's k best rows of a range of blocks, ties to smaller ids.

    whole: scores are summed as 64-bit integers, for those that doubles don't hold exactly; bounds stay doubles, rounded
    up. visited: gets the number of pairs of query and block that were scored.
    """
    blocks = [slice(s, s + BLOCK) for s in range(0, len(ids), BLOCK)]
    high = np.array([np.maximum(matrix[b].max(axis=0), 0) for b in blocks])
    low = np.array([np.maximum(-matrix[b].min(axis=0), 0) for b in blocks])
    # Terms are the two signs of a dimension: only the part of the same sign can add to a score, the rest lowers it.
    bound = np.maximum(queries, 0) @ high.T + np.maximum(-queries, 0) @ low.T
    if whole:
        bound, queries, matrix = bound * (1 + 1e-9) + 1, queries.astype(np.int64), matrix.astype(np.int64)
    none = -np.iinfo(np.int64).max if whole else -np.inf
    order = np.argsort(-bound, axis=1, kind="stable")
    top_score = np.full((len(queries), k), none)
    top_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    for step in range(len(blocks)):
        at = order[:, step]
        open_ = np.flatnonzero(bound[np.arange(len(queries)), at] >= top_score[:, -1])
        if not len(open_):
            break
        if visited is not None:
            visited.append(len(open_))
        for b in np.unique(at[open_]):
            own = open_[at[open_] == b]
            scores = queries[own] @ matrix[blocks[b]].T
            row_ids = np.broadcast_to(ids[blocks[b]], scores.shape)
            scores = np.where(row_ids == query_ids[own, None], none, scores)
            all_scores = np.concatenate([top_score[own], scores], axis=1)
            all_ids = np.concatenate([top_id[own], row_ids], axis=1)
            if all_scores.shape[1] > 4 * k:  # what is below the k-th score is out; ties with it stay
                kth = -np.partition(-all_scores, k - 1, axis=1)[:, k - 1 : k]
                keep = (all_scores >= kth).sum(axis=1).max()
                pick = np.argpartition(-all_scores, min(keep, all_scores.shape[1] - 1), axis=1)[:, : keep + 1]
                all_scores, all_ids = np.take_along_axis(all_scores, pick, 1), np.take_along_axis(all_ids, pick, 1)
            rank = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            top_score[own], top_id[own] = np.take_along_axis(all_scores, rank, 1), np.take_along_axis(all_ids, rank, 1)
    q, c = np.nonzero(top_score > none)
    return list(zip(query_ids[q].tolist(), top_id[q, c].tolist(), top_score[q, c].tolist()))


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query, exactly; ties to the smaller vec_id.

    Components become floor(scale * x). Queries are the rows whose id is divisible by `every`, candidates all rows with
    another id than the query's. Vectors that are null, or hold null or non-finite components, take no part; shorter
    vectors count as filled up with zeros; repeated ids are candidates once for each row. An empty table, or one without
    queries, gives no rows. Other columns are not looked at. Scores beyond 2^53 are summed as longs; vectors so
    long that a score need not fit a long are an error.

    Queries are packed into batches, rows into ranges of blocks; each batch meets each range once, in whichever task
    that pair is dealt to, and hands on at most k rows for each of its queries.
    """
    vectors = scaled(df, scale, row_id, vector)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    widest = vectors.agg(F.max(F.size("v")).alias("width"), F.max(square).alias("square"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"), F.count("*").alias("n")).first()
    width, most, n = widest["width"] or 1, widest["most"] or 0.0, widest["n"]
    whole = width * most * most >= EXACT
    if whole and widest["square"] >= float(1 << 63) * (1 - 1e-9):
        raise OverflowError("inner products of these vectors need not fit a long; use a smaller scale")
    ranges = packed(vectors, width, BLOCK * RANGE, True).select(F.pmod(F.xxhash64("ids"), F.lit(1 << 30)).alias("r"), "ids", "matrix")
    groups = max(1, min(1 << 16, -(-n // (BLOCK * RANGE))))
    batches = packed(vectors.where(F.col("id") % every == 0), width, BATCH, False).select(F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"))
    dealt = batches.select("query_ids", "queries", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    pairs = ranges.withColumn("g", F.pmod("r", F.lit(groups)).cast("int")).join(dealt, "g").select("query_ids", "queries", "ids", "matrix")

    def run(it):
        for batch in it:
            for qi, q, ci, c in zip(*(col.to_pylist() for col in batch.columns)):
                query_ids, ids = np.frombuffer(qi, np.int64), np.frombuffer(ci, np.int64)
                found = best_in_range(query_ids, np.frombuffer(q).reshape(-1, width), ids, np.frombuffer(c).reshape(-1, width), k, whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([int(x[2]) for x in found], pa.int64())],
                    names=["query_id", "vec_id", "score"],
                )

    best = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
