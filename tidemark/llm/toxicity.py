"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts become the set of their hashed character n-grams (over lower-cased UTF-8 bytes). On the training rows each
n-gram's ratio is log((share among toxic rows) / (share among others)), smoothed by one; the n-grams that tell the
classes apart best are kept, each feature is its presence times its ratio, and a logistic regression weighs them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.common import in_slices, schema_with, text_bytes, written

#: Lengths of the n-grams, hashed n-grams (a power of two), and those that are kept as features.
SIZES, BUCKETS, FEATURES = (3, 4, 5), 1 << 20, 4_096
#: At most this many labelled rows, evenly spread by a hash, train the classifier.
TRAIN_ROWS = 20_000
#: Steps of the regression: it is stopped before it has settled, which holds the weights back as well.
ROUNDS = 40
#: Bytes of a text that are hashed at a time.
STEP = 1 << 20
THRESHOLD = 0.3


def buckets_of(data: bytes, keep: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashed n-grams of a text; with `keep`, a table from bucket to feature (-1: none), its features."""
    found = []
    data = b" " + data.lower() + b" "
    for at in range(0, len(data), STEP):
        x = np.frombuffer(data[at : at + STEP + max(SIZES) - 1], np.uint8).astype(np.uint32)
        for size in SIZES:
            n = len(x) - size + 1
            if n <= 0:
                continue
            h = np.full(n, size, np.uint32)
            for k in range(size):
                h *= np.uint32(0x01000193)
                h ^= x[k : k + n]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h = h >> np.uint32(32 - BUCKETS.bit_length() + 1)
            if keep is not None:
                h = keep[h]
                h = h[h >= 0]
            found.append(np.unique(h))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def held_out_rows(doc_id: Column, parts: int = 4, held: int = 2) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == held


def training_rows(docs: DataFrame, labels: DataFrame, parts: int, held: int, most: int) -> DataFrame:
    """(text, toxic) of at most about `most` labelled rows outside the held-out part.

    The labels are thinned by a hash of doc_id before the join, so the broadcast side has a bound whatever the table's
    size; a label that is null or given twice with both values is left out.
    """
    usable = labels.where("toxic is not null and doc_id is not null").where(~held_out_rows(F.col("doc_id"), parts, held))
    n = usable.count()
    share = min(1.0, most / max(1, n))
    thinned = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else usable
    single = thinned.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    return docs.join(F.broadcast(single.select("doc_id", F.col("toxic").cast("int").alias("toxic"))), "doc_id").select("text", "toxic")


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): in how many rows of each class an n-gram occurs; tasks add up before the shuffle."""

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for data, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                counts[0 if toxic else 1][buckets_of(data)] += 1
        at = np.flatnonzero(counts.sum(axis=0))
        for s in range(0, len(at), 1 << 16):
            part = at[s : s + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(counts[0][part]), pa.array(counts[1][part])], names=["bucket", "toxic", "clean"])

    return rows.mapInArrow(run, "bucket int, toxic long, clean long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Classifier:
    """A table from bucket to feature, the features' weights (ratio times coefficient) and the intercept."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, intercept: float):
        self.table, self.weights, self.intercept = table, weights, intercept

    def score(self, data: bytes) -> float:
        z = self.intercept + float(self.weights[buckets_of(data, self.table)].sum())
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Classifier:
    """The classifier for (text as bytes, toxic). Where only one class is seen, every text gets that class's share, smoothed."""
    rows = written(rows, "labelled")
    sizes = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = sizes["toxic"], sizes["n"] - sizes["toxic"]
    prior = math.log((toxic + 1) / (clean + 1))
    empty = np.full(BUCKETS, -1, np.int32)
    if not toxic or not clean:
        return Classifier(empty, np.zeros(0), prior)
    p, q = (F.col("toxic") + 1) / (toxic + 2.0), (F.col("clean") + 1) / (clean + 2.0)
    ratio = F.log(p / q)
    # How well an n-gram tells the classes apart: the squared difference of its shares, over their variance.
    pooled = (F.col("toxic") + F.col("clean") + 1) / (toxic + clean + 2.0)
    gain = (p - q) * (p - q) / (pooled * (1.0 - pooled) + 1e-9)
    best = ngram_counts(rows).withColumns({"ratio": ratio, "gain": gain}).orderBy(F.col("gain").desc(), "bucket").limit(FEATURES).select("bucket", "ratio").collect()
    table = empty
    table[[r["bucket"] for r in best]] = np.arange(len(best))
    ratios = np.array([r["ratio"] for r in best])
    names = np.array([str(k) for k in range(len(best))], object)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def features(batches):
        table = shared.value
        for batch in batches:
            found = [names[buckets_of(x, table)].tolist() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1)], names=["at", "toxic"])

    known = written(rows.mapInArrow(features, "at array<string>, toxic int"), "features")
    presence = CountVectorizerModel.from_vocabulary(names.tolist(), inputCol="at", outputCol="presence", binary=True)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="presence", outputCol="features")
    known = scaled.transform(presence.transform(known)).select("features", F.col("toxic").cast("double").alias("label"))
    model = LogisticRegression(maxIter=rounds, regParam=2e-3, standardization=False).fit(known)
    return Classifier(table, np.array(model.coefficients.toArray()) * ratios, float(model.intercept))


def scores(df: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, most: int = TRAIN_ROWS, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """df with a column `out`: the probability, from 0 to 1, that a text is toxic.

    Only texts are looked at; labels (doc_id, toxic) are learnt from the rows whose crc32(doc_id as text) mod `parts` is
    not `held`, at most about `most` of them; of rows that repeat a doc_id every text is learnt with its label. Null and empty texts are scored as empty, by the classifier's intercept.
    All other columns stay as they are; a column already named `out` is replaced. An empty label table gives every text
    the same score of 0.5.
    """
    model = fit(training_rows(df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")), labels, parts, held, most), rounds)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = df.drop(out) if out in df.columns else df
    at = kept.columns.index(text)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part, texts in in_slices(batch, at):
                found = [model.score(x.encode() if isinstance(x, str) else x or b"") for x in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=[*part.schema.names, out])

    return kept.mapInArrow(run, schema_with(kept, out, DoubleType()))
