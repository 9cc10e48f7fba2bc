"""Mixing sources to target weights with exact budgets.

Each row gets a hash-random key, a digest of its id. Within a source the rows are ordered by it, in buckets of the key's
leading digits, which are ranges of keys: a small table of bucket sums gives every bucket its start in the source's
prefix sum, and the bucket in which the budget is crossed is sorted to find the row where it is. All rows then know
from their own key whether they lie before that cut, so neither texts nor other buckets are sorted or shuffled. Budgets
above a source's size go round it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Rows in a bucket of keys, as an aim. A source has at most MOST_BUCKETS of them, rows of one window; with more rows
#: buckets grow, as only one of each source is sorted: a table of 10^11 rows has buckets of 1.5 million.
BUCKET_ROWS, MOST_BUCKETS = 2_048, 65_536


def word_count(text: str | Column) -> Column:
    """Number of words; null gives 0. Runs of separators become one space, then the spaces that are left are counted."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size) with target: shares of the whole by weight, none above `most` times its source's size.

    Sources take the weights in turn, by code point and null last. What a source cannot take is reshared by weight among
    the others, until none is above its limit: in the order of limit over weight, a source is at its limit if the share
    that it would get after all before it have stopped reaches it. The windows run over one row for each source, in one task: sources are
    names of collections, thousands rather than a share of the rows.
    """
    ranked = totals.withColumn("_n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_n") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("_w", weight).withColumn("_limit", (F.col("source_size") * most).cast("double"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("_limit") / F.col("_w"), "_n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        ranked.withColumn("_all", F.sum("source_size").over(every).cast("double"))
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_full", F.col("_w") * F.col("_left") >= F.col("_limit") * F.col("_weights"))
        .withColumn("_open_left", F.max(F.when(~F.col("_full"), F.col("_left"))).over(every))
        .withColumn("_open_weights", F.max(F.when(~F.col("_full"), F.col("_weights"))).over(every))
    )
    target = F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_w") * F.col("_open_left") / F.col("_open_weights"))
    return shared.select("source", "source_size", target.alias("target"))


def keyed(df: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """df with _key (hash-random, by doc_id), _tag (of the text) and _source."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    return df.select(F.struct("*").alias("_row"), key.alias("_key"), F.xxhash64(F.col(text)).alias("_tag"), F.col(source).alias("_source"))


def place() -> Column:
    """What orders a source's rows: the key, then size and text for rows that repeat a doc_id."""
    return F.struct("_key", "_size", "_tag")


def sized_rows(df: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """(_doc_id, _source, _size, _key, _tag, _bucket) of every row, written: the words of a text are counted once."""
    buckets = max(1, min(MOST_BUCKETS, df.count() // BUCKET_ROWS))
    rows = keyed(df, seed, doc_id, text, source)
    number = (F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int")
    size = word_count(F.col("_row").getField(text))
    return written(rows.select(F.col("_row").getField(doc_id).alias("_doc_id"), "_source", size.alias("_size"), "_key", "_tag", number.alias("_bucket")), "sizes")


def cuts(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row for each source: source, source_size, target, rounds (how often all of it is taken) and the cut of the last round.

    Rows before (cut_key, cut_size, cut_tag) are taken once more, rows at that place `cut_extra` words of them; equal
    rows at the cut share what is left, rounded down. Sources without words have no cut.
    """
    sums = sized.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    order = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(order), F.lit(0)))
    goals = targets(sums.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size")), weights, most)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("rounds", rounds).withColumn("rest", F.floor("target").cast("long") - F.col("rounds") * F.col("source_size"))
    crossed = starts.join(goals, F.col("_source").eqNullSafe(F.col("source"))).where("_start <= rest and rest < _start + _sum")
    crossed = crossed.select(F.col("source").alias("_of"), F.col("_bucket").alias("_in"), "_start", "rest")
    inside = sized.join(crossed, sized["_source"].eqNullSafe(crossed["_of"]) & (F.col("_bucket") == F.col("_in")))
    inside = inside.groupBy("_of", "_key", "_size", "_tag").agg(F.count("*").alias("_rows"), F.first("_start").alias("_start"), F.first("rest").alias("_rest"))
    upto = F.sum(F.col("_size") * F.col("_rows")).over(Window.partitionBy("_of").orderBy(place()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = inside.withColumn("_left", F.col("_rest") - F.col("_start") - upto + F.col("_size") * F.col("_rows"))
    at = inside.where("_left >= 0 and _left < _size * _rows").select(
        "_of", F.col("_key").alias("cut_key"), F.col("_size").alias("cut_size"), F.col("_tag").alias("cut_tag"), F.floor(F.col("_left") / F.col("_rows")).alias("cut_extra")
    )
    found = goals.join(at, F.col("source").eqNullSafe(F.col("_of")), "left")
    return written(found.select("source", "source_size", "target", "rounds", "cut_key", "cut_size", "cut_tag", "cut_extra"), "cuts")


def mix(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken of every row; the texts are not shuffled.

    A row's size is its number of words (null text: 0). Of a source, whole rounds are taken as often as its target
    holds them, then the rows in the order of their keys up to the rest (rounded down); the row that crosses it is
    taken in part. Keys are digests of the seed and doc_id, so reruns agree; rows that repeat a doc_id follow each
    other by size and text, and equal rows at the cut share it. A null source is a source of its own. An empty table
    gives no rows; other columns are not looked at.

    The one table that rows are joined with has a row for each source, which Spark broadcasts while it is small.
    """
    sized = sized_rows(df, seed, doc_id, text, source)
    found = sized.join(cuts(sized, weights, most), F.col("_source").eqNullSafe(F.col("source")))
    cut = F.struct("cut_key", "cut_size", "cut_tag")
    extra = F.when(F.col("cut_key").isNull(), F.lit(0)).when(place() < cut, F.col("_size")).when(place() == cut, F.col("cut_extra")).otherwise(0)
    taken = (F.col("rounds") * F.col("_size") + extra).cast("long")
    return found.select(F.col("_doc_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", taken.alias("taken"))


def mixed_rows(df: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: df's rows, each as often as the mix takes it.

    Rows stay whole: the one that crosses its source's budget is taken if half of it or more is within. Rows without
    words cost nothing and stay once.
    """
    found = keyed(df, seed, doc_id, text, source).join(cuts(sized_rows(df, seed, doc_id, text, source), weights, most), F.col("_source").eqNullSafe(F.col("source")))
    body = F.coalesce(F.col("_row").getField(text), F.lit(""))
    # Only a row with the key of the cut needs its size.
    own, cut = F.struct(word_count(body).alias("s"), "_tag"), F.struct("cut_size", "cut_tag")
    at_cut = F.when(own < cut, 1).when(own == cut, F.when(F.col("cut_extra") * 2 >= F.col("cut_size"), 1).otherwise(0)).otherwise(0)
    once_more = F.when(F.col("cut_key").isNull(), 0).when(F.col("_key") < F.col("cut_key"), 1).when(F.col("_key") > F.col("cut_key"), 0).otherwise(at_cut)
    times = F.when(~body.rlike(r"[^\x20\x09-\x0D]"), F.lit(1)).otherwise(F.col("rounds") + once_more).cast("int")
    return found.withColumn("_times", times).where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
