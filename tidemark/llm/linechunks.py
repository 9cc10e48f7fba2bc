"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A line's hash is a number from its digest; the rolling hash of a line covers it and the line before. Its value modulo the
divisor is the line's phase, and every phase gives a chunking of its own: a document is cut after each line that has the
phase. Borders depend on two lines only, so a passage that moves finds back to the same borders; no line is a border of
two chunkings, so what is the edge of a chunk in one lies inside a chunk of another. Chunks of two lines or more that
occur again are compared byte by byte, and the lines of all but the first are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The multiplier of the rolling hash, and the bits below those that decide the phase.
STEP, LOW = 31, 65_536
#: Places of a chunk that meet its first one in one task.
SHARE = 1_024


def with_chunks(df: DataFrame, text: str, divisor: int = 2) -> DataFrame:
    """df with `lines` and `chunks`, an array of (s, e): lines s to e - 1, two or more, of the chunkings of a non-null text."""
    df = df.withColumn("lines", F.split(F.col(text), "\n"))
    df = df.withColumn("_hashes", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")))
    rolled = F.transform("_hashes", lambda h, i: F.when(i == 0, -1).otherwise(F.floor((h + F.get("_hashes", i - 1) * STEP) / LOW) % divisor))
    df = df.withColumn("_rolled", rolled)
    found = []
    for phase in range(divisor):
        df = df.withColumn(f"_cuts{phase}", _cuts(phase))
        found.append(_between(F.col(f"_cuts{phase}")))
    chunks = F.transform(F.array_distinct(F.concat(*found)), lambda c: F.struct(F.shiftright(c, 32).cast("int").alias("s"), c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("e")))
    return df.withColumn("chunks", chunks).drop("_hashes", "_rolled", *[f"_cuts{phase}" for phase in range(divisor)])


def _cuts(phase: int) -> Column:
    """How many lines stand before each border of a phase; the last border is the text's end."""
    n = F.size("lines")
    return F.filter(F.sequence(F.lit(1), n), lambda e: (e == n) | (F.get("_rolled", e - 1) == phase))


def _between(cuts: Column) -> Column:
    """Stretches of two lines or more between borders: s and e in one number."""
    number = lambda s, e: F.when(e - s > 1, F.shiftleft(s.cast("long"), 32).bitwiseOR(e.cast("long")))
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(cuts, k - 1))
    return F.filter(F.transform(cuts, lambda e, k: number(start(k), e)), lambda c: c.isNotNull())


def body_of(s: Column, e: Column) -> Column:
    return F.array_join(F.slice("lines", s + 1, e - s), "\n")


def removed_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """(doc_id, tag, gone: array of (s, e)): chunks that an earlier place holds already, of (doc_id, text).

    Only 64-bit hashes of all chunks are counted; a chunk's places are counted in shares by document, so that a very
    frequent one is spread. The bodies of those that occur again are then compared with the first place of the same
    bytes, each SHARE of them in a task of its own.
    """
    keyed = docs.withColumn("tag", F.xxhash64("text"))
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.transform("chunks", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.xxhash64(body_of(c["s"], c["e"])).alias("v")))
    hashes = with_chunks(keyed, "text", divisor).select("doc_id", "tag", F.explode(hashed).alias("c")).select("doc_id", "tag", "c.s", "c.e", "c.v")
    hashes = hashes.withColumn("share", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(shares)))
    counts = hashes.groupBy("v", "share").agg(F.count("*").alias("own"))
    again = counts.groupBy("v").agg(F.sum("own").alias("n"), F.collect_set("share").alias("of")).where("n > 1").select("v", "n", F.explode("of").alias("share"))
    places = hashes.join(again, ["v", "share"]).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("s", "e", "n")).alias("maybe"))
    bodies = keyed.join(places, ["doc_id", "tag"]).withColumn("lines", F.split("text", "\n"))
    bodies = bodies.select("doc_id", "tag", F.explode(F.transform("maybe", lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), m["n"].alias("n"), body_of(m["s"], m["e"]).alias("body")))).alias("c"))
    place = F.struct("doc_id", "tag", "s", "e")
    bodies = bodies.select("doc_id", "tag", "c.s", "c.e", "c.body", F.xxhash64("c.body").alias("v"), F.ceil(F.col("c.n") / SHARE).cast("int").alias("parts"))
    first = bodies.groupBy("v", "body").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.max("parts").alias("parts")).where("n > 1")
    # Bytes decide which chunks are one; its places then find it by a digest of them, so that bodies are shuffled once.
    digest = F.unhex(F.sha2("body", 256))
    first = first.select("v", digest.alias("of"), "first", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = bodies.select("doc_id", "tag", "s", "e", "v", digest.alias("digest"), F.pmod(F.xxhash64("doc_id", "tag", "s"), F.col("parts")).cast("int").alias("part"))
    later = own.join(first, ["v", "part"]).where((F.col("digest") == F.col("of")) & (place > F.col("first")))
    return later.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("s", "e")).alias("gone"))


def remove_repeated_lines(df: DataFrame, divisor: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with kept_text, n_lines and n_removed: the text without lines of chunks that stand earlier in the corpus.

    Places are ordered by doc_id, then by line; the first of equal chunks stays, unless its lines are repeats in turn, of
    a still earlier place. A text of one line loses nothing, and a text from which nothing is removed comes back as it
    is. Null texts are read as empty and have one empty line. Rows that repeat a doc_id are ordered by a hash of their
    text; equal rows lose the same chunks, and none if no other row has them. Rows with a null doc_id keep everything.
    All other columns stay as they are; those named as a result are replaced. Time and memory grow with a text's lines in proportion.
    """
    body = lambda column: F.coalesce(column, F.lit(""))
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), body(F.col(text)).alias("text")).where("doc_id is not null")
    # The row passes the exchange once; its text is taken out of it again behind the join.
    own = df.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body(F.col(text))).alias("tag"))
    whole = own.join(removed_chunks(docs, divisor), ["doc_id", "tag"], "left").withColumn("lines", F.split(body(F.col("_row").getField(text)), "\n"))
    removed = F.array_distinct(F.flatten(F.transform("gone", lambda g: F.sequence(g["s"], g["e"] - 1))))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("_removed", F.array().cast("array<int>")))
    return (
        whole.withColumn("_removed", removed)
        .withColumn("_left", left)
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_removed", F.col("n_lines") - F.size("_left"))
        .withColumn("kept_text", F.array_join(F.transform("_left", lambda i: F.get("lines", i)), "\n"))
        .select(*[F.col("_row").getField(c).alias(c) for c in df.columns if c.lower() not in ("kept_text", "n_lines", "n_removed")], "kept_text", "n_lines", "n_removed")
    )


def removal_digests(df: DataFrame, divisor: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that is kept."""
    found = remove_repeated_lines(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), divisor)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
