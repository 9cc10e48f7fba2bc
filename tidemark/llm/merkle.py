"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

Paragraphs are lines. A section ends after a blank paragraph, or after one whose digest starts with 0 to 3, so that
sections find back to the same borders behind an edit. A section's digest covers its paragraphs' digests, the root
covers the sections'. Likeness descends two trees: sections with equal digests count by their length and are not looked
into; of the others, equal paragraphs do; only the paragraphs that are then left are cut into spans (parts of sentences).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: a span ends with a run of these marks and the spaces behind it, or after 64 characters of each kind.
SPAN = r"[^.,;:!?]{1,64}[.,;:!?]{0,64}[ ]{0,64}|[.,;:!?]{1,64}[ ]{0,64}"
#: Documents in a block of neighbours, and the most blocks that are dealt.
BLOCK_ROWS, MOST_BLOCKS = 64, 2_048


#: A character that marks ends inside of joined paragraphs, what stands for it there, and the ends of a section and of a paragraph.
MARK, MARKED, SECTION, PARAGRAPH = "\x01", "\x01a", "\x01b", "\x01c"
#: Characters of a digest in hex.
DIGEST = 64


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """df with `prefix`paragraphs and `prefix`sections (arrays of digests), `prefix`branches (each section's digest and paragraphs) and `prefix`root of a non-null text column."""
    lines, paragraphs = F.split(F.col(text), "\n"), F.col(f"{prefix}paragraphs")
    df = df.withColumn(f"{prefix}lines", lines)
    marked = F.transform(
        F.col(f"{prefix}lines"), lambda p: F.concat(F.sha2(p, 256), F.when(F.trim(p) == "", "|").otherwise(""))
    )
    df = df.withColumn(f"{prefix}paragraphs", marked)
    is_end = lambda d: d.rlike(r"^[0-3]|\|$")
    joined = F.array_join(F.transform(paragraphs, lambda d: F.when(is_end(d), F.concat(F.rtrim(d, F.lit("|")), F.lit("|"))).otherwise(d)), "")
    groups = F.filter(F.split(joined, r"\|"), lambda g: g != "")
    df = df.withColumn(f"{prefix}sections", F.transform(groups, lambda g: F.sha2(g, 256)))
    cut = F.zip_with(f"{prefix}lines", f"{prefix}paragraphs", lambda p, d: F.concat(F.replace(p, F.lit(MARK), F.lit(MARKED)), F.when(is_end(d), SECTION).otherwise(PARAGRAPH)))
    # A last section that has its end leaves an empty piece behind it, which meets no digest.
    pieces = F.slice(F.split(F.array_join(cut, ""), SECTION), F.lit(1), F.size(f"{prefix}sections"))
    return (
        df.withColumn(f"{prefix}branches", F.zip_with(f"{prefix}sections", pieces, lambda d, t: F.concat(d, t)))
        .withColumn(f"{prefix}root", F.sha2(F.array_join(f"{prefix}sections", ""), 256))
        .drop(f"{prefix}lines")
    )


def _paragraphs(branches: Column) -> Column:
    """The distinct paragraphs of branches."""
    return F.array_distinct(F.flatten(F.transform(branches, lambda x: F.split(F.substring(x, DIGEST + 1, F.length(x)), PARAGRAPH))))


def _spans(paragraphs: Column) -> Column:
    """The distinct spans of paragraphs: the low 12 bits of a span's value are its length, 192 at most, the others its hash."""
    found = F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p, F.lit(SPAN), F.lit(0))))
    return F.array_distinct(F.transform(found, lambda x: F.xxhash64(x).bitwiseAND(F.lit(-4096)).bitwiseOR(F.length(x).cast("long"))))


def _total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + of(x))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """df with the likeness of two trees: the length of what they share over that of all they have, from 0 to 1; equal roots give 1."""
    both = lambda kind: (F.array_intersect(f"_a_{kind}", f"_b_{kind}"), F.array_except(f"_a_{kind}", f"_b_{kind}"), F.array_except(f"_b_{kind}", f"_a_{kind}"))
    length = lambda kept: lambda x: (F.length(x) - kept).cast("long")
    df = df.withColumns({"_a_branch": F.col(f"{a}branches"), "_b_branch": F.col(f"{b}branches")})
    same, own, other = both("branch")
    df = df.withColumns({"_sections": _total(same, length(DIGEST)), "_a_line": _paragraphs(own), "_b_line": _paragraphs(other)})
    same, own, other = both("line")
    df = df.withColumns({"_lines": _total(same, length(0)), "_a_span": _spans(own), "_b_span": _spans(other)})
    weight = lambda x: x.bitwiseAND(F.lit(4095))
    shared, every = (F.col("_sections") + F.col("_lines") + _total(x, weight) for x in (F.array_intersect("_a_span", "_b_span"), F.array_union("_a_span", "_b_span")))
    like = F.when(F.col(f"{a}root") == F.col(f"{b}root"), 1.0).when(every == 0, 0.0).otherwise(shared / F.greatest(every, F.lit(1)))
    return df.withColumn(name, like).drop("_sections", "_lines", *[f"_{x}_{kind}" for x in "ab" for kind in ("branch", "line", "span")])


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with next_text, the text of the next doc_id; the last document's is the first's.

    A window over all rows would be one task. Percentiles of doc_id, themselves ids of the table, cut it into blocks
    instead; the first document of each block is dealt to the block before it too, where it only stands as a next one.
    Rows with equal ids follow each other by text; null ids come first.
    """
    keyed = docs.withColumn("_k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = keyed.count()
    blocks = max(1, min(MOST_BLOCKS, n // BLOCK_ROWS))
    shares = F.array(*[F.lit(i / blocks) for i in range(blocks)])
    found = keyed.agg(F.min("_k").alias("low"), F.percentile_approx("_k", shares, F.lit(max(10_000, 4 * blocks))).alias("cuts")).first()
    cuts = sorted({found["low"], *(found["cuts"] or [])}) if n else [0]
    bounds = F.array(*[F.lit(x).cast("long") for x in cuts])
    # How many bounds are not above the id, counted by halves of an inner list of every 64th bound.
    coarse = F.array(*[F.lit(x).cast("long") for x in cuts[::64]])
    upper = F.size(F.filter(coarse, lambda b: b <= F.col("_k")))
    inner = F.slice(bounds, (upper - 1) * 64 + 1, 64)
    block = (upper - 1) * 64 + F.size(F.filter(inner, lambda b: b <= F.col("_k"))) - 1
    placed = keyed.withColumn("_block", block)
    first = F.element_at(bounds, F.col("_block") + 1) == F.col("_k")
    before = F.pmod(F.col("_block") - 1, F.lit(len(cuts)))
    own, halo = F.struct(F.col("_block").alias("b"), F.lit(False).alias("halo")), F.struct(before.alias("b"), F.lit(True).alias("halo"))
    dealt = placed.select("doc_id", "text", "_k", F.explode(F.when(first, F.array(own, halo)).otherwise(F.array(own))).alias("_d"))
    # In the last block the first document of all stands last.
    order = Window.partitionBy("_d.b").orderBy(F.col("_d.halo"), "_k", "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("not _d.halo").select("doc_id", "text", "next_text")


def edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text, and the likeness of both and of the next document.

    The edited text has the last quarter (rounded down) of its characters replaced by the first as many of the next
    document's. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_paragraphs, n_sections, changed_sections and changed_paragraphs (of the edited text's, how many are new) and
    first_changed (number of the first paragraph that differs, from 1; 0 if none does). Null texts are read as empty; two empty texts
    are alike (1). A table of one document is its own next one. Other columns are not looked at.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    docs = docs.withColumn(
        "edited",
        F.concat(F.expr("substring(text, 1, int(n_chars) - int(n_chars div 4))"), F.substring("next_text", F.lit(1), quarter)),
    )
    docs = docs.withColumn("edited_sha256", F.sha2("edited", 256))
    docs = with_tree(with_tree(with_tree(docs, "text", "a_").drop("text"), "edited", "b_").drop("edited"), "next_text", "c_").drop("next_text")
    docs = with_likeness(with_likeness(docs, "a_", "b_", "near_edited"), "a_", "c_", "near_next")
    same = F.zip_with("a_paragraphs", "b_paragraphs", lambda x, y: x.eqNullSafe(y))
    return docs.select(
        "doc_id", "n_chars", "edited_sha256",
        F.col("a_root").alias("fingerprint"), F.col("b_root").alias("edited_fingerprint"),
        "near_edited", "near_next",
        F.size("a_paragraphs").cast("long").alias("n_paragraphs"), F.size("a_sections").cast("long").alias("n_sections"),
        F.size(F.array_except("b_sections", "a_sections")).cast("long").alias("changed_sections"), F.size(F.array_except("b_paragraphs", "a_paragraphs")).cast("long").alias("changed_paragraphs"),
        F.array_position(same, False).cast("long").alias("first_changed"),
    )
