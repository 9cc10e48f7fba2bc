"""The pipeline stage by stage against brute-force versions on the smallest tables, and on awkward rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
from test_operators import brute_alike, brute_lines, jaccards, water
from tokenizers import Tokenizer

from tidemark.llm.common import written

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = dict(corpus_pipeline.STAGES)
    calm = written(named["toxicity"](spark, docs, SF), "t")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    every, left = {r.doc_id for r in docs.collect()}, {r.doc_id for r in calm.collect()}
    assert len(every - left) < 0.25 * len(every) and len(toxic - left) > 0.6 * len(toxic)

    cut = written(named["line_dedup"](spark, calm, SF), "l")
    rows = texts(calm)
    want = {i: d for i, n, gone, d in brute_lines(rows) if gone}
    got = {r.doc_id: r.text for r in cut.collect()}
    gone = hashlib.sha256(b"").hexdigest()
    for i, t, _ in rows:
        if i not in want:
            assert got[i] == t
        elif want[i] == gone:
            assert i not in got
        else:
            assert hashlib.sha256(got[i].encode()).hexdigest() == want[i]
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    one = written(named["near_dedup"](spark, cut, SF), "n")
    kept = sorted(r.doc_id for r in one.collect())
    assert kept == brute_alike(texts(cut))
    likes = jaccards(texts(cut))
    unlinked = [p for p, j in likes.items() if j >= 0.8 and set(p) <= set(kept)]
    assert len(unlinked) <= 0.1 * sum(j >= 0.8 for j in likes.values())
    near = {d for p, j in likes.items() if j >= 0.6 for d in p}
    assert {r.doc_id for r in cut.collect()} - near <= set(kept)

    mixed = written(named["mixing"](spark, one, SF), "m")
    sizes, taken = Counter(), Counter()
    for _, t, s in texts(one):
        sizes[s] += len(t.encode().split())
    for _, t, s in texts(mixed):
        taken[s] += len(t.encode().split())
    longest = max(len(t.split()) for _, t, _ in texts(one))
    assert all(abs(taken[s] - g) <= longest for s, g in water(sizes).items())
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3

    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    for (i, t, _), r in zip(sorted(texts(mixed)), sorted(named["bpe"](spark, mixed, SF).collect(), key=lambda r: (r.doc_id, r.decoded_sha256))):
        assert r.doc_id == i and r.token_ids == library.encode(t, add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one line", "en", "a", 8), (3, "one line", "en", "a", 8), (None, "no id", "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            some = written(stage(spark, some, SF), name)
            if name != "bpe":
                assert some.columns == corpus_pipeline.COLUMNS
    assert some.count() == 0
