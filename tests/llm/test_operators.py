"""Each operator against a brute-force version, an exact round trip or its oracle SQL, on small and on awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, linechunks, merkle, mixing, ngram_model, simhash, substrings, topk, toxicity, warc
from tidemark.llm.common import connected_components
from tidemark.llm.q_ngram import op3_lm_scoring

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc long, tag int, size long, _row string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def words(n, seed, vocabulary=200):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def table(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, 7, 7, "x") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def awkward():
    shared, long = " ".join(words(70, 1)), " ".join(words(3000, 2))
    lines = "\n".join(" ".join(words(8, k)) for k in range(20))
    return [
        (5, "alpha " + shared + " omega", "b"), (2, shared, "a"), (9, shared, None), (9, "other text", "a"), (9, "other text", "a"),
        (1, None, None), (3, "", "c"), (4, "   \n\t ", "c"), (None, shared, "a"), (6, long, "b"), (7, long + " tail", "d"), (8, lines, "a"), (10, "head\n" + lines, "b"),
        (11, "Ünïcödé ß 日本語 🙂\x85\x1c end", "e"),
    ]


EMPTY: list = []


@pytest.fixture(params=["awkward", "empty"])
def docs(request, spark):
    rows = awkward() if request.param == "awkward" else EMPTY
    return rows, table(spark, rows)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (200, 200), (300, 299)]
    found = {(r.node, r.component) for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (102, 100), (299, 299), (300, 299)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_merkle_edits(docs):
    rows, df = docs
    found = merkle.edits(df).collect()
    order = sorted([(-(1 << 63) if i is None else i, t or "", i) for i, t, _ in rows])
    want = Counter()
    for k, (_, text, doc_id) in enumerate(order):
        follows = order[(k + 1) % len(order)][1]
        n = len(text)
        edited = text[: n - n // 4] + follows[: n // 4]
        want[doc_id, n, hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    prints = {}
    for r in found:
        prints.setdefault((r.edited_sha256), set()).add(r.edited_fingerprint)
    assert all(len(x) == 1 for x in prints.values())


def test_merkle_weighs_long_runs_whole(spark):
    """A run of 9,000 spaces has all its length: spans are cut before their length field ends."""
    texts = ["abc" + " " * 9_000 + ".x", "abc" + " " * 9_000 + ".y"]
    found = merkle.edits(table(spark, [(k, t, "a") for k, t in enumerate(texts)])).collect()
    assert all(0.2 < r.near_next < 1 for r in found)


def test_merkle_locates_edits(spark):
    lines = [f"paragraph {k} says {' '.join(words(12, k))}." for k in range(30)]
    changed = lines[:20] + ["something else."] + lines[21:]
    df = table(spark, [(1, "\n".join(lines), "a"), (2, "\n".join(lines), "a"), (3, "\n".join(changed), "a")])
    found = {r.doc_id: r for r in merkle.edits(df).collect()}
    assert found[1].fingerprint == found[2].fingerprint != found[3].fingerprint
    assert found[1].near_next == 1.0 and 0.9 < found[2].near_next < 1.0
    assert found[1].near_edited > 0.5 and found[1].first_changed > 20


def test_merkle_descends_only_where_branches_differ(spark):
    lines = [f"paragraph {k} says {' '.join(words(12, k))}." for k in range(60)] + ["\x01b marks \x01", "", "end"]
    one = ("\n".join(lines[:20] + ["one more line."] + lines[20:]), "\n".join(lines))
    trees = spark.createDataFrame([one, (one[1], one[1]), ("", one[1]), ("", "")], "x string, y string")
    for name, prefix in (("x", "a_"), ("y", "b_")):
        trees = merkle.with_tree(trees, name, prefix)
    found = merkle.with_likeness(trees, "a_", "b_", "like").select("like", F.size(F.array_except("a_paragraphs", "b_paragraphs")).alias("new"), F.array_except("a_branches", "b_branches").alias("open"), "a_branches", "a_sections").collect()
    assert found[0].new == 1 and 0.98 < found[0].like < 1 and [r.like for r in found[1:]] == [1.0, 0.0, 1.0]
    # Only the section that holds the new line is looked into, and each branch has its section's digest.
    assert 1 <= len(found[0].open) <= 2 < len(found[0].a_branches)
    assert [b[: merkle.DIGEST] for b in found[0].a_branches] == found[0].a_sections
    shared = sum(len(x.replace("\x01", "\x01a")) for x in lines)
    assert found[0].like == pytest.approx(shared / (shared + len("one more line.")), abs=0.01)


def brute_repeats(rows, window):
    """Kept words of each row, by the definition."""
    split = [(i, (t or "").encode().split()) for i, t, _ in rows]
    first: dict = {}
    for i, w in split:
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p : p + window])
                first[key] = min(first.get(key, i), i)
    for i, w in split:
        gone = set()
        if i is not None:
            for p in range(len(w) - window + 1):
                if first[tuple(w[p : p + window])] < i:
                    gone.update(range(p, p + window))
        yield i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()


def test_substrings(docs):
    rows, df = docs
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_digests(df, 50).collect())
    assert found == Counter(brute_repeats(rows, 50))


def test_substrings_random(spark):
    rnd = random.Random(5)
    pool = [words(rnd.randrange(40, 90), 100 + k, 10_000) for k in range(12)]
    rows = [(i, " ".join(w for _ in range(rnd.randrange(1, 6)) for w in (rnd.choice(pool) if rnd.random() < 0.7 else words(rnd.randrange(1, 60), i, 10_000))), "a") for i in range(60)]
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_digests(table(spark, rows), 50).collect())
    assert found == Counter(brute_repeats(rows, 50))


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def test_scores(docs):
    rows, df = docs
    found = sorted((str(r.doc_id), r.n_tokens, r.held_out, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in ngram_model.scores(df).collect())
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, ngram_model.tokens_of((t or "").encode())) for i, t, _ in rows]
    counts = Counter(w for i, ts in tokens if not held(i) for w in ts)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ts), held(i), sum(counts[w] > 0 for w in ts), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ts), 6)) for i, ts in tokens)
    assert found == want


def test_filter_bound_and_levels(spark):
    text = " ".join(words(4000, 3, 500))
    df = table(spark, [(i, text[i * 7 :], "a") for i in range(20)])
    out = ngram_model.scores(df).collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    small = ngram_model.scores(df, most_bits=1 << 19)
    assert small.count() == 20 and all(r.score < 0 for r in small.collect())
    train = df.select(F.col("text").cast("binary").alias("text"))
    counts, figures, data = ngram_model.train(train)
    exact = {bytes(r.token): r.c for r in counts.collect()}
    model = ngram_model.Model(data, figures, exact)
    keys = np.array([ngram_model.word_hash(w) for w in exact], np.uint64)
    levels = model.filter.levels(ngram_model.mix64(keys ^ ngram_model.WORD_SALT))
    want = np.array([sum(t <= c for t in ngram_model.LEVELS) for c in exact.values()])
    assert (levels >= want).all() and (levels == want).mean() > 0.9
    assert len(data) * 8 <= ngram_model.MOST_BITS


def brute_model(texts):
    """The model by its definition: p(word | context), the vocabulary and the probability of one unseen word."""
    v = lambda c: float(ngram_model.VALUE[sum(t <= c for t in ngram_model.LEVELS)])
    tokens = [ngram_model.tokens_of(t.encode()) for t in texts]
    words, pairs = Counter(w for ts in tokens for w in ts), Counter(p for ts in tokens for p in zip([ngram_model.END, *ts], ts))
    pairs = {p: v(c) for p, c in pairs.items() if c >= 2}
    once, n = sum(c == 1 for c in words.values()), sum(words.values())
    total, unseen = sum(map(v, words.values())), (once + 1) / (n + once + 1)
    sums = Counter()
    for (c, _), x in pairs.items():
        sums[c] += x
    figures = {}
    for c, x in sums.items():
        level, fine = ngram_model.context_codes(np.array([x]), np.array([float(words[c])]))
        code = int(level[0]) << ngram_model.FINE | int(fine[0])
        figures[c] = ngram_model.CONTEXT_SUM[code], ngram_model.CONTEXT_SHARE[code]
        assert figures[c][0] == pytest.approx(x, rel=0.009)

    def p(word, context):
        alone = (1 - unseen) * v(words[word]) / total if word in words else unseen / (len(words) + 1)
        s, share = figures.get(context, (1.0, 0.0))
        return share * min(pairs.get((context, word), 0) / s, 1.0) + (1 - share) * alone

    return p, words, unseen


def test_score_is_the_models_log_probability(spark):
    rows = [(i, " ".join(f"w{int(120 * random.Random(i * 999 + k).random() ** 3)}" for k in range(150)), "a") for i in range(40)]
    rows += [(100, None, "a"), (101, "never seen words", "a"), (102, "", "a")]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    p, words, _ = brute_model([t or "" for i, t, _ in rows if not held(i)])
    want = {}
    for i, t, _ in rows:
        tokens = ngram_model.tokens_of((t or "").encode())
        want[i] = sum(math.log10(p(w, c)) for c, w in zip([ngram_model.END, *tokens], tokens))
    found = {r.doc_id: r.score for r in ngram_model.scores(table(spark, rows)).collect()}
    assert {i: pytest.approx(x, abs=1e-6) for i, x in want.items()} == found
    for context in [*list(words)[:60], b"unknown"]:
        assert 0.99 < sum(p(w, context) for w in words) + (len(words) + 1) * p(b"?", context) < 1.01


def test_the_filters_probabilities_add_up_to_one_after_frequent_and_rare_contexts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("text").cast("binary").alias("text"))
    counts, figures, data = ngram_model.train(rows)
    exact = {bytes(r.token): r.c for r in counts.collect()}
    assert figures["least_pair"] == figures["least_word"] == 1 and len(exact) > 50_000
    model, words = ngram_model.Model(data, figures, {}), list(exact)
    ranked = sorted(words, key=lambda w: (-exact[w], w))
    contexts = [ranked[k] for k in (0, 1, 5, 20, 100, 500, 1_000, 3_000, 5_000, 10_000, 15_000)] + [b"never seen"]
    unseen = (figures["words"] + 1) * model.p_of[0]
    for context in contexts:
        share = float(ngram_model.CONTEXT_SHARE[model.filter.codes(ngram_model.context_keys(np.array([ngram_model.word_hash(context)], np.uint64)))[0]])
        assert 0.95 < model.after(context, words).sum() + (1 - share) * unseen < 1.01, (context, exact.get(context))


@pytest.mark.parametrize("most_bits", [400_000, 60_000, 20_000, 1_000])
def test_scores_do_not_depend_on_the_filter_bound(spark, most_bits):
    rows = [(i, " ".join(f"w{int(900 * random.Random(i * 1000 + k).random() ** 2)}" for k in range(300)), "a") for i in range(60)]
    df = table(spark, [*rows, *awkward()])
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.base_score, 6))
    bound, free = (sorted(ngram_model.scores(df, most_bits=n).collect(), key=key) for n in (most_bits, ngram_model.MOST_BITS))
    assert [key(r) for r in bound] == [key(r) for r in free]
    # The whole filter may take an n-gram for one that it holds; the counts never do.
    assert all(abs(a.score - b.score) < 1e-2 * abs(b.score) for a, b in zip(bound, free))
    held = [r for r in bound if r.held_out]
    assert held and sum(r.score for r in held) >= sum(r.base_score for r in held) - 1e-2 * len(held)


def brute_model_of_all_pairs(texts):
    """The same with the pairs that occur once; what a context gives to other words follows from its distinct pairs."""
    v = lambda c: float(ngram_model.VALUE[sum(t <= c for t in ngram_model.LEVELS)])
    tokens = [ngram_model.tokens_of(t.encode()) for t in texts]
    words, pairs = Counter(w for ts in tokens for w in ts), Counter(p for ts in tokens for p in zip([ngram_model.END, *ts], ts))
    once, n = sum(c == 1 for c in words.values()), sum(words.values())
    total, unseen = sum(map(v, words.values())), (once + 1) / (n + once + 1)
    sums, distinct, figures = Counter(), Counter(c for c, _ in pairs), {}
    for (c, _), x in pairs.items():
        sums[c] += v(x)
    for c, x in sums.items():
        level, fine = ngram_model.context_codes(np.array([x]), np.array([float(words[c])]), np.array([float(distinct[c])]))
        code = int(level[0]) << ngram_model.FINE | int(fine[0])
        figures[c] = ngram_model.CONTEXT_SUM[code], ngram_model.CONTEXT_SHARE[code]
        assert figures[c][1] == pytest.approx(x / (max(words[c], x) + distinct[c]), abs=1 / 32)

    def p(word, context):
        alone = (1 - unseen) * v(words[word]) / total if word in words else unseen / (len(words) + 1)
        s, share = figures.get(context, (1.0, 0.0))
        return share * min(v(pairs[context, word]) / s if (context, word) in pairs else 0.0, 1.0) + (1 - share) * alone

    return p, words, pairs


def test_the_query_learns_from_pairs_that_occur_once(spark, tmp_path):
    rows = [(i, " ".join(f"w{int(120 * random.Random(i * 999 + k).random() ** 3)}" for k in range(50)), "a") for i in range(40)]
    rows += [(100, None, "a"), (101, "never seen words", "a"), (102, "", "a"), (103, "only here w1 only", "a"), (103, "only here w1 only", "a")]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    p, words, pairs = brute_model_of_all_pairs([t or "" for i, t, _ in rows if not held(i)])
    single, want = 0, {}
    for i, t, _ in rows:
        tokens = ngram_model.tokens_of((t or "").encode())
        want[i] = sum(math.log10(p(w, c)) for c, w in zip([ngram_model.END, *tokens], tokens))
        single += held(i) and sum(pairs[c, w] == 1 for c, w in zip([ngram_model.END, *tokens], tokens))
    found = op3_lm_scoring(spark, str(tmp_path)).collect()
    assert single > 10 and len(found) == len(rows)
    assert {i: pytest.approx(x, abs=1e-6) for i, x in want.items()} == {r.doc_id: r.score for r in found}
    for context in [*list(words)[:60], b"unknown"]:
        assert 0.98 < sum(p(w, context) for w in words) + (len(words) + 1) * p(b"?", context) < 1.02


def test_the_probabilities_of_all_pairs_add_up_to_one_by_the_filter(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("text").cast("binary").alias("text"))
    counts, figures, data = ngram_model.train(rows, once=True)
    exact = {bytes(r.token): r.c for r in counts.collect()}
    assert figures["least_pair"] == figures["least_word"] == figures["least_once"] == 1
    model, words = ngram_model.Model(data, figures, {}), list(exact)
    ranked = sorted(words, key=lambda w: (-exact[w], w))
    for context in [ranked[k] for k in (0, 1, 5, 20, 100, 500, 3_000, 10_000, 15_000, 60_000)] + [b"never seen"]:
        of = np.array([ngram_model.word_hash(context)], np.uint64)
        share = float(ngram_model.CONTEXT_SHARE[model.contexts(of, model.filter.levels(ngram_model.word_keys(of)))[0]])
        assert 0.95 < model.after(context, words).sum() + (1 - share) * (figures["words"] + 1) * model.p_of[0] < 1.02, (context, exact.get(context))


@pytest.mark.parametrize("most_bits", [700_000, 400_000, 60_000, 1_000])
def test_scores_by_all_pairs_do_not_depend_on_the_filter_bound(spark, most_bits):
    rows = [(i, " ".join(f"w{int(900 * random.Random(i * 1000 + k).random() ** 2)}" for k in range(300)), "a") for i in range(60)]
    df = table(spark, [*rows, *awkward()])
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.base_score, 6))
    bound, free = (sorted(ngram_model.scores(df, most_bits=n, once=True).collect(), key=key) for n in (most_bits, ngram_model.MOST_BITS))
    assert [key(r) for r in bound] == [key(r) for r in free]
    assert all(abs(a.score - b.score) < 1e-2 * abs(b.score) + 0.2 for a, b in zip(bound, free))
    if most_bits <= 60_000:  # what the counts answer is the model's own
        every = [*rows, *awkward()]
        p, _, _ = brute_model_of_all_pairs([x or "" for i, x, _ in every if i is None or zlib.crc32(str(i).encode()) % 7 != 2])
        tokens = [(str(i), ngram_model.tokens_of((x or "").encode())) for i, x, _ in every]
        want = sorted((i, sum(math.log10(p(w, c)) for c, w in zip([ngram_model.END, *ts], ts))) for i, ts in tokens)
        assert [(i, pytest.approx(x, abs=1e-4)) for i, x in want] == sorted((str(r.doc_id), r.score) for r in bound)


def test_bpe(docs):
    rows, df = docs
    library = Tokenizer.from_file(PATH)
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, PATH).collect())
    want = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert found == want


def test_bpe_operator_keeps_columns(spark):
    df = table(spark, [(1, "Hello world", "a"), (2, None, "a"), (3, "<|endoftext|>x", "a")])
    out = bpe.decode_documents(bpe.encode_documents(df, PATH), PATH).orderBy("doc_id").collect()
    assert [r.decoded for r in out] == ["Hello world", "", "<|endoftext|>x"]
    assert out[2].token_ids[0] == 50256 and out[0]._row == "x"


def test_bpe_fuzz():
    library, coder = Tokenizer.from_file(PATH), bpe.transducer(PATH)
    rnd = random.Random(2)
    pieces = ["a", "th", "ing", "  ", " ", "\n", "\t", "\x1c", "\x85", "　", "é", "日本", "🙂", "'s", "'S", "12", "!!", "<|endoftext|>", "\r\n", "aaaa", "​"]
    for _ in range(1500):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(14)))
        assert [i for b in coder.encode(text) for i in b] == library.encode(text, add_special_tokens=False).ids, repr(text)
    for _ in range(5):
        text = "".join(rnd.choice("abcdeingtho") for _ in range(3000))
        assert [i for b in coder.encode(text) for i in b] == library.encode(text, add_special_tokens=False).ids
        data = text.encode()
        streamed = coder.stream(data[i : i + 7] for i in range(0, len(data), 7))
        assert [coder.ids[t] for t in streamed] == library.encode(text, add_special_tokens=False).ids


def test_bpe_encodes_each_word_of_many_texts_once(monkeypatch):
    library, rnd = Tokenizer.from_file(PATH), random.Random(5)
    parts = [" ", " ", " ", "\n", "ab", "the", "é", ".", ". ", ",", ", ", "'s", "1", "\t", "😀", "\x1c", "日本", "  "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(2000)] + [""]
    texts += [" ".join(rnd.choice(["alpha", "beta", "gamma"]) + rnd.choice(["", ",", "."]) for _ in range(500)) for _ in range(20)]
    asked, short = Counter(), bpe.Transducer._short
    monkeypatch.setattr(bpe.Transducer, "_short", lambda self, data: asked.update([data]) or short(self, data))
    for most in (bpe.MOST_PIECES, 40):  # a table that is full again and again
        monkeypatch.setattr(bpe, "MOST_PIECES", most)
        coder = bpe.PieceCoder(PATH)
        plain = [t for t, odd in zip(texts, coder.is_odd(pa.array(texts, pa.string()))) if not odd]
        asked.clear()
        ids, ends = coder.encode_plain(pa.array(plain, pa.string()))
        want = [library.encode(t, add_special_tokens=False) for t in plain]
        assert len(plain) > 900 and [x.tolist() for x in np.split(ids, ends[:-1])] == [x.ids for x in want]
        assert all(asked[f" {w}".encode()] == 1 for w in ("alpha", "beta", "gamma"))
        of_ids, of_texts = coder.digests(ids, ends)
        assert of_ids == [hashlib.sha256(",".join(map(str, x.ids)).encode()).hexdigest() for x in want]
        assert of_texts == [hashlib.sha256(t.encode()).hexdigest() for t in plain]


def test_bpe_of_long_pieces_long_texts_and_broken_bytes(spark, monkeypatch):
    library = Tokenizer.from_file(PATH)
    texts = ["plain text, plain.", "x" * 64 + " y", "ab" * 40 + " y", "é" * 70, "a    b", "the end " * 150_000, "", "<|endoftext|> x", "q\0r", b"bad \xff\xfe bytes"]
    rows = [(k, t if isinstance(t, bytes) else t.encode()) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, data binary").selectExpr("doc_id", "cast(data as string) text").repartition(1)
    found = {r.doc_id: r for r in bpe.round_trip(df, PATH, keep_ids=True).collect()}
    for k, data in rows:
        want = library.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids
        assert found[k].token_ids == want and found[k].n_tokens == len(want)
        assert found[k].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert found[k].decoded_sha256 == hashlib.sha256(data.decode("utf-8", "replace").encode()).hexdigest()


def test_incremental_decoding():
    coder = bpe.transducer(PATH)
    ids = [i for b in coder.encode("é🙂日") for i in b]
    assert "".join(coder.decode([i] for i in ids)) == "é🙂日"


def brute_simhash(rows, shingle=4, distance=4):
    def fp(t):
        w = (t or "").encode().lower().split()
        parts = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in parts]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0

    prints = [fp(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0]
            if same or bin(prints[a] ^ prints[b]).count("1") <= distance:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        yield i, f"{prints[k]:016x}", min(ids) if ids else None


def test_simhash(docs):
    rows, df = docs
    found = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert found == Counter(brute_simhash(rows))


def test_simhash_rows_without_id_link_others(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0), (None, 0b1111), (3, 0b11111111), (None, 0xFFFFFF << 30)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: df)
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert found == {(1, 1), (None, 1), (3, 1), (None, None)}


def test_substring_places_that_do_not_fit_are_an_error(monkeypatch):
    monkeypatch.setattr(substrings, "POS_BITS", 6)
    batch = substrings.pa.RecordBatch.from_pydict({"doc": [1], "text": [" ".join(words(64, 1)).encode()], "row": [0]})
    with pytest.raises(ValueError):
        list(substrings.hashed([batch], lambda n, row: substrings.anchor_starts(n), 50, True))


def shingle_sets(rows, size=5):
    words = {i: (t or "").encode().lower().split() for i, t, *_ in rows if i is not None}
    return {i: {b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} for i, w in words.items()}


def jaccards(rows):
    """Likeness of the shingle sets of all pairs of documents, by ids."""
    sets = sorted(shingle_sets(rows).items())
    return {(a, b): len(x & y) / len(x | y) for k, (a, x) in enumerate(sets) for b, y in sets[:k]}


def brute_alike(rows):
    """Smallest ids of the groups of likeness 0.8: pairs of 256-bit fingerprints within the bound, with three equal bytes of a triple, and alike by their shingle sets."""
    mask, prints = (1 << 64) - 1, {}
    sets = shingle_sets(rows)
    likeness = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    for i, shingles in sets.items():
        counts = [0] * 256
        for h in {xxhash.xxh64_intdigest(x, 42) for x in shingles if x}:
            for lane in range(4):
                x = (h + lane * 0x9E3779B97F4A7C15) & mask
                for _ in range(2):
                    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & mask
                x ^= x >> 32
                for b in range(64):
                    counts[64 * lane + b] += 1 if x >> b & 1 else -1
        prints[i] = sum(1 << b for b in range(256) if counts[b] > 0)
    triples = [[(p + s) % 32 for p in t] for t in simhash.TRIPLES for s in range(32)]
    root = {i: i for i in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            differing = prints[a] ^ prints[b]
            if b < a and differing.bit_count() <= 46 and any(not any(differing >> 8 * p & 255 for p in t) for t in triples) and likeness(a, b) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return sorted(set(root.values()))


def variants(seed=3, groups=4, size=6, words=300):
    """Texts in groups: each text has a few words of its group's first one replaced."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 5000, words)]
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, words, 3):
                text[at] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows) + 1, " ".join(text), "s"))
    return rows


def test_alike_keeps_one_of_each_group(spark, monkeypatch):
    rows = variants()
    for chunk in (simhash.CHUNK, 4):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        kept = sorted(r.doc_id for r in simhash.one_of_alike(table(spark, rows)).collect())
        assert kept == brute_alike(rows) == [1, 7, 13, 19]


def test_pairs_of_a_list_connect_what_all_pairs_connect():
    rng = np.random.default_rng(8)
    for n, distance in ((2, 46), (14, 46), (60, 46), (300, 46), (300, 20)):
        centres = rng.integers(0, 1 << 63, (5, 4)).astype(np.uint64)
        fps = centres[rng.integers(0, 5, n)]
        for _ in range(6):  # up to 6 * 4 flipped bits from a centre
            fps = fps ^ (np.uint64(1) << rng.integers(0, 64, fps.shape).astype(np.uint64)) * rng.integers(0, 2, fps.shape).astype(np.uint64)
        reps = np.arange(n) * 10
        bits = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
        pairs = simhash.near_pairs_within(reps, fps, distance, 0)
        assert all(bits[a // 10, b // 10] <= distance for a, b in pairs)

        def parts(links):
            root = {r: r for r in reps.tolist()}
            for a, b in links:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
            return root

        assert parts(pairs) == parts([(10 * a, 10 * b) for a, b in zip(*np.nonzero(bits <= distance))])
        assert n <= simhash.ALL_PAIRS or len(pairs) < n


def test_posting_lists_are_not_broadcast(spark, tmp_path):
    # A written table of classes is small, and Spark takes the lists made from it for as small.
    spark.range(1_000).selectExpr("id AS rep", "xxhash64(id) AS fp").write.parquet(str(tmp_path / "classes"))
    classes = spark.read.parquet(str(tmp_path / "classes"))
    joined = simhash.in_company(simhash.posting_lists(classes, simhash.covering(3, 4)))
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    for df in (joined, simhash.connected_components(links)):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_document_goes_only_through_pairs_that_are_alike(spark):
    # Likenesses from 0.65 to 0.95 of one base text: fingerprints alone would link those a little below 0.8 as well.
    base, rows = words(500, 31), []
    for i in range(40):
        text, changed = list(base), random.Random(i)
        for at in changed.sample(range(0, 500, 6), 2 + i // 2):
            text[at] = f"y{i}_{at}"
        rows.append((i + 1, " ".join(text), "s"))
    sets = shingle_sets(rows)
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    kept = {r.doc_id for r in simhash.one_of_alike(table(spark, rows)).collect()}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and like(a, b) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {i for i in sets if root[i] == i} <= kept and len(kept) <= len(set(root.values())) + 3
    assert len(kept) > 3


def test_columns_of_any_name_are_kept(spark):
    df = table(spark, variants()).withColumn("_nth", F.lit(7)).withColumn("_nth0", F.lit(8))
    for found in (simhash.one_of_alike(df), simhash.one_of_each_group(df)):
        assert found.columns == df.columns and {(r["_nth"], r["_nth0"]) for r in found.collect()} == {(7, 8)}


def test_removal_replaces_columns_named_as_its_results(spark):
    df = table(spark, [(1, "a\nb", "s"), (2, "a\nb", "s")]).withColumn("kept_text", F.lit("old")).withColumn("n_removed", F.lit(9))
    found = linechunks.remove_repeated_lines(df)
    assert sorted(found.columns) == sorted({*df.columns, "n_lines"}) and sorted((r.kept_text, r.n_removed) for r in found.collect()) == [("", 2), ("a\nb", 0)]


def test_alike_awkward_rows(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [(5, None, "s"), (4, "", "s"), (6, " \n", "s"), (None, base, "s"), (None, base, "s"), (9, base, "s"), (8, base + " end", "s"), (8, "quite another text of its own", "s"), (11, "Quite another text of its own", "s"), (12, "word", "s"), (12, "word", "s")]
    found = Counter((r.doc_id, r.text) for r in simhash.one_of_alike(table(spark, rows)).collect())
    # The rows of 8 are one document, which takes 9 and 11 with it.
    assert found == Counter({(4, ""): 1, (None, base): 2, (8, "quite another text of its own"): 1, (12, "word"): 1})
    assert simhash.one_of_alike(table(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.one_of_alike(table(spark, rows), similarity=0.5)


def test_simhash_large_groups_meet_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    base = words(400, 9)
    rows = [(i, " ".join(base[: 380 + i % 20] + [f"x{i}"]), "a") for i in range(60)] + [(100 + i, " ".join(words(50, 50 + i)), "a") for i in range(20)]
    found = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(table(spark, rows)).collect())
    assert found == Counter(brute_simhash(rows))


def test_covering_meets_every_pair():
    for size in (3, 4):
        sets = simhash.covering(size, 4)
        from itertools import combinations

        assert all(any(set(s) <= set(x) for s in sets) for x in combinations(range(8), 4))


def test_toxicity_learns(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        w = words(rnd.randrange(20, 80), i)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(["rotten", "vile", "nasty"]))
        rows.append((i, " ".join(w), "a"))
        labels.append((i, 0, int(toxic)))
    df = table(spark, [*rows, (1000, None, "a"), (1001, "", "a")])
    out = toxicity.scores(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id < 1000]
    right = sum((r.score >= 0.3) == (r.doc_id % 5 == 0) for r in held)
    assert right / len(held) > 0.95 and all(0 <= r.score <= 1 for r in out) and len(out) == 602


def test_toxicity_against_plain_numpy(spark):
    """n-grams, ratios, choice of features and regression by their definitions, without Spark."""
    rnd = random.Random(8)
    rows = [(i, " ".join(words(rnd.randrange(4, 12), i, 40) + (["vile", "rotten"] if i % 4 == 0 and i % 12 else [])), "a") for i in range(160)]
    labels = [(i, 0, int(i % 4 == 0)) for i in range(160)]

    def grams(t):
        x, found = (" " + t.lower() + " ").encode(), set()
        for size in (3, 4, 5):
            for k in range(len(x) - size + 1):
                h = size
                for byte in x[k : k + size]:
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ byte
                h ^= h >> 15
                found.add((h * 0x2C1B3C6D & 0xFFFFFFFF) >> 12)
        return found

    train = [(grams(t), y) for (i, t, _), (_, _, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic, clean = sum(y for _, y in train), sum(1 - y for _, y in train)
    seen = {g: (sum(g in x for x, y in train if y), sum(g in x for x, y in train if not y)) for g in set().union(*[x for x, _ in train])}
    p, q = ({g: (c[k] + 1) / (n + 2) for g, c in seen.items()} for k, n in ((0, toxic), (1, clean)))
    pooled = {g: (sum(c) + 1) / (toxic + clean + 2) for g, c in seen.items()}
    gain = {g: (p[g] - q[g]) ** 2 / (pooled[g] * (1 - pooled[g]) + 1e-9) for g in seen}
    best = sorted(seen, key=lambda g: (-gain[g], g))[: toxicity.FEATURES]
    ratio = np.array([math.log(p[g] / q[g]) for g in best])
    x = np.array([[float(g in of) for g in best] for of, _ in train]) * ratio
    y, w, b = np.array([y for _, y in train]), np.zeros(len(best)), 0.0
    for _ in range(30):  # Newton's method in the span of the rows and the intercept
        z = 1 / (1 + np.exp(-(x @ w + b)))
        a = np.column_stack([x, np.ones(len(x))])
        gradient = a.T @ (z - y) / len(y) + np.append(2e-3 * w, 0)
        hessian = (a.T * (z * (1 - z))) @ a / len(y) + np.diag(np.append(np.full(len(w), 2e-3), 1e-9))
        step = np.linalg.solve(hessian, gradient)
        w, b = w - step[:-1], b - step[-1]
    want = {i: 1 / (1 + math.exp(-(b + sum(w[k] * ratio[k] for k, g in enumerate(best) if g in grams(t))))) for i, t, _ in rows}
    found = toxicity.scores(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rounds=300).collect()
    assert max(abs(r.score - want[r.doc_id]) for r in found) < 0.03


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.scores(table(spark, awkward()), labels).collect()} == {0.5}
    assert toxicity.scores(table(spark, []), labels).count() == 0
    one = spark.createDataFrame([(5, 0, 1), (6, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.scores(table(spark, awkward()), one).count() == len(awkward())


def water(sizes: dict, most=3):
    """Targets by resharing round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left, open_ = total - sum(most * sizes[s] for s in full), [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        more = {s for s in open_ if share[s] >= most * sizes[s]}
        if not more:
            return {s: float(most * sizes[s]) if s in full else share[s] for s in order}
        full |= more


def test_mixing(docs):
    rows, df = docs
    found = mixing.mix(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    assert len(found) == len(rows)
    if not rows:
        return
    goal = water(sizes)
    by_source = {sizes[s]: goal[s] for s in sizes}
    for r in found:
        assert r.target == pytest.approx(by_source[r.source_size]) and 0 <= r.taken <= 3 * r.size
    assert sum(r.taken for r in found) == pytest.approx(sum(goal.values()), abs=len(goal))


def test_mixing_uneven_sources(spark):
    rows = [(i, " ".join(words(5 + i % 9, i)), f"s{i % 7 if i % 3 else 0}") for i in range(300)] + [(1000, "one two", "tiny"), (1001, "", "zero")]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    goal, taken, df = water(sizes), Counter(), table(spark, rows)
    by_id = {i: s for i, _, s in rows}
    for r in mixing.mix(df).collect():
        assert r.target == pytest.approx(goal[by_id[r.doc_id]])
        taken[by_id[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in mixing.mix(df).collect()}
    mixed = Counter(r.source for r in mixing.mixed_rows(df).collect())
    assert mixed["tiny"] == 3 and mixed["zero"] == 1


def brute_lines(rows, divisor=2):
    """Chunks of all phases by the definition, row by row."""
    first: dict = {}
    parts = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        rolled = [-1] + [(h[k] + 31 * h[k - 1]) // 65_536 % divisor for k in range(1, len(h))]
        chunks = set()
        for phase in range(divisor):
            ends = [k + 1 for k in range(len(h)) if k == len(h) - 1 or rolled[k] == phase]
            chunks |= {(s, e) for s, e in zip([0, *ends], ends) if e - s > 1}
        parts.append((i, (t or ""), lines, chunks))
        for a, b in chunks if i is not None else ():
            body, place = "\n".join(lines[a:b]), (i, xxhash_signed(t or ""), a, b)
            first[body] = min(first.get(body, place), place)
    for i, t, lines, chunks in parts:
        gone = {k for a, b in chunks if i is not None and first["\n".join(lines[a:b])] < (i, xxhash_signed(t), a, b) for k in range(a, b)}
        yield i, len(lines), len(gone), hashlib.sha256("\n".join(x for k, x in enumerate(lines) if k not in gone).encode()).hexdigest()


def xxhash_signed(t):
    return int(np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).astype(np.int64))


def test_lines(docs):
    rows, df = docs
    found = Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in linechunks.removal_digests(df).collect())
    assert found == Counter(brute_lines(rows))


def test_lines_find_back_behind_an_edit(spark):
    lines = [" ".join(words(6, k, 5000)) for k in range(60)]
    rows = [(1, "\n".join(lines), "a"), (2, "\n".join(["new start", "of it", *lines]), "a"), (3, "all\nnew", "a")]
    found = {r.doc_id: r for r in linechunks.remove_repeated_lines(table(spark, rows)).collect()}
    assert found[1].n_removed == 0 and found[3].n_removed == 0 and found[2].n_removed > 50 and found[3]._row == "x"
    assert Counter((r[0], r[2]) for r in brute_lines(rows)) == Counter((i, r.n_removed) for i, r in found.items())


def test_lines_recall_of_planted_passages(spark):
    """Passages of 2 to 6 lines between other lines: those with a whole chunk inside go; whole copies go altogether."""
    fresh = iter(range(100_000))
    line = lambda: " ".join(words(9, next(fresh), 50_000))
    passages = [[line() for _ in range(2 + k % 5)] for k in range(150)]
    texts = [["\n".join([line(), line(), *p, line(), line()]) for p in passages] for _ in range(2)]
    rows = [(k, t, "a") for k, t in enumerate(texts[0] + texts[1])] + [(1_000 + k, t, "a") for k, t in enumerate(texts[0])]
    found = {r.doc_id: r.n_removed for r in linechunks.remove_repeated_lines(table(spark, rows)).collect()}
    planted = sum(map(len, passages))
    assert all(found[k] == 0 for k in range(150)) and all(found[1_000 + k] == len(p) + 4 for k, p in enumerate(passages))
    gone = sum(found[150 + k] for k in range(150))
    long_ = [k for k, p in enumerate(passages) if len(p) == 6]
    assert 0.2 * planted < gone <= planted and sum(found[150 + k] for k in long_) > 0.3 * 6 * len(long_)


PAGES = "page_id long, url string, html string, last long, payload string"


def test_warc(spark):
    big = "<p>" + "x" * 50_000 + "é</p>"
    rows = [(1, "http://a", big), (2, "http://b", big), (7, None, big), (3, "http://c", "short"), (4, "http://d", "short"), (5, "http://e\r\nX: y", None), (6, "", ""), (8, "http://f", "y" * 1000), (8, "http://f", "y" * 1000), (None, "http://g", big), (9, "h", "WARC/1.1\r\n\r\n" * 300)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], PAGES)
    found = Counter(tuple(r) for r in warc.round_trip(df, segment=4_096).collect())
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
        revisit = i is not None and len(data) >= 1000 and i < max(same)
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None] += 1
    assert found == want
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_finds_damage():
    payload = b"abc" * 5000
    parts = list(warc.records_of(1, "u", payload, None, False, 1_000, 300))
    data = b"".join(p + b"\r\n\r\n" for p in parts)
    heads = list(warc.parsed(data))
    assert len(heads) == len(parts) > 10 and heads[-1][0]["warc-segment-total-length"]
    body = warc.ChunkedBody()
    assert b"".join(x for _, b in heads for x in body.feed(b)) == payload
    with pytest.raises(ValueError):
        list(warc.parsed(data[:-900]))
    short = warc.ChunkedBody()
    list(short.feed(heads[0][1]))
    with pytest.raises(ValueError):
        short.close()


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.2, (900, 16)).astype(np.float32).tolist()
    vectors[100] = vectors[50] = vectors[51] = vectors[0]
    rows = [(i, v, 1, 2) for i, v in enumerate(vectors)] + [(2000, None, 1, 2), (2001, [float("nan")] * 16, 1, 2), (2050, [None] * 16, 1, 2), (2051, [float("inf")] * 16, 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, g int, ids int")
    m = np.floor(256 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64)
    want = set()
    for q in range(0, 900, 50):
        scores = m @ m[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:5]
        want |= {(q, n, i, int(scores[i])) for n, i in enumerate(order, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect()} == want
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id in (0, 7)")).count() == 1


def test_top_k_of_large_values(spark):
    vectors = [[1e6 + i, 3e6 - 7 * i, 2e6] for i in range(60)]
    found = topk.top_k(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), k=3)
    m = [[int(256 * x) for x in v] for v in vectors]
    want = set()
    for q in (0, 50):
        s = sorted(((sum(a * b for a, b in zip(m[q], m[i])), i) for i in range(60) if i != q), key=lambda x: (-x[0], x[1]))[:3]
        want |= {(q, n, i, x) for n, (x, i) in enumerate(s, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()} == want
    with pytest.raises(OverflowError):
        topk.top_k(spark.createDataFrame([(0, [1e9])], "vec_id long, embedding array<double>"))


def test_top_k_prunes():
    rng = np.random.default_rng(1)
    near, far = rng.integers(900, 1000, (256, 8)).astype(float), rng.integers(0, 10, (256 * 9, 8)).astype(float)
    matrix, ids = np.concatenate([far, near]), np.arange(256 * 10)
    visited: list = []
    found = topk.best_in_range(np.array([-1]), near[:1], ids, matrix, 3, visited=visited)
    assert sum(visited) == 1  # of ten blocks
    scores = matrix @ near[0]
    assert [f[1] for f in found] == sorted(range(len(ids)), key=lambda i: (-scores[i], i))[:3]


def test_alike_pairs_beside_the_nearest_ones_of_a_list_link(spark, monkeypatch):
    # In one long list the nearest pair of each member is not alike, a farther one is.
    calls, near = [], simhash.links_in_tasks

    def only_nearest(dealt, words_, distance, least, within=simhash.links_within, of_lists=simhash.links_of_lists):
        calls.append(of_lists)
        return near(dealt, words_, distance, least, within, of_lists)

    monkeypatch.setattr(simhash, "links_in_tasks", only_nearest)
    monkeypatch.setattr(simhash, "ALL_PAIRS", 1)
    rng = random.Random(0)
    base, rows = words(400, 77), []
    for n in range(24):
        own = list(base)
        for at in rng.sample(range(400), 5):
            own[at] = f"v{rng.randrange(10**6)}"
        rows.append((n, " ".join(own), "s"))
    kept = sorted(r.doc_id for r in simhash.one_of_alike(table(spark, rows)).collect())
    assert simhash.links_across in calls and kept == brute_alike(rows)


def test_pairs_across_components_are_all_found():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, (1, 4)) ^ (np.int64(1) << rng.integers(0, 60, (300, 4))) * rng.integers(0, 2, (300, 4))
    of = rng.integers(0, 5, 300)
    rows = np.column_stack((np.repeat([1, 2, 3], 100), np.zeros(300, np.int64), np.arange(300), fps, of))
    bits = np.bitwise_count((fps[:, None] ^ fps[None]).view(np.uint64)).sum(axis=2)
    want = [(a, b) for a in range(300) for b in range(a + 1, 300) if a // 100 == b // 100 and of[a] != of[b] and bits[a, b] <= 5]
    assert want and sorted(map(tuple, simhash.links_across(rows, 5, 0).tolist())) == want
    assert not len(simhash.links_across(rows[of == 1], 5, 0))


def test_a_large_group_is_not_compared_by_rows_of_pairs(spark, monkeypatch):
    # Sixty texts within reach of each other, most pairs of which are not alike: all pairs would be 1,770 rows.
    given, compare = [], simhash.alike_links
    monkeypatch.setattr(simhash, "alike_links", lambda pairs, *more: given.append(pairs.count()) or compare(pairs, *more))
    rng = random.Random(5)
    base, rows = words(400, 99), []
    for n in range(60):
        own = list(base)
        for at in rng.sample(range(400), 5 + n % 4):
            own[at] = f"v{rng.randrange(10**6)}"
        rows.append((n, " ".join(own), "s"))
    likes = jaccards(rows)
    assert sum(x < 0.8 for x in likes.values()) > 0.9 * len(likes)
    for size in (simhash.SET_BYTES, 16 << 10):  # as a whole and in chunks
        monkeypatch.setattr(simhash, "SET_BYTES", size)
        kept = sorted(r.doc_id for r in simhash.one_of_alike(table(spark, rows)).collect())
        assert kept == brute_alike(rows) and 1 < len(kept) < 60
        assert sum(given) < 60
        given.clear()


def test_links_across_by_sets_are_trees_of_alike_members():
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate((np.arange(k % 3 * 100, k % 3 * 100 + 60), rng.integers(10**6, 10**9, k % 9)))).astype(np.uint32) for k in range(90)] + [np.zeros(0, np.uint32)]
    rows = np.column_stack((np.ones(91, np.int64), np.zeros(91, np.int64), np.arange(91), np.zeros((91, 4), np.int64), np.arange(91)))
    found = simhash.links_across(rows, 46, 3, simhash.by_sets(0.8)(np.array([x.tobytes() for x in sets], object))).tolist()
    root = list(range(91))
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            both = len(np.intersect1d(x, y))
            if both >= 0.8 * (len(x) + len(y) - both):
                low, high = sorted((root[a], root[b]))
                root = [low if v == high else v for v in root]
    tree = list(range(91))
    for a, b in found:
        assert tree[a] != tree[b]
        low, high = sorted((tree[a], tree[b]))
        tree = [low if v == high else v for v in tree]
    assert tree == root and len(set(root)) == 4
