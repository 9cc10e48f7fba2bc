"""Token files (op11), conversation repair (op12) and periodic runs (op13) against plain Python and the library itself."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import conversations, periodic, q_conversations, q_periodic, token_files
from tidemark.llm.common import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, start string, shard string, runs string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], DOCS)


# --- op11 -------------------------------------------------------------------------------------------------------------

ODD = [
    "", " ", "  ", "\n", "\n\n", "\n\n\n", " \n", "\n ", "a  b", "a   b", "a \n b", "a\n\nb", "a\n\n\nb", "x \t y\t\tz", "word ", "word  ", " word", "it's we'll 'tis", "a\r\nb\r\n\r\nc",
    "<|endoftext|> hi<|endoftext|>", "a  <|endoftext|>  b", "été 你好 世界。", "...,,, ... ,", "Ġx Ċy", "a\x1c b\x1fc", " 　 x", "  x", "😀😀 x", "\0 a\0", None,
]


def test_pieces_give_the_librarys_ids(monkeypatch):
    library, draw = Tokenizer.from_file(PATH), random.Random(1)
    parts = [" ", "\n", "a", "b", "é", ".", "'s", "1", "\t", " ", "<|endoftext|>", "😀", "\x1c", "\0"]
    texts = [t or "" for t in ODD] + ["".join(draw.choice(parts) for _ in range(draw.randint(1, 30))) for _ in range(1500)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (token_files.MOST_PIECES, 40):  # a table that is full again and again
        monkeypatch.setattr(token_files, "MOST_PIECES", most)
        coder = token_files.Encoder(PATH)
        ids, ends = coder.encode_all(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want
        assert [coder.encode_all(pa.array([t], pa.string()))[0].tolist() for t in texts[:200]] == want[:200]


def test_words_with_and_without_a_mark_are_learnt_once(monkeypatch):
    library, given = Tokenizer.from_file(PATH), []
    words = [f"{a}{b}{c}ly" for a in "bcdf" for b in "aeiou" for c in "lmnrst"]
    text = " ".join(w + mark for mark in ("", ",", ".", ",") for w in words) + "\nlast... e.g. x.,y a.  b,\nc."
    coder = token_files.Encoder(PATH)
    learn = coder.learn
    monkeypatch.setattr(coder, "learn", lambda keys: given.extend(keys) or learn(keys))
    ids, ends = coder.encode_all(pa.array([text, "no " + text], pa.string()))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in (text, "no " + text)]
    assert len(given) == len(set(given)) < len(words) + 20


def expected_files(rows):
    """(doc_id, start, n_tokens, crc) in order; ties have one multiset of places, so only the sum of starts is compared for them."""
    library, start, found = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("part", [token_files.PART, 50])
def test_token_files_come_back(spark, monkeypatch, part):
    monkeypatch.setattr(token_files, "PART", part)
    rows = [(3 * k, t) for k, t in enumerate(ODD)] + [(1, " ".join(f"w{k % 700}" for k in range(30_000)))] + [(10_000 + k, f"text {k} and more") for k in range(300)]
    folder = shared_folder(spark, "tokens")
    token_files.write_ids(docs_of(spark, rows).repartition(5), PATH, folder)
    got = [tuple(r) for r in token_files.checksums(token_files.read_ids(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == expected_files(rows)


def test_token_files_of_awkward_tables(spark):
    folder = shared_folder(spark, "tokens")
    token_files.write_ids(docs_of(spark, []), PATH, folder)
    assert token_files.checksums(token_files.read_ids(spark, folder)).count() == 0
    rows = [(None, "no id"), (5, "b"), (5, "a b c"), (5, "a b c"), (5, None), (7, "x")] + [(6, "copy")] * 50
    folder = shared_folder(spark, "tokens")
    token_files.write_ids(docs_of(spark, rows).repartition(4), PATH, folder)
    got = [tuple(r) for r in token_files.checksums(token_files.read_ids(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = expected_files(rows)
    without_start = lambda x: Counter((i, n, c) for i, _, n, c in x)
    assert without_start(got) == without_start(want)
    spans = sorted((s, n) for _, s, n, _ in got)
    assert spans[0][0] == 0 and all(s + n == t for (s, n), (t, _) in zip(spans, spans[1:]))
    order = [i for i, s, _, _ in sorted(got, key=lambda r: r[1])]
    assert order == [i for i, *_ in want]


def test_files_are_in_order_and_a_lookup_reads_few_of_them(spark):
    rows = [(k, " ".join(f"w{(k * 31 + j) % 500}" for j in range(9))) for k in range(60_000)]
    folder = shared_folder(spark, "tokens")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        token_files.write_ids(docs_of(spark, rows), PATH, folder, stripe_bytes=1 << 16)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    firsts = spark.read.orc(f"{folder}/ids").groupBy(F.input_file_name().alias("file"), "shard").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("file").collect()
    assert len(firsts) > 1 and all(a.hi < b.lo and a.shard < b.shard for a, b in zip(firsts, firsts[1:]))
    file = pyarrow.orc.ORCFile(firsts[0].file.removeprefix("file://"))
    assert file.nstripes > 1
    found = token_files.read_ids(spark, folder, [7, 52_345, 99_999])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in found.collect()) == [7, 52_345]


def test_crc_of_two_parts():
    draw = random.Random(2)
    for _ in range(50):
        a, b = draw.randbytes(draw.randint(0, 90)), draw.randbytes(draw.randint(0, 5000))
        assert token_files.combined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# --- op12 -------------------------------------------------------------------------------------------------------------


def best_edits(initials, faults, state, exits):
    """(cost, audit) by Dijkstra over whole audits."""
    heap, done, n = [(0, "", 0, state)], set(), len(initials)
    while heap:
        cost, audit, i, s = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == n and s in exits:
            return cost, audit
        after = {0: 2, 1: 2, 2: 3, 3: 2}[s]
        heapq.heappush(heap, (cost + 5, audit + "I", i, after))
        if i < n:
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, s))
            if faults[i] not in "bd":
                extra = 5 * (faults[i] == "t")
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, after))
                kept = {"s": 1, "u": 2, "a": 3}.get(initials[i])
                if kept and (s, kept) in {(0, 1), (0, 2), (1, 2), (3, 2), (2, 3)}:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kept))
    return None


def repaired(rows):
    """conv -> results, from (conv, turn, role, text, present) rows."""
    convs = {}
    for conv, turn, role, text, present in rows:
        own = convs.setdefault(conv, [])
        if present:
            own.append((turn, " " if role is None else role, " " if text is None else text))
    found = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults = set(), ""
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults += "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
        initials = "".join(r[1][:1] or "-" for r in own)
        cost, audit = best_edits(initials, faults, 0, (0, 3))
        turns, state, lines, left = [r[0] for r in own if r[0] is not None], 0, [], iter(own)
        for edit in audit:
            after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit != "D":
                state = {"s": 1, "u": 2, "a": 3}[role[0]] if edit == "K" else after
                lines.append(f"{role if edit == 'K' else ('user', 'assistant')[after - 2]}:{text}")
        illegal = sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), "\n".join(lines))
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_the_search_finds_the_cheapest_and_least_audit():
    draw = random.Random(5)
    for _ in range(4000):
        n = draw.randint(0, 9)
        initials, faults = "".join(draw.choice("suaauu-") for _ in range(n)), "".join(draw.choice("bdt---") for _ in range(n))
        entry, exits = draw.randrange(4), draw.choice([(0, 3), (0,), (1,), (2,), (3,)])
        assert conversations.cheapest(initials, faults, entry, exits) == best_edits(initials, faults, entry, exits)


def test_a_long_conversation_is_searched_in_proportion():
    draw = random.Random(6)
    initials, faults = "".join(draw.choice("suaauu") for _ in range(60_000)), "".join(draw.choice("bdt---") for _ in range(60_000))
    cost, audit = conversations.cheapest(initials, faults, 0, (0, 3))
    assert len(audit) >= 60_000 and cost == conversations.suffix_bounds(initials, faults, (0, 3))[0][0]


def turns_of(seed, convs=12):
    draw, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        for k in range(draw.choice([0, 1, 2, 5, 9, 40])):
            text = draw.choice(["", " \t", "Yes.", "No", "What?", "So it is! ", None, f"text {k}."])
            rows.append((conv, draw.choice([k, k, 2 * k, None]), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text, draw.random() > 0.1))
    return rows


def unique_places(rows):
    """Rows whose order within a turn can't matter to the brute version: one row for each turn, nulls of one kind."""
    seen, found = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            found.append(r)
    return found


@pytest.mark.parametrize("block", [conversations.ROWS, 3])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "ROWS", block)
    rows = unique_places(turns_of(7)) + [(99, k, ("user", "assistant")[k % 2], f"line {k % 300}" + "." * (k % 5 > 0), True) for k in range(1_000)]  # one conversation with most rows
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, present boolean, shard string, repaired string")
    got = {r.conv_id: (*(r[c] for c in COLUMNS), r.repaired) for r in conversations.repair(df.repartition(4), present="present", keep_text=True).collect()}
    assert got == repaired(rows)


def test_repair_of_awkward_tables(spark):
    schema = "conv_id long, turn long, role string, text string, present boolean"
    assert conversations.repair(spark.createDataFrame([], schema), present="present").count() == 0
    gone = conversations.repair(spark.createDataFrame([(1, 0, "user", "x.", False), (2, None, None, None, True)], schema), present="present").orderBy("conv_id").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r[c] for c in COLUMNS) for r in gone] == [(0, 0, 0, 0, 0, 0, "", empty), (0, 1, 0, 0, 0, 2, "D", empty)]
    rows = [(1, 0, "user", "again.", True)] * 500  # repeated rows: all but one are duplicates
    found = conversations.repair(spark.createDataFrame(rows, schema).repartition(3)).first()
    assert (found.duplicate, found.cost, found.illegal, found.gaps) == (499, 2 * 499 + 2, 499, 0) and Counter(found.audit) == {"D": 500}


def test_op12_on_the_supplied_table(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        kind, text = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20, r.text
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        rows += [(r.conv_id, r.turn, "user" if kind == 4 else r.role, text, kind != 0)] * (2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in q_conversations.op12_conversation_repair(spark, SF).collect()}
    assert got == {k: v[:-1] for k, v in repaired(rows).items()}


# --- op13 -------------------------------------------------------------------------------------------------------------


def brute_runs(w, least=12, times=2):
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(10):
            few = draw.choice([1, 2, 3, 5, 50])
            w = [b"w%d" % draw.randrange(few) for _ in range(draw.randint(0, 120))]
            for _ in range(draw.randint(0, 3)):
                p, again, at = draw.randint(1, 20), draw.randint(2, 5), draw.randint(0, len(w))
                w[at:at] = ([b"w%d" % draw.randrange(few) for _ in range(p)] * again)[: p * again - draw.randint(0, p)]
            texts.append(w)
        least = draw.choice([12, 7, 4, 20])
        got = periodic.find_runs(texts, least)
        assert [got.get(k, []) for k in range(10)] == [brute_runs(w, least) for w in texts]


def test_very_long_periodic_texts():
    draw = random.Random(4)
    assert periodic.find_runs([[b"a"] * 150_000]) == {0: [(0, 150_000, 1)]}
    block = [b"%d" % draw.randrange(10**9) for _ in range(40_000)]
    text = [b"x", *block, *block, *block[:7]]
    assert periodic.find_runs([[], text, block]) == {1: [(1, 80_007, 40_000)]}


def test_runs_of_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a " * 12), (4, "a " * 12), (4, "a " * 12), (4, "a b " * 5 + "c"), (5, "a " * 11), (6, "z\x1f" * 12), (7, ("é ß\t" * 8).strip())]
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept_text) for r in periodic.periodic_runs(docs_of(spark, rows)).collect())
    one = ((0, 12, 1),)
    assert got == Counter({
        (1, 0, (), ""): 1, (2, 0, (), ""): 1, (3, 0, (), ""): 1, (None, 12, one, "a"): 1, (4, 12, one, "a"): 2, (4, 11, (), "a b a b a b a b a b c"): 1,
        (5, 11, (), " ".join("a" * 11)): 1, (6, 1, (), "z\x1f" * 12): 1, (7, 16, ((0, 16, 2),), "é ß"): 1,
    })
    assert periodic.periodic_runs(docs_of(spark, [])).count() == 0


def test_op13_on_the_supplied_table(spark):
    got = {r.doc_id: r for r in q_periodic.op13_periodic_runs(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows) and sum(r.n_runs for r in got.values()) > 10
    for i, text in rows:
        w = text.encode().split()
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        if n > 1500:
            continue
        runs = brute_runs(w)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        want = (len(runs), *best, best[1] and 1000 * best[1] // best[2])
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()
