"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

A pair of adjacent tokens is *stable* when merging never crosses their border, and a token sequence is the merge
list's encoding of its bytes exactly when all its adjacent pairs are stable. So the last token of each prefix is
determined by the last token of a shorter prefix, and the transducer reads left to right: it keeps, for the last few
positions, the token that ends there. No later byte can reach back further than the longest token, so a token that
lies on every live chain is final and is emitted. `lookahead` is computed from the merge list: no border can move
once that many bytes beyond it have been read.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tidemark.llm.common import byte_slices, in_slices, schema_with, text_bytes
from tidemark.llm.pieces import SPACE, Pieces

#: The contractions and character classes of the byte-level pre-tokenizer.
PRETOKEN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Bytes, by estimate, that a worker's remembered words and pairs take, and characters of the longest word that is remembered.
CACHE_BYTES, MOST_KEPT = 48 << 20, 40
#: Tokens that are hashed and decoded at a time, characters of a text that are cut into words at a time, and tokens of a result batch.
BLOCK, PART, BATCH_TOKENS = 65_536, 65_536, 1 << 20
#: Bytes of text that are encoded at a time by their distinct pieces, pieces that a worker remembers, and characters of a piece and
#: bytes of a text beyond which a text is encoded on its own, block by block.
SLICE, MOST_PIECES, LONG_PIECE, LONG_TEXT = 4 << 20, 1 << 18, 64, 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: visible Latin-1 bytes stand for themselves, the others are counted from 256."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Remembered:
    """A table of bounded size in two generations: when the young one is full it becomes the old one, and what is asked for again moves back."""

    def __init__(self, most_bytes: int, cost):
        self.young, self.old, self.most, self.cost, self.size = {}, {}, most_bytes // 2, cost, 0

    def recall(self, key):
        """The value of a key that the young generation does not have, or None."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        self.size += self.cost(key, value)
        if self.size > self.most:
            self.young, self.old, self.size = {}, self.young, self.cost(key, value)
        self.young[key] = value


class Transducer:
    """Encoder and decoder for one merge list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes, int]] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = map(raw, merge.split(" ") if isinstance(merge, str) else merge)
            self.rank[a, b] = n
            self.parts.setdefault(a + b, (a, b, n))
        self.longest = max(map(len, self.ids))
        self.tokens = set(self.parts) | {bytes([b]) for b in range(256)} & set(self.ids)
        # By numbers: the rank of two tokens' merge, what a token is made of and when, its size, and the next shorter token it starts with.
        self.most = max(self.bytes_of) + 1
        self.merge = {self.ids[a] * self.most + self.ids[b]: n for (a, b), n in self.rank.items()}
        self.made = {self.ids[t]: (self.ids[a], self.ids[b], n) for t, (a, b, n) in self.parts.items()}
        self.size = {self.ids[t]: len(t) for t in self.tokens}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        # For the bytes that tokens start with: the longest token they start with, or -1.
        self.best, self.shorter = {b"": -1}, {}
        for token in sorted(self.tokens, key=len):
            for k in range(1, len(token)):
                if token[:k] not in self.best:
                    self.best[token[:k]] = self.best[token[: k - 1]]
            self.shorter[self.ids[token]] = self.best[token[:-1]]
            self.best[token] = self.ids[token]
        # Tokens by their last two bytes: how long the longest is, so that few others are tried.
        self.tail = {}
        for token in self.tokens:
            self.tail[token[-2:]] = max(len(token), self.tail.get(token[-2:], 1))
        self.pairs = Remembered(CACHE_BYTES // 2, lambda *_: 150)
        self.words = Remembered(CACHE_BYTES // 2, lambda word, ids: 150 + len(word) + 8 * len(ids))
        self.split = regex.compile(PRETOKEN)
        self.border = regex.compile(r"\P{White_Space} (?=\P{White_Space})")
        self.blank = regex.compile(r" (?:\s|$)")
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.lookahead = self._sufficient_lookahead()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge of a token while it is built, each with the rank at which it is consumed."""
        spines = self.left if side == 0 else self.right
        found = spines.get(token)
        if found is None:
            found, here, until = [], token, len(self.rank) + 1
            while True:
                found.append((here, until))
                made = self.made.get(here)
                if made is None:
                    break
                here, until = made[side], made[2]
            spines[token] = found
        return found

    def stable(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border between a and b: a crossing merge fires if it comes before either side is consumed; of equal ranks the left one is first."""
        key = a * self.most + b
        known = self.pairs.young.get(key)
        if known is None:
            known = self.pairs.recall(key)
        if known is None:
            known = self._stable(a, b)
            self.pairs.keep(key, known)
        return known

    def _stable(self, a: int, b: int) -> bool:
        rank, spine = self.merge.get, self._spine(b, 0)
        for x, x_until in self._spine(a, 1):
            x *= self.most
            for y, y_until in spine:
                r = rank(x + y)
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    def _sufficient_lookahead(self) -> int:
        """Bytes that must follow a border before it is final.

        A merge can move a border only while its right-hand part is still being built. By rank, let reach(token) be the
        most bytes right of the token that building it may depend on: what its right part depends on, or what its left
        part depends on beyond the right part. The largest reach, and a token's own length, bound all of them.
        """
        reach: dict[bytes, int] = {}
        most = self.longest
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            reach[a + b] = max(len(b), reach.get(b, 1), reach.get(a, 1) - len(b), reach.get(a + b, 1))
            most = max(most, reach[a + b])
        return most + self.longest

    def stream(self, chunks: Iterable[bytes]) -> Iterator[bytes]:
        """Tokens of a byte stream without pre-tokenization; memory is bounded by the lookahead."""
        pending, last = b"", [b""]  # bytes not emitted, and for each of their prefixes the token that ends it
        for chunk in chunks:
            for k in range(len(chunk)):
                pending += chunk[k : k + 1]
                last.append(self._last_token(pending, last))
                if len(pending) > 2 * self.lookahead:
                    done, pending, last = self._settled(pending, last)
                    yield from done
        yield from self._back(last, len(pending))

    def _last_token(self, text: bytes, last: list[bytes]) -> bytes:
        end = len(text)
        for start in range(max(0, end - max(self.tail.get(text[-2:], 1), self.tail.get(text[-1:], 1))), end):
            token = text[start:end]
            if token in self.tokens:
                before = last[start]
                if not before or self.stable(self.ids[before], self.ids[token]):
                    return token
        raise ValueError(f"no token ends in byte {text[-1]}")

    @staticmethod
    def _back(last: list[bytes], end: int) -> list[bytes]:
        found = []
        while end > 0 and last[end]:
            found.append(last[end])
            end -= len(last[end])
        return found[::-1]

    def _settled(self, pending: bytes, last: list[bytes]) -> tuple[list[bytes], bytes, list[bytes]]:
        """Emit what all live chains share: later tokens start at one of the last `longest` positions."""
        live = set(range(len(pending) - self.longest, len(pending) + 1))
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(top - len(last[top]))
        cut = live.pop()
        if cut <= 0:
            return [], pending, last
        done = self._back(last, cut)
        kept = last[cut:]
        kept[0] = last[cut]  # the pair test needs the token left of the first pending byte
        return done, pending[cut:], kept

    def _short(self, data: bytes) -> list[int]:
        """Ids of a word within the lookahead.

        Only one sequence of tokens has no unstable pair, so whichever search meets one has found the encoding: take the
        longest token that is stable after the one before it, and step back where none is.
        """
        best, shorter, sizes, pairs, most = self.best.get, self.shorter, self.size, self.pairs.young.get, self.most
        found: list[int] = []
        start, before, size = 0, -1, len(data)
        while start < size:
            # The longest token that starts here, by way of the longest start of any token.
            end = start + 4
            token = best(data[start:end])
            if token is None:
                while token is None:
                    end -= 1
                    token = best(data[start:end])
            else:
                while end < size:
                    end += 1
                    longer = best(data[start:end])
                    if longer is None:
                        break
                    token = longer
            while True:
                if before >= 0:
                    while token >= 0:
                        known = pairs(before * most + token)
                        if known or (known is None and self.stable(before, token)):
                            break
                        token = shorter[token]
                if token >= 0:
                    found.append(token)
                    start += sizes[token]
                    before = token
                    break
                if not found:
                    raise ValueError(f"no token starts with byte {data[0]}")
                token = found.pop()
                start -= sizes[token]
                before = found[-1] if found else -1
                token = shorter[token]
        return found

    def word_ids(self, word: str) -> Iterable[int]:
        """Ids of a word of any length; beyond the longest token it goes through the stream."""
        data = word.encode("utf-8")
        return self._short(data) if len(data) <= self.longest else (self.ids[token] for token in self.stream([data]))

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a word within the lookahead."""
        known = self.words.young.get(word) or self.words.recall(word)
        if known is None:
            known = tuple(self._short(word.encode("utf-8")))
            self.words.keep(word, known)
        return known

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of up to MOST_KEPT characters, a space and what follows it, which are then remembered."""
        known = self.words.recall(run)
        if known is None:
            words = self.split.findall(run)
            if len(words) == 1:
                return self._word(run)
            known = tuple([i for word in words for i in self._word(word)])
            if "\n" not in run:
                self.words.keep(run, known)
        return known

    def _long(self, run: str) -> Iterator[tuple[int, ...]]:
        """Ids of a longer run, word by word; words beyond the longest token go through the stream."""
        for match in self.split.finditer(run):
            word = match[0]
            if len(word) <= MOST_KEPT:
                yield self._word(word)
            else:
                for i in self.word_ids(word):
                    yield (i,)

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, in blocks of bounded size.

        A text is cut into parts of about PART characters where a single space stands between other characters: a
        pre-token always ends there. Runs that start with such a space are encoded, and remembered, on their own; a
        part in which white space follows a space is cut by the pattern alone.
        """
        block: list[int] = []
        for piece, special in self._pieces(text):
            if special is not None:
                block.append(special)
                continue
            for part in self._parts(piece):
                if self.blank.search(part):
                    runs = (match[0] for match in self.split.finditer(part))
                else:
                    first, *others = part.split(" ")
                    runs = itertools.chain([first] if first else [], [" " + x for x in others])
                get = self.words.young.get
                for run in runs:
                    known = get(run)
                    if known is not None:
                        block += known
                    elif len(run) <= MOST_KEPT:
                        block += self._run(run)
                        get = self.words.young.get
                    else:
                        for ids in self._long(run):
                            block += ids
                            if len(block) >= BLOCK:
                                yield block
                                block = []
                        get = self.words.young.get
                    if len(block) >= BLOCK:
                        yield block
                        block = []
        if block:
            yield block

    def _parts(self, piece: str) -> Iterator[str]:
        start = 0
        while len(piece) - start > PART:
            found = self.border.search(piece, start + PART)
            if found is None:
                break
            yield piece[start : found.start() + 1]
            start = found.start() + 1
        yield piece[start:]

    def _pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        start = 0
        for match in self.at_special.finditer(text) if self.at_special else ():
            if match.start() > start:
                yield text[start : match.start()], None
            yield "", self.special[match[0]]
            start = match.end()
        if start < len(text):
            yield text[start:], None

    def decode(self, blocks: Iterable[list[int]]) -> Iterator[str]:
        """Text of ids, block by block: bytes that do not yet end a character wait for the next block."""
        state, table = codecs.getincrementaldecoder("utf-8")("replace"), self.bytes_of
        for block in blocks:
            yield state.decode(b"".join([table[i] for i in block]))
        yield state.decode(b"", True)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One transducer per Python worker and vocabulary file."""
    return Transducer(path)


class PieceCoder(Pieces):
    """The transducer behind a table of pieces of text, for many texts at once that have no long piece."""

    def __init__(self, path: str):
        self.coder = coder = transducer(path)
        super().__init__(list(coder.special), MOST_PIECES, f"{SPACE.replace('[', '[^', 1)}{{{LONG_PIECE + 1}}}")
        # Each id's decimal and comma, and its bytes, for ids up to the largest.
        self.names = pa.array([f"{i}," for i in range(coder.most)], pa.binary())
        self.raw = pa.array([coder.bytes_of.get(i, b"") for i in range(coder.most)], pa.binary())

    def learn(self, keys: list[str]) -> None:
        coder, ids, sizes = self.coder, array("i"), []
        for key in keys:
            if len(key) < coder.longest and key.isascii() and key.isalpha():
                found = coder._short(b" " + key.encode())
            else:
                found = [i for word in coder.split.findall(self.piece(key)) for i in coder.word_ids(word)]
            ids.extend(found)
            sizes.append(len(found))
        self.new.keep(keys, np.frombuffer(ids, np.int32), np.array(sizes, np.int64))

    def digests(self, ids: np.ndarray, ends: np.ndarray) -> tuple[list[str], list[str]]:
        """SHA-256 of each text's ids, in decimal and with commas, and of the text that they decode to."""
        of_ids, of_texts = [], []
        (names, at), (raw, place) = self._joined(self.names, ids, ends), self._joined(self.raw, ids, ends)
        for a, b, c, d in zip(at, at[1:], place, place[1:]):
            of_ids.append(hashlib.sha256(names[a : max(a, b - 1)]).hexdigest())
            of_texts.append(hashlib.sha256(str(raw[c:d], "utf-8", "replace").encode()).hexdigest())
        return of_ids, of_texts

    @staticmethod
    def _joined(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> tuple[memoryview, list[int]]:
        """A table's entries for all ids, one after another, and where each text's begin and the last one's end."""
        found = table.take(pa.array(ids))
        _, offsets, data = found.buffers()
        return memoryview(data or b""), np.frombuffer(offsets, np.int32)[np.concatenate([[0], ends])].tolist()


@lru_cache(maxsize=2)
def piece_coder(path: str) -> PieceCoder:
    """One coder of pieces per Python worker and vocabulary file."""
    return PieceCoder(path)


def encode_documents(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """df with a column of token ids (array<int>) of each whole text.

    path: a tokenizers JSON file, which every executor must be able to open. Null texts are read as empty and give an
    empty array, as do empty texts; special tokens written out in a text become their id. All other columns stay as
    they are; a column already named as `ids` is replaced. Rows are independent, so nothing is shuffled.
    """
    kept = df.drop(ids) if ids in df.columns else df
    at = kept.columns.index(text)

    def run(batches):
        coder = transducer(path)
        for batch in batches:
            for part, texts in in_slices(batch, at):
                found = ids_column((array("i", block) for block in coder.encode(t or "")) for t in texts)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, ids])

    return kept.mapInArrow(run, schema_with(kept, ids, ArrayType(IntegerType())))


def ids_column(rows: Iterable[Iterable[array]]) -> pa.Array:
    """A list column of ids, four bytes each, from the blocks of each row."""
    values, ends = array("i"), array("i", [0])
    for blocks in rows:
        for block in blocks:
            values += block
        ends.append(len(values))
    return pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(values, np.int32)))


def decode_documents(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """df with the text that each row's token ids decode to; null ids give null, bytes that are no UTF-8 become U+FFFD."""
    kept = df.drop(text) if text in df.columns else df
    at = kept.columns.index(ids)

    def blocks(row):
        values = row.values
        for start in range(0, len(values), BLOCK):
            yield values.slice(start, BLOCK).to_pylist()

    def run(batches):
        coder = transducer(path)
        for batch in batches:
            found = [None if not row.is_valid else "".join(coder.decode(blocks(row))) for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, text])

    return kept.mapInArrow(run, schema_with(kept, text, StringType()))


def round_trip(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Digests of each document's ids and of the text they decode to, in one pass.

    About SLICE bytes of texts are encoded at a time by their distinct pieces. Texts beyond LONG_TEXT, and those with
    long pieces, much white space or special tokens, are encoded block by block: beside the text itself such a document
    takes constant memory.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256; with keep_ids, token_ids (array<int>) too: a row's ids are
    then whole in memory, four bytes each, and results are handed on every BATCH_TOKENS tokens. Null and empty texts have
    no tokens and the digest of the empty string; repeated rows give repeated results.
    """
    names_out = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * keep_ids

    def one(coder, data, values):
        of_ids, of_text, count, names = hashlib.sha256(), hashlib.sha256(), 0, coder.text_of

        def blocks():
            nonlocal count
            for block in coder.encode(data.decode("utf-8", "replace")):
                of_ids.update((b"," if count else b"") + ",".join([names[i] for i in block]).encode())
                count += len(block)
                if keep_ids:
                    values.extend(block)
                yield block

        for part in coder.decode(blocks()):
            of_text.update(part.encode())
        return count, of_ids.hexdigest(), of_text.hexdigest()

    def of_plain(rows, texts):
        pieces = piece_coder(path)
        ids, ends = pieces.encode_plain(texts)
        of_ids, of_texts = pieces.digests(ids, ends)
        starts, start = np.concatenate([[0], ends]), 0
        while start < len(ends):
            end = max(start + 1, int(np.searchsorted(ends, starts[start] + BATCH_TOKENS, "right")))
            columns = [rows.slice(start, end - start), pa.array(np.diff(starts[start : end + 1]), pa.int64()), pa.array(of_ids[start:end], pa.string()), pa.array(of_texts[start:end], pa.string())]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array((starts[start : end + 1] - starts[start]).astype(np.int32)), pa.array(ids[starts[start] : starts[end]])))
            yield pa.RecordBatch.from_arrays(columns, names=names_out)
            start = end

    def of_odd(part, texts):
        coder = transducer(path)
        start, rows, values, ends = 0, [], array("i"), array("i", [0])
        for k, data in enumerate(texts):
            rows.append(one(coder, data.as_py(), values))
            ends.append(len(values))
            if len(values) >= BATCH_TOKENS or k == len(texts) - 1:
                counts, of_ids, of_texts = zip(*rows)
                columns = [part.slice(start, len(rows)), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), pa.array(np.frombuffer(values, np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names_out)
                start, rows, values, ends = k + 1, [], array("i"), array("i", [0])

    def run(batches):
        # Results with ids come after stages whose workers stay in memory: no table of pieces there.
        pieces = None if keep_ids else piece_coder(path)
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE):
                rows, data = part.columns
                if pieces is None:
                    yield from of_odd(rows, data)
                    continue
                odd = pc.binary_length(data).to_numpy(zero_copy_only=False) > LONG_TEXT
                short = pa.array(~odd)
                texts = data.filter(short)
                try:
                    texts = texts.cast(pa.string())
                except pa.ArrowInvalid:  # bytes that are no UTF-8
                    texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
                found = pieces.is_odd(texts)
                odd[~odd] = found
                yield from of_plain(rows.filter(pa.array(~odd)), texts.filter(pa.array(~found)))
                yield from of_odd(rows.filter(pa.array(odd)), data.filter(pa.array(odd)))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")).mapInArrow(run, schema)
