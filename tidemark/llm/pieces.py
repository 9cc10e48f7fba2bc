"""Ids of many texts at once, put together from those of their distinct pieces.

A byte-level pre-tokenizer never crosses the start of a run of white space, so a text's ids are those of its pieces,
each a run of white space and what follows it. Pieces repeat, so each is encoded once for a stretch of texts, and what a
worker has met before it takes from a table of bounded size. A full stop or comma that ends a word is a piece of its
own: no pre-token holds a letter and the mark after it, and words with and without it share their ids.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The code points that Unicode calls white space, as a character class.
SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Characters of the pieces that a worker remembers.
MOST_CHARS = 32 << 20


class Table:
    """Ids of pieces of text by their keys: each has a number, and its ids stand at a place in one array."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.values, self.used, self.chars = np.zeros(1 << 18, np.int32), 0, 0

    def keep(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Note the ids of new keys, which stand one after another in ids."""
        n, more = len(self.known), len(keys)
        while n + more > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(len(x), x.dtype)]) for x in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(len(self.values), np.int32)])
        self.values[self.used : self.used + len(ids)] = ids
        self.starts[n : n + more] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + more] = sizes
        self.known.update(zip(keys, range(n, n + more)))
        self.used += len(ids)
        self.chars += sum(map(len, keys))

    def numbers(self, keys: list[str]) -> np.ndarray:
        """Each key's number, -1 for unknown ones."""
        return np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of pieces, and how many ids each piece has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        # Four bytes for a place: a table and an Arrow array of texts both stay below 2^31.
        at = np.repeat((self.starts[numbers] - (ends - sizes)).astype(np.int32), sizes)
        at += np.arange(len(at), dtype=np.int32)
        return self.values[at], sizes


class Pieces:
    """Encoder of many texts; learn() says how pieces that no table has are encoded."""

    def __init__(self, special: list[str], most: int, odd: str = ""):
        """special: tokens that stand for themselves in a text; most: pieces to remember; odd: more texts that are not to be split."""
        # White space of three or more characters, or of two at the end or before a special token, is more than splitting at spaces and line feeds gets right.
        self.odd = "|".join([f"{SPACE}{{3}}|{SPACE}{{2}}$|\\x00", *(re.sub(r"([^\w])", r"\\\1", x) for x in special), *([odd] if odd else [])])
        self.most = most
        # What is asked for again moves from the old table to the new one, which becomes the old one when it is full.
        self.new, self.old = Table(), Table()

    def learn(self, keys: list[str]) -> None:
        """Give the new table the ids of each key's piece."""
        raise NotImplementedError

    @staticmethod
    def piece(key: str) -> str:
        """The piece of text that a key stands for: what follows a space, a line feed and what follows it, or after a null the piece as it is."""
        return key if key[:1] == "\n" else key[1:] if key[:1] == "\0" else " " + key

    def numbers(self, keys: list[str]) -> np.ndarray:
        """Numbers of the keys in the new table; pieces that neither table has are learnt."""
        found = self.new.numbers(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            wanted = list(dict.fromkeys([keys[k] for k in missing]))
            if len(self.new.known) + len(wanted) > self.most // 2 or self.new.chars + sum(map(len, wanted)) > MOST_CHARS // 2:
                self.new, self.old = Table(), self.new
                missing, wanted = np.arange(len(keys)), list(dict.fromkeys(keys))
            before = self.old.numbers(wanted)
            again = before >= 0
            self.new.keep([k for k, b in zip(wanted, again) if b], *self.old.gathered(before[again]))
            self.learn([k for k, b in zip(wanted, again) if not b])
            found[missing] = self.new.numbers([keys[k] for k in missing])
        return found

    def is_odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts split() would get wrong, or which are not to be split."""
        return pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)

    def encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of texts that are not odd, one after another, and where each text's end."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        words, codes, offsets = self._split(texts)
        # A text's first piece has no space before it; the others have one, unless they start with their line feed.
        firsts = offsets[:-1]
        own, which = np.unique(codes[firsts], return_inverse=True)
        words += ["\0" + words[c] for c in own]
        numbers, own = self.numbers(words).astype(np.int32), len(words) - len(own)
        del words
        at = numbers[codes]
        at[firsts] = numbers[own:][which]
        ids, sizes = self.new.gathered(at)
        return ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[offsets[1:]]

    @staticmethod
    def _split(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(words, codes, offsets): the distinct pieces, which of them the texts have one after another, and where each text's begin."""
        marked = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " \n"), "([a-z])([.,])( |$)", "\\1 \0\\2\\3")
        split = pc.split_pattern(marked, " ")
        del marked
        coded = split.flatten().dictionary_encode()
        offsets = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        del split
        return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), offsets
