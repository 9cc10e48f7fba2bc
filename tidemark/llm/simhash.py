"""SimHash near-duplicates through an inverted index over byte positions.

A fingerprint has eight bytes. Two fingerprints within `distance` differing bits share at least 8 - distance bytes at
the same positions. The index has a posting list for every value of every position set of a covering family: whichever
8 - distance positions a pair shares, one of the sets lies inside them, so a linked pair meets in a list. Within a list
the shared positional bytes of each pair are tallied, pairs below the guaranteed minimum are dropped and the rest are
verified by counting differing bits.

Four differing bits mean shingles that are alike by 0.9 or more. For a likeness of 0.8 about ten of 64 bits differ, too
many for such a guarantee: `one_of_alike` takes 256 bits, 32 positions and an index over position triples, and compares
the shingle sets of the pairs that it finds.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, in_slices, mix64, text_bytes, written

#: Shingles whose bits are counted at a time.
BLOCK = 65_536
#: Fingerprints of a posting list that are compared in one task; longer lists are cut into chunks and compared chunk by chunk.
CHUNK = 4_096
#: Distinct fingerprints up to which lists share three bytes; beyond, four, so that chance meetings stay rare.
THREE_BYTES_UP_TO = 1 << 26


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """The 64-bit SimHash of UTF-8 text, unsigned: a bit is 1 if it is set in over half of the shingle hashes.

    A-Z are lower-cased. A text with fewer words than a shingle is one shingle; a text without words gives zero.
    """
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long. Null texts are read as empty."""

    def run(batches):
        for batch in batches:
            for part, texts in in_slices(batch, 1):
                found = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def covering(size: int, inside: int, of: int = 8) -> list[tuple[int, ...]]:
    """Sets of `size` positions such that every `inside` of `of` positions contain one: the set that settles most open ones is added, again and again."""
    unmet = [set(x) for x in combinations(range(of), inside)]
    found = []
    while unmet:
        best = max(combinations(range(of), size), key=lambda c: sum(x.issuperset(c) for x in unmet))
        found.append(best)
        unmet = [x for x in unmet if not x.issuperset(best)]
    return found


def posting_lists(classes: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """(list, rep, fp): each fingerprint under the key of each position set: the set's number and the bytes at its positions."""
    byte = [F.shiftrightunsigned("fp", 8 * k).bitwiseAND(F.lit(255)) for k in range(8)]
    keys = []
    for n, positions in enumerate(sets):
        key = F.lit(n).cast("long")
        for k in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte[k])
        keys.append(key)
    return classes.select("rep", "fp", F.explode(F.array(*keys)).alias("list"))


def links_within(reps: np.ndarray, fps: np.ndarray, distance: int, least: int) -> list[tuple[int, int]]:
    """Links that connect a posting list's members as all pairs would; fps has a row of 64-bit words for each member.

    Each member is compared only with those that nothing has reached yet: a group of alike members costs one comparison
    a member. Whatever is reached is linked to the member the search set out from, the first of its group, so that the
    lists of one group give mostly the same links.
    """
    left = np.arange(len(fps))
    found = []
    while len(left) > 1:
        first, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            differing = fps[left] ^ fps[i]
            shared = (differing.view(np.uint8) == 0).sum(axis=1)
            near = (shared >= least) & (np.bitwise_count(differing).sum(axis=1) <= distance)
            hit = left[near]
            found += [(int(reps[first]), int(reps[k])) for k in hit]
            queue.extend(hit.tolist())
            left = left[~near]
    return found


#: Members of a list up to which all pairs within the distance are handed on, and up to which all are looked at.
ALL_PAIRS, MATRIX = 16, 128
#: Share of the distance within which members of a longer list are grouped first.
TIGHT = 0.7


def near_pairs_within(reps: np.ndarray, fps: np.ndarray, distance: int, least: int) -> list[tuple[int, int]]:
    """Pairs of members within the distance that connect what all such pairs connect, the nearest ones where it matters.

    Up to ALL_PAIRS members these are all pairs, up to MATRIX a tree of the smallest distances. In longer lists members
    within a tight bound are grouped first, breadth first from the smallest, so that a group's pairs are mostly those
    with its smallest member, in one list as in the next; groups are then connected by pairs up to the whole distance.
    """
    n = len(fps)
    if n <= MATRIX:
        a, b = np.triu_indices(n, 1)
        differing = fps[a] ^ fps[b]
        bits = np.bitwise_count(differing).sum(axis=1)
        near = np.flatnonzero((bits <= distance) & ((differing.view(np.uint8) == 0).sum(axis=1) >= least))
        if n > ALL_PAIRS:
            root, tree = list(range(n)), []
            for k in near[np.argsort(bits[near], kind="stable")].tolist():
                i, j = a[k], b[k]
                while root[i] != i:
                    i = root[i]
                while root[j] != j:
                    j = root[j]
                if i != j:
                    root[max(i, j)] = min(i, j)
                    tree.append(k)
            near = np.array(tree, np.int64)
        return list(zip(reps[a[near]].tolist(), reps[b[near]].tolist()))
    group, found = np.arange(n), []
    for bound in (int(distance * TIGHT), distance):
        groups: dict[int, list[int]] = {}
        for k, g in enumerate(group.tolist()):
            groups.setdefault(g, []).append(k)
        left = np.ones(n, bool)
        for first in list(groups):
            if not left[first]:
                continue
            queue = list(groups[first])
            left[queue] = False
            for i in queue:
                others = np.flatnonzero(left)
                if not len(others):
                    break
                differing = fps[others] ^ fps[i]
                near = (np.bitwise_count(differing).sum(axis=1) <= bound) & ((differing.view(np.uint8) == 0).sum(axis=1) >= least)
                for k in others[near].tolist():
                    if left[k]:  # else its group came along with another member
                        found.append((int(reps[i]), int(reps[k])))
                        own = groups[group[k]]
                        left[own] = False
                        queue.extend(own)
            group[queue] = first
    return found


def links_of_lists(members: np.ndarray, distance: int, least: int, within=links_within) -> np.ndarray:
    """Distinct links (a, b) of whole posting lists: members has columns list, part, rep and the fingerprint's words, sorted by list and part."""
    cuts = np.flatnonzero((np.diff(members[:, :2], axis=0) != 0).any(axis=1)) + 1
    starts = np.concatenate(([0], cuts))
    sizes = np.diff(np.concatenate((starts, [len(members)])))
    two = starts[sizes == 2]
    differing = (members[two, 3:] ^ members[two + 1, 3:]).view(np.uint64)
    shared = (np.ascontiguousarray(differing).view(np.uint8) == 0).sum(axis=1)
    near = two[(shared >= least) & (np.bitwise_count(differing).sum(axis=1) <= distance)]
    found = [np.column_stack((members[near, 2], members[near + 1, 2]))]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        links = within(members[s : s + n, 2], np.ascontiguousarray(members[s : s + n, 3:]).view(np.uint64), distance, least)
        if links:
            found.append(np.array(links, np.int64))
    return np.unique(np.concatenate(found), axis=0)


def links_across(members: np.ndarray, distance: int, least: int, within=None) -> np.ndarray:
    """All pairs (a, b) of whole posting lists within the distance whose members have different components: as links_of_lists, a row's last column being its component.

    `within`, where given, has the last word (see `by_sets`), and what it links is one component from then on: so a list
    of alike members gives a tree, and one of members that are not alike gives nothing, however many pairs are compared.
    """
    found = [np.zeros((0, 2), np.int64)]
    cuts = np.flatnonzero((np.diff(members[:, :2], axis=0) != 0).any(axis=1)) + 1
    for start, rows in zip([0, *cuts.tolist()], np.split(members, cuts)):
        reps, of, fps = rows[:, 2], rows[:, -1].copy(), np.ascontiguousarray(rows[:, 3:-1]).view(np.uint64)
        if (of == of[0]).all():
            continue
        alike = within and within(start, len(rows))
        own = []
        for i in range(len(rows) - 1):
            others = i + 1 + np.flatnonzero(of[i + 1 :] != of[i])
            if alike:
                others = alike.of_size(i, others)
            differing = fps[others] ^ fps[i]
            near = (np.bitwise_count(differing).sum(axis=1) <= distance) & ((differing.view(np.uint8) == 0).sum(axis=1) >= least)
            differing, near = differing[near], others[near]
            if alike and len(near):
                near = alike(i, near[meet(differing)])
                near = near[np.unique(of[near], return_index=True)[1]]
                of[np.isin(of, of[near])] = of[i]
            own.append(np.column_stack((np.full(len(near), reps[i]), reps[near])))
        found.append(np.concatenate(own))
    return np.unique(np.concatenate(found), axis=0)


def meet(differing: np.ndarray) -> np.ndarray:
    """Which pairs of wide fingerprints, by their differing bits, share a posting list."""
    same = differing.view(np.uint8) == 0
    return (same[:, SETS[:, 0]] & same[:, SETS[:, 1]] & same[:, SETS[:, 2]]).any(axis=1)


class SetsOfList:
    """The shingle sets of one posting list's members, and which of them are alike by `similarity`."""

    def __init__(self, sets, similarity: float):
        self.similarity = similarity
        self.sizes = np.array([len(x) // 4 for x in sets], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        every, self.flat = np.unique(np.frombuffer(b"".join(sets), np.uint32), return_inverse=True)
        self.there = np.zeros(len(every), bool)

    def of_size(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others whose number of shingles doesn't rule them out."""
        low, high = np.minimum(self.sizes[i], self.sizes[others]), np.maximum(self.sizes[i], self.sizes[others])
        return others[low >= self.similarity * high]

    def __call__(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others, in order, that are alike to member i."""
        if not len(others):
            return others
        own = self.flat[self.starts[i] : self.starts[i + 1]]
        self.there[own] = True
        first, last = self.starts[others[0]], self.starts[others[-1] + 1]
        if 4 * self.sizes[others].sum() < last - first:
            both = np.array([np.count_nonzero(self.there[self.flat[self.starts[j] : self.starts[j + 1]]]) for j in others.tolist()])
        else:
            sums = np.concatenate(([0], np.cumsum(self.there[self.flat[first:last]])))
            both = sums[self.starts[others + 1] - first] - sums[self.starts[others] - first]
        self.there[own] = False
        return others[both >= self.similarity * (self.sizes[i] + self.sizes[others] - both)]


def by_sets(similarity: float):
    """For links_in_tasks over rows with a column `shingles`, with links_across: pairs that share a list of the wide index link if their sets are alike."""
    return lambda sets: lambda start, n: SetsOfList(sets[start : start + n].tolist(), similarity)


def links_in_tasks(dealt: DataFrame, words: list[str], distance: int, least: int, within=links_within, of_lists=links_of_lists) -> DataFrame:
    """Links (a, b) inside the parts of posting lists: rows (list, part, rep, words), of which a part is the unit of work.

    If the rows have a column `shingles`, `within` is first given those of the rows at hand.
    """
    more = ["shingles"] if "shingles" in dealt.columns else []

    def run(batches):
        held = sets = None
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3 + len(words))]
            block = np.column_stack([c.astype(np.int64) for c in cols])
            block = block if held is None else np.concatenate([held, block])
            if more:
                own = batch.column(3 + len(words)).to_numpy(zero_copy_only=False)
                sets = own if sets is None else np.concatenate([sets, own])
            # The last part may go on in the next batch.
            start = len(block) - int(np.argmax((block[::-1, :2] != block[-1, :2]).any(axis=1)) or len(block)) if len(block) else 0
            held = block[start:]
            if start:
                yield rows(block[:start], sets)
                sets = sets[start:] if more else None
        if held is not None and len(held):
            yield rows(held, sets)

    def rows(block, sets):
        found = of_lists(block, distance, least, within(sets) if more else within)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy(), pa.int64()), pa.array(found[:, 1].copy(), pa.int64())], names=["a", "b"])

    dealt = dealt.repartition("list", "part").sortWithinPartitions("list", "part", "rep")
    return dealt.select("list", "part", "rep", *words, *more).mapInArrow(run, "a long, b long")


def in_company(lists: DataFrame) -> DataFrame:
    """Rows of posting lists of two members and more, with the number n of members.

    The join is a shuffle by hint: Spark takes the lists for as small as the classes that they are made from, a
    hundredth of their size, and would broadcast them through the driver.
    """
    counts = lists.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    return lists.hint("merge").join(counts, "list")


def in_parts(lists: DataFrame, by: str, chunk: int) -> DataFrame:
    """Posting lists (list, .., n members) with a column part: lists of over `chunk` members are cut by a hash of `by`, and every two chunks meet in a part."""
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64(by), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.least(x, F.col("own")) * 65536 + F.greatest(x, F.col("own")))
    return lists.withColumn("parts", parts).withColumn("own", own).withColumn("part", F.explode(pairs)).drop("parts", "own", "n")


def near_links(classes: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) between the representatives of classes (rep, fp) of equal fingerprints.

    The links connect exactly what all pairs within `distance` bits connect. Posting lists with one member are dropped
    by a count; a list of more than CHUNK members is cut into chunks by a hash, and every two chunks meet in a task of
    their own, so no task holds more than a few thousand fingerprints however large a group of copies is.
    """
    if not 0 <= distance <= 5:
        raise ValueError("distance must be 0 to 5 bits")
    least = 8 - distance
    size = min(least, 3 if classes.count() <= THREE_BYTES_UP_TO else 4)
    lists = posting_lists(classes, covering(size, least))
    return links_in_tasks(in_parts(in_company(lists), "fp", CHUNK), ["fp"], distance, least)


def near_duplicates(df: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach from each row.

    Equal fingerprints form one class, linked through classes within `distance` bits. Null and empty texts have
    fingerprint zero and are linked like any other. Rows that repeat a doc_id are one document: their classes are
    joined. Rows with a null doc_id link others as all rows do, and have the component of what they link, null if that
    has no id. An empty table gives no rows; other columns of df are not looked at.

    A class is named by its fingerprint, so classes without an id are nodes like all others.
    """
    prints = written(fingerprints(df, shingle, doc_id, text), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    links = near_links(classes.select(F.col("fp").alias("rep"), "fp"), distance)
    twice = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("high")).where("a <> high")
    same = prints.join(twice, "doc_id").where("fp <> a").select("a", F.col("fp").alias("b"))
    components = written(connected_components(links.union(same)), "simhash-components")
    linked = classes.join(components, F.col("fp") == F.col("node"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    named = components.join(smallest, "component").select(F.col("node").alias("fp"), "smallest", F.lit(True).alias("linked"))
    # A class without links keeps its own smallest id.
    found = classes.join(named, "fp", "left").select("fp", F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("least")).alias("component_id"))
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_row_each(df: DataFrame, first: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Of the rows of each id in `first`, the one with the smallest text; and all rows without an id."""
    kept = df.join(first, doc_id, "left_semi")
    order = Window.partitionBy(doc_id).orderBy(F.col(text).asc_nulls_last())
    nth = next(n for n in (f"_nth{k}" for k in range(len(df.columns) + 1)) if n.lower() not in {c.lower() for c in df.columns})
    kept = kept.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth)
    return kept.unionByName(df.where(F.col(doc_id).isNull()))


def one_of_each_group(df: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with one row of each group of near-duplicates: the one with the smallest doc_id.

    Of rows that repeat that doc_id the one with the smallest text stays. Rows with a null doc_id stay as they are. All
    columns are kept.
    """
    found = near_duplicates(df, shingle, distance, doc_id, text)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return one_row_each(df, first, doc_id, text)


#: Classes whose posting lists, 224 rows each, one task makes.
TASK_CLASSES = 2_048
#: Words of 64 bits in a wide fingerprint.
WIDE = 4
#: Position triples of a wide fingerprint's index: these and their 31 shifts. Differences of the first five are all distinct,
#: so that they share no two positions; the last two are mirrors of the first two.
TRIPLES = ((0, 1, 7), (0, 2, 14), (0, 3, 11), (0, 4, 13), (0, 5, 15), (0, 6, 7), (0, 12, 14))
SETS = np.array([[(p + s) % (8 * WIDE) for p in triple] for triple in TRIPLES for s in range(8 * WIDE)])
#: Bytes of shingle sets of a group that are compared with as many in one task.
SET_BYTES = 2 << 20


def wide_fingerprint(data: bytes, shingle: int = 5) -> np.ndarray:
    """The SimHash of a text's set of shingles in 256 bits, as four unsigned words: their differing bits follow the sets' likeness.

    Words are as in `fingerprint`; a shingle that repeats counts once. A text without words gives zero.
    """
    words = data.lower().split()
    if not words:
        return np.zeros(WIDE, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n]
    ends = ends[-n:] - 1
    hashes = np.unique(np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, n))
    counts = np.zeros((WIDE, 64), np.int64)
    for at in range(0, len(hashes), BLOCK):
        for k in range(WIDE):
            lane = mix64(hashes[at : at + BLOCK] + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
            counts[k] += np.unpackbits(lane.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), axis=1).view(np.uint64).ravel()


def wide_fingerprints(df: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, f0 to f3) of every row, as signed longs. Null texts are read as empty."""
    names = [f"f{k}" for k in range(WIDE)]

    def run(batches):
        for batch in batches:
            for part, texts in in_slices(batch, 1):
                found = np.array([wide_fingerprint(x, shingle) for x in texts], np.uint64).reshape(-1, WIDE).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, k].copy()) for k in range(WIDE))], names=["doc_id", *names])

    schema = ", ".join(["doc_id long", *(f"{n} long" for n in names)])
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text")).mapInArrow(run, schema)


def wide_posting_lists(classes: DataFrame) -> DataFrame:
    """(list, rep): each class under the number and the three bytes of every position triple."""
    places, sets = 8 * WIDE, SETS
    numbers = np.arange(len(sets), dtype=np.int64) << 24

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                words = np.column_stack([part.column(k).to_numpy(zero_copy_only=False) for k in range(1, 1 + WIDE)])
                own = np.ascontiguousarray(words, np.int64).view(np.uint8).reshape(-1, places).astype(np.int64)
                keys = numbers | own[:, sets[:, 0]] << 16 | own[:, sets[:, 1]] << 8 | own[:, sets[:, 2]]
                rep = np.repeat(part.column(0).to_numpy(zero_copy_only=False), len(sets))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep)], names=["list", "rep"])

    return classes.mapInArrow(run, "list long, rep long")


def bits_apart(similarity: float, slack: float = 1.25) -> int:
    """Most differing bits of wide fingerprints whose shingle sets are alike by `similarity`, `slack` deviations above the mean.

    Sets of equal size with Jaccard similarity s have the cosine 2s / (1 + s); a bit differs with the share of the angle.
    """
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    bits = 64 * WIDE
    return round(bits * share + slack * (bits * share * (1 - share)) ** 0.5)


def shingle_set(data: bytes, shingle: int) -> np.ndarray:
    """The distinct word shingles of a text as sorted 32-bit hashes, words as in `fingerprint`; none for a text without words."""
    words = data.lower().split()
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if not words:
        return np.zeros(0, np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n]
    hashes = (xxhash.xxh3_64_intdigest(joined[s:e]) & 0xFFFFFFFF for s, e in zip(starts.tolist(), (ends[-n:] - 1).tolist()))
    return np.unique(np.fromiter(hashes, np.uint32, n))


def shingle_sets(df: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, shingles) of (doc_id, text) rows, the shingles as the bytes of `shingle_set`."""

    def run(batches):
        for batch in batches:
            for part, texts in in_slices(batch, 1):
                found = [shingle_set(x, shingle).tobytes() for x in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["doc_id", "shingles"])

    return df.mapInArrow(run, "doc_id long, shingles binary")


def alike_links(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of which some texts have shingle sets with a Jaccard similarity of `similarity` or more; texts: (doc_id, text as bytes)."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = written(shingle_sets(texts.join(named, "doc_id", "left_semi"), shingle), "shingles")

    def run(batches):
        for batch in batches:
            a, b, x, y = batch.columns
            keep = []
            for one, other in zip(x, y):
                one, other = (np.frombuffer(v.as_buffer(), np.uint32) for v in (one, other))
                both = len(np.intersect1d(one, other, assume_unique=True))
                every = len(one) + len(other) - both
                keep.append(both >= similarity * every)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    met = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def links_apart(pairs: DataFrame, near: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (a, b) between what the links `near` leave apart of classes (rep, f0 to f3) that candidate pairs (a, b) connect.

    Every candidate pair lies inside a group of classes that the pairs connect, so the groups of which near leaves more
    than one component are compared, each class with all classes of other components that it shares a posting list
    with. A group's members meet as they are, with their sets: rows are as many as members (times the chunks of a large
    group, of which every two meet in a task), not as many as pairs; the pairs are only compared inside of a task.
    """
    named = connected_components(near).select(F.col("node").alias("rep"), "component")
    # Through each class's smallest partner the pairs connect the same, and are about as many as classes.
    least = pairs.withColumn("m", F.min("a").over(Window.partitionBy("b")))
    grouped = connected_components(least.select("a", F.col("m").alias("b")).union(least.select("b", "m")).distinct()).select(F.col("node").alias("rep"), F.col("component").alias("list"))
    members = grouped.join(named, "rep", "left").select("list", "rep", F.coalesce("component", "rep").alias("component"))
    # Of a group of two the only pair was compared before.
    apart = members.groupBy("list").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("n > 2 and low < high")
    members = written(members.join(apart.select("list"), "list", "left_semi"), "apart")
    sets = shingle_sets(texts.join(members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), shingle)
    sets = written(sets.select(F.col("doc_id").alias("rep"), "shingles", F.length("shingles").alias("bytes")), "apart-sets")
    members = members.join(classes, "rep").join(sets, "rep")
    sizes = members.groupBy("list").agg(F.greatest(F.count("*"), F.ceil(F.sum("bytes") / SET_BYTES) * CHUNK).alias("n"))
    words = [f"f{k}" for k in range(WIDE)]
    dealt = in_parts(members.join(sizes, "list"), "rep", CHUNK).select("list", "part", "rep", *words, "component", "shingles")
    return links_in_tasks(dealt, [*words, "component"], bits_apart(similarity), len(TRIPLES[0]), by_sets(similarity), links_across)


def one_of_alike(df: DataFrame, shingle: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df with one row of each group of documents whose word shingles are alike by `similarity` or more, links of links included.

    Candidates are pairs of 256-bit SimHashes within a number of differing bits that share all three bytes of one of 224
    position triples; each candidate is then compared by its whole shingle sets (as 32-bit hashes), and only those that
    are alike by `similarity` link. So a document goes only if a chain of such pairs leads to the one that stays. Finding
    candidates is a chance, not a guarantee: at exactly 0.8 the bound on the bits is expected to pass 91 %. The nearest
    pairs are compared first, then all candidates that these leave apart. Texts with equal fingerprints are one class without a further
    comparison, and texts without words (null, empty) are one group. Of a group the smallest doc_id stays; of rows that repeat it the one with
    the smallest text. Rows that repeat a doc_id are one document, with the links of all of its rows. Rows with a null
    doc_id stay as they are and link nothing. All columns are kept, an empty table gives no rows.
    """
    if not 0.8 <= similarity <= 1:
        raise ValueError("the index finds likenesses of 0.8 or more")
    words = [f"f{k}" for k in range(WIDE)]
    prints = written(wide_fingerprints(df.where(F.col(doc_id).isNotNull()), shingle, doc_id, text), "simhash-wide")
    classes = written(prints.groupBy(*words).agg(F.min("doc_id").alias("rep")).select("rep", *words), "simhash-wide-classes")
    # The classes' files are small, their lists are not: dealt out first, a task counts and sorts half a million rows.
    lists = wide_posting_lists(classes.repartition(max(1, -(-classes.count() // TASK_CLASSES))))
    # Only members of lists with company carry their fingerprint on; they are counted where they meet, which shuffles the
    # lists once. An id with several texts stands for each of them.
    company = lists.withColumn("n", F.count("*").over(Window.partitionBy("list"))).where("n > 1")
    dealt = in_parts(company, "rep", CHUNK)
    # A class has at most 224 lists (times the chunks of the long ones): gathered, it meets its fingerprint once, not once a list.
    gathered = written(dealt.groupBy("rep").agg(F.collect_list(F.struct("list", "part")).alias("at")), "simhash-lists")
    dealt = gathered.join(classes, "rep").select("rep", *words, F.inline("at"))
    bounds = bits_apart(similarity), len(TRIPLES[0])
    pairs = links_in_tasks(dealt, words, *bounds, near_pairs_within)
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "simhash-pairs")
    texts = df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    twice = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    same = prints.join(twice, "doc_id").join(classes, words).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # Each class is compared with its smallest partner first; the groups that are then still apart are compared as wholes.
    near = written(alike_links(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), texts, shingle, similarity).union(same), "alike")
    components = connected_components(near.union(links_apart(pairs, near, classes, texts, shingle, similarity)))
    later = components.where("node <> component").select(F.col("node").alias("rep"))
    first = classes.select("rep").distinct().join(later, "rep", "left_anti").select(F.col("rep").alias(doc_id))
    return one_row_each(df, first, doc_id, text)
