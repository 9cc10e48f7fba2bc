"""Repair of conversations at the least cost, by branch and bound.

A conversation is to read as an optional system turn and then pairs of a user's and an assistant's turn. Rows are kept,
given another role or deleted, and empty turns are inserted; `cheapest` finds the edits of the least cost, and of those
the ones whose initials are least in ASCII order.

Rows are sorted by conversation and turn in ranges, so that a conversation with a large part of all rows is dealt to many
tasks. A conversation inside of a range is repaired where it is. One that reaches a range's edge, or is long, goes on as
blocks of rows: each block is solved from every state in which it may be entered to every state in which it may be left,
a pass over a conversation's solved blocks picks its states, and its repaired text is hashed block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Rows and bytes of text in a block.
ROWS, BYTES = 4_096, 1 << 20
#: States of a conversation that is read from its start: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES, FINAL = (NOTHING, SYSTEM, USER, ASSISTANT), (NOTHING, ASSISTANT)
#: The state after another turn by a user or an assistant, from each state, and the state after a row that is kept.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What edits cost, and what a truncated row costs that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
FAR = 1 << 60

#: A conversation's result, and a block of rows that is still to be repaired.
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"
BLOCK = "shard int, nth long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>, initials string, faults string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def suffix_bounds(initials: str, faults: str, exits: tuple[int, ...]) -> list[tuple[int, ...]]:
    """For each number of rows read and each state, the least cost of what is left to do, whatever its audit."""
    row = [0 if s in exits else FAR for s in STATES]
    found = [_with_inserts(row)]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        after = found[-1]
        if fault in "bd":
            row = [DELETE + after[s] for s in STATES]
        else:
            extra = TRUNCATED if fault == "t" else 0
            row = [min(DELETE + after[s], REROLE + extra + after[NEXT[s]]) for s in STATES]
            for s in STATES:
                kept = KEPT.get((initial, s))
                if kept is not None and extra + after[kept] < row[s]:
                    row[s] = extra + after[kept]
        found.append(_with_inserts(row))
    return found[::-1]


def _with_inserts(row: list[int]) -> tuple[int, ...]:
    user, assistant = min(row[USER], INSERT + row[ASSISTANT]), min(row[ASSISTANT], INSERT + row[USER])
    return min(row[NOTHING], INSERT + user), min(row[SYSTEM], INSERT + user), user, assistant


def cheapest(initials: str, faults: str, entry: int, exits: tuple[int, ...], bounds: list[tuple[int, ...]] | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the least edits that lead from a state to one of others, or None.

    initials: each row's role initial; faults: b or d for rows that must go, t for truncated ones. The search goes depth
    first with an explicit stack and takes edits in ASCII order, so audits are met in that order: a later prefix at the
    same rows and state is worse unless it costs less (the dominance table), and so is a later whole sequence (the
    incumbent). A prefix is given up when its cost and the suffix bound reach the incumbent, at first one more than the
    bound of all rows: the bounds leave out audits only, so some sequence costs what they say. (At equal cost no audit
    begins another one: what is left would be insertions, which cost.)
    """
    bounds = bounds or suffix_bounds(initials, faults, exits)
    if bounds[0][entry] >= FAR:
        return None
    n = len(initials)
    best: tuple[int, tuple | None] = (bounds[0][entry] + 1, None)
    dominance = [[FAR] * len(STATES) for _ in range(n + 1)]
    stack: list[tuple[int, int, int, tuple | None]] = [(0, entry, 0, None)]
    while stack:
        i, state, cost, audit = stack.pop()
        if cost + bounds[i][state] >= best[0] or cost >= dominance[i][state]:
            continue
        dominance[i][state] = cost
        if i == n and state in exits:
            best = (cost, audit)
        # The last one pushed is the first one taken: rerole, keep, insert, delete.
        if i < n:
            fault = faults[i]
            if fault not in "bd":
                extra = TRUNCATED if fault == "t" else 0
                stack.append((i + 1, NEXT[state], cost + REROLE + extra, ("R", audit)))
                kept = KEPT.get((initials[i], state))
                if kept is not None:
                    stack.append((i + 1, kept, cost + extra, ("K", audit)))
        stack.append((i, NEXT[state], cost + INSERT, ("I", audit)))
        if i < n:
            stack.append((i + 1, state, cost + DELETE, ("D", audit)))
    letters = []
    audit = best[1]
    while audit is not None:
        letters.append(audit[0])
        audit = audit[1]
    return best[0], "".join(reversed(letters))


def repaired_lines(roles: list[str], texts: list[str], audit: str, state: int = NOTHING) -> list[str]:
    """`role:text` of what an audit leaves, from a state on."""
    rows, lines = iter(zip(roles, texts)), []
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            lines.append(f"{NAMES[state]}:")
            continue
        role, text = next(rows)
        if edit == "R":
            state = NEXT[state]
            lines.append(f"{NAMES[state]}:{text}")
        elif edit == "K":
            state = KEPT[role[:1], state]
            lines.append(f"{role}:{text}")
    return lines


def own_fault(text: str) -> str:
    """b for blank, t for truncated, - for neither."""
    bare = text.rstrip(BLANKS)
    return "b" if not bare else "-" if bare[-1] in ENDS else "t"


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def summary(turns: list[int | None], initials: str, faults: str) -> dict:
    """Counts of rows in order; gaps without the row that makes them one."""
    known = [t for t in turns if t is not None]
    return {
        "first": known[0] if known else None, "last": known[-1] if known else None, "turns": len(set(known)),
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1)), "initials": initials[:1] + initials[-1:],
    }


def together(a: dict | None, b: dict) -> dict:
    """The summary of rows and of those that follow them."""
    if a is None:
        return b
    found = {c: a[c] + b[c] for c in ("turns", "blank", "duplicate", "truncated", "illegal")}
    if a["initials"] and b["initials"]:
        found["illegal"] += a["initials"][1] + b["initials"][0] not in LEGAL
    found["turns"] -= a["last"] is not None and a["last"] == b["first"]
    found["initials"] = (a["initials"] or b["initials"])[:1] + (b["initials"] or a["initials"])[1:]
    found["first"] = a["first"] if a["first"] is not None else b["first"]
    found["last"] = b["last"] if b["last"] is not None else a["last"]
    return found


def gaps(found: dict) -> int:
    return 0 if found["first"] is None else found["last"] - found["first"] + 1 - found["turns"]


def repair_one(turns, roles, texts, faults: list[str], initials: str, digests: list[bytes], keep_text: bool) -> tuple:
    """RESULT's columns for a whole conversation."""
    seen: set[bytes] = set()
    for k, d in enumerate(digests):
        if faults[k] != "b":
            if d in seen:
                faults[k] = "d"
            seen.add(d)
    joined = "".join(faults)
    cost, audit = cheapest(initials, joined, NOTHING, FINAL)
    counts, text = summary(turns, initials, joined), "\n".join(repaired_lines(roles, texts, audit))
    of_text = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return gaps(counts), counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, of_text, text if keep_text else None


def _schema(kind: str, fields: str) -> str:
    return f"conv_id {kind}, {fields}"


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _local(ordered: DataFrame, kind: str, keep_text: bool) -> DataFrame:
    """Results of the conversations inside of a partition, and blocks of the others, from rows in order."""
    schema = _schema(kind, f"{RESULT}, {BLOCK}")
    shape, empty = _arrow(ordered, schema), (None,) * 9

    def run(batches):
        from pyspark import TaskContext

        shard, nth, out, of = TaskContext.get().partitionId(), 0, [], 0
        conv, rows, size, whole, any_before = None, [], 0, True, False

        def block(rows):
            nonlocal nth
            here = [r for r in rows if r[3]]
            columns = [r[0] for r in here], [r[1] for r in here], [r[2] for r in here]
            faults, initials = [own_fault(t) for t in columns[2]], "".join((r[:1] or "-") for r in columns[1])
            nth += 1
            return (*columns, [digest(a, b) for a, b in zip(*columns[1:])], initials, faults)

        def closed(conv, rows):
            turns, roles, texts, digests, initials, faults = block(rows)
            return (conv, *repair_one(turns, roles, texts, faults, initials, digests, keep_text), *(None,) * 8)

        def opened(conv, rows):
            turns, roles, texts, digests, initials, faults = block(rows)
            return (conv, *empty, shard, nth, turns, roles, texts, digests, initials, "".join(faults))

        for batch in batches:
            for key, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and key != conv:
                    # The first conversation of a partition may have begun in the one before.
                    out.append(closed(conv, rows) if whole and any_before else opened(conv, rows))
                    of += size
                    rows, size, whole, any_before = [], 0, True, True
                elif not any_before and not rows:
                    whole = False
                conv = key
                rows.append((turn, role, text, present))
                size += len(role) + len(text)
                if len(rows) >= ROWS or size >= BYTES:
                    out.append(opened(conv, rows))
                    of += size
                    rows, size, whole = [], 0, False
                if len(out) >= ROWS or of >= 4 * BYTES:
                    yield _emit(out, shape)
                    out, of = [], 0
        if rows:
            out.append(opened(conv, rows))
        if out:
            yield _emit(out, shape)

    return ordered.select("conv_id", "turn", "role", "text", "present").mapInArrow(run, schema)


def _solved(blocks: DataFrame, kind: str) -> DataFrame:
    """Each block's faults with duplicates, and the cheapest way between any two states."""
    each = blocks.select("conv_id", "shard", "nth", F.posexplode("digests").alias("k", "digest"))
    first = each.groupBy("conv_id", "digest").agg(F.min(F.struct("shard", "nth", "k")).alias("at"))
    firsts = first.groupBy(F.col("at.shard").alias("shard"), F.col("at.nth").alias("nth")).agg(F.collect_set("at.k").alias("firsts"))
    slim = blocks.select("conv_id", "shard", "nth", "turns", "initials", "faults").join(firsts, ["shard", "nth"], "left")
    way = "array<struct<enter:int,leave:int,cost:long,audit:string>>"
    schema = _schema(kind, f"shard int, nth long, turns array<long>, initials string, faults string, ways {way}")
    shape = _arrow(blocks, schema)

    def run(batches):
        for batch in batches:
            rows = []
            for conv, shard, nth, turns, initials, faults, firsts in zip(*(c.to_pylist() for c in batch.columns)):
                known = set(firsts or ())
                faults = "".join("d" if f != "b" and k not in known else f for k, f in enumerate(faults))
                ways = []
                for leave in STATES:
                    bounds = suffix_bounds(initials, faults, (leave,))
                    for enter in STATES:
                        found = cheapest(initials, faults, enter, (leave,), bounds)
                        if found is not None:
                            ways.append({"enter": enter, "leave": leave, "cost": found[0], "audit": found[1]})
                rows.append((conv, shard, nth, turns, initials, faults, ways))
            if rows:
                yield _emit(rows, shape)

    return slim.select("conv_id", "shard", "nth", "turns", "initials", "faults", "firsts").mapInArrow(run, schema)


def _chained(solved: DataFrame, kind: str) -> DataFrame:
    """Each block's state at its start and its part of the audit; counts and cost of the conversation beside them.

    Blocks come in order, one row for some thousand rows of the conversation. For each state the best way there is kept;
    what all of them begin with is compared once.
    """
    schema = _schema(kind, "shard int, nth long, enter int, part string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    shape = _arrow(solved, schema)

    def finish(conv, places, steps, counts, ends):
        cost, _, state = min((ends[s] + (s,) for s in FINAL if s in ends), key=lambda x: x[:2])
        chosen = []
        for step in reversed(steps):
            enter, part = step[state]
            chosen.append((enter, part))
            state = enter
        numbers = (gaps(counts), counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost)
        return [(conv, *place, enter, part, *numbers) for place, (enter, part) in zip(places, reversed(chosen))]

    def run(batches):
        conv, places, steps, counts, ends, out = None, [], [], None, {NOTHING: (0, "")}, []
        for batch in batches:
            for key, shard, nth, turns, initials, faults, ways in zip(*(c.to_pylist() for c in batch.columns)):
                if places and key != conv:
                    out += finish(conv, places, steps, counts, ends)
                    places, steps, counts, ends = [], [], None, {NOTHING: (0, "")}
                    if len(out) >= 64:
                        yield _emit(out, shape)
                        out = []
                conv = key
                places.append((shard, nth))
                counts = together(counts, summary(turns, initials, faults))
                best: dict[int, tuple[int, str]] = {}
                step: dict[int, tuple[int, str]] = {}
                for way in ways:
                    enter, leave = way["enter"], way["leave"]
                    if enter in ends:
                        cost = ends[enter][0] + way["cost"]
                        if leave not in best or cost <= best[leave][0]:
                            found = (cost, ends[enter][1] + way["audit"])
                            if leave not in best or found < best[leave]:
                                best[leave], step[leave] = found, (enter, way["audit"])
                steps.append(step)
                shared = _shared([audit for _, audit in best.values()])
                ends = {s: (cost, audit[shared:]) for s, (cost, audit) in best.items()}
        if places:
            out += finish(conv, places, steps, counts, ends)
        if out:
            yield _emit(out, shape)

    ordered = solved.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "nth")
    return ordered.select("conv_id", "shard", "nth", "turns", "initials", "faults", "ways").mapInArrow(run, schema)


def _shared(texts: list[str]) -> int:
    """How many characters all texts begin with together."""
    low, high, n = min(texts), max(texts), 0
    while n < len(low) and n < len(high) and low[n] == high[n]:
        n += 1
    return n


def _hashed(chosen: DataFrame, blocks: DataFrame, kind: str, keep_text: bool) -> DataFrame:
    """Results of conversations in several blocks: their texts are repaired block by block, then hashed in order."""
    piece = _schema(kind, "shard int, nth long, part string, lines string, any boolean, " + ", ".join(f"{c} long" for c in COUNTS))
    of_piece = _arrow(blocks, piece)

    def edit(batches):
        for batch in batches:
            rows = []
            for conv, shard, nth, enter, part, roles, texts, *numbers in zip(*(c.to_pylist() for c in batch.columns)):
                lines = repaired_lines(roles, texts, part, enter)
                rows.append((conv, shard, nth, part, "\n".join(lines), bool(lines), *numbers))
            if rows:
                yield _emit(rows, of_piece)

    schema = _schema(kind, RESULT)
    of_result = _arrow(blocks, schema)

    def run(batches):
        conv, begun, out = None, False, []
        parts: list[str] = []
        texts: list[str] = []
        sha, numbers, some = hashlib.sha256(), (), False

        def done():
            return (conv, *numbers, "".join(parts), sha.hexdigest(), "\n".join(texts) if keep_text else None)

        for batch in batches:
            for key, part, lines, any_, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and key != conv:
                    out.append(done())
                    parts, texts, sha, some = [], [], hashlib.sha256(), False
                    if len(out) >= 64:
                        yield _emit(out, of_result)
                        out = []
                conv, begun, numbers = key, True, tuple(counts)
                parts.append(part)
                if any_:
                    sha.update((("\n" if some else "") + lines).encode("utf-8", "surrogatepass"))
                    some = True
                    if keep_text:
                        texts.append(lines)
        if begun:
            out.append(done())
        if out:
            yield _emit(out, of_result)

    texts = blocks.select("shard", "nth", "roles", "texts")
    edited = chosen.join(texts, ["shard", "nth"]).select("conv_id", "shard", "nth", "enter", "part", "roles", "texts", *COUNTS).mapInArrow(edit, piece)
    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "nth")
    return ordered.select("conv_id", "part", "lines", "any", *COUNTS).mapInArrow(run, schema)


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, keep_text: bool = False) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, repaired.

    Rows of a conversation are read by turn (nulls first), then role and a digest of the text. A row's first fault counts:
    blank text, duplicate (role and text seen earlier), truncated (no `.`, `!` or `?` at the end). Keeping a row costs 0,
    another role 1, deleting it 2 (a must for blank rows and duplicates), an empty turn 5, a truncated row that stays 5;
    audit has the initials of the cheapest edits, ties ASCII-least. repaired is the text (null unless keep_text is set).

    present: a boolean column that is false for rows that only name their conversation; a conversation without other
    rows has zeros, an empty audit and the empty text. Null roles and texts are read as one space, a null conv_id is a
    conversation of its own; rows without a turn make no gaps. Repeated rows are duplicates of each other. Other columns
    are not looked at, whatever their names; an empty table gives no rows.
    """
    here = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = df.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), here.alias("present"),
    )
    kind = dict(rows.dtypes)["conv_id"]
    order = ["conv_id", "turn", "role", "_of_text", "_row"]
    keyed = rows.withColumns({"_of_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(_local(ordered, kind, keep_text), "conversations")
    blocks = found.where("shard is not null")
    names = [f.split()[0] for f in RESULT.split(", ")]
    chosen = _chained(_solved(blocks, kind), kind)
    results = _hashed(chosen, blocks, kind, keep_text)
    return found.where("shard is null").select("conv_id", *names).unionByName(results.select("conv_id", *names))
