"""Repair of conversation structure by a bidirectional Dijkstra search over the edit lattice.

A conversation is its rows by turn (null turns first; rows of one turn by role, then text). A row has at most one fault, the
first that holds: *blank* (no character besides ``[\\x20\\x09-\\x0D]``), *duplicate* (role and text stand earlier in the
conversation), *truncated* (its last such character is not one of ``.!?``). Edits make the roles' first letters
``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert an empty message of user or assistant 5; a
truncated row that is not deleted adds 5; blank and duplicate rows must be deleted. Of the cheapest edits those whose
letters (K, R, D, I) in a row, the audit, are the least in ASCII are taken. The audit alone tells the repaired
conversation: its length tells all roles.

The lattice has a node for each number of rows consumed and each state of the pattern. A forward heap starts at its
beginning and a reverse heap at its ends; nodes settle by cost, then by rows, with their least audit. The heaps go on until
no crossing of equal cost can be left, then the least audit of all crossings is taken. No two audits of equal cost between
the same two nodes are prefixes of each other (the longer would hold an insertion more), so the least parts make the least
whole: a longer conversation is cut into pieces, each searched from every state to every state, and the pieces are joined.

Rows are numbered in the order of conversations by a range partitioning. Blocks of ``BLOCK`` consecutive rows are
one run of rows each, so a conversation of any length is spread over many tasks; what comes out of a block for a
conversation is a table of 4 x 4 states. Only the digest of a repaired conversation, sequential by definition, reads its
rows in one task, as a stream.

Odd cases: null role and text count as one space, whose initial fits no pattern; an empty role likewise. Rows with a null
conv_id are one conversation. A repeated row is a duplicate. A conversation whose rows are all deleted has the digest of the
empty text, as one without rows. ``gaps`` counts turns missing between the lowest and the highest, at most 2^63 - 1. An
empty table gives an empty table, and columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.arrays import text_chunks
from pedalflow.llm.scratch import stored
from pedalflow.llm.ship import ship

BLOCK = 512  # rows
WHOLE, PIECE = 24, 8  # rows searched at once where a conversation starts and ends there, and in pieces of longer ones
KEEP, REROLE, DELETE, INSERT, LATE = 0, 1, 2, 5, 5  # costs

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_SPACES = " \t\n\x0b\x0c\r"
_ROW_BITS = 33  # of monotonically_increasing_id

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
# The state after the one message of user or assistant that may come next, and the states before it.
_FORCED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_FORCED_FROM = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_LEGAL = {"su", "ua", "au"}


def _row_edges(letter: str) -> list[tuple[int, int, int, str]]:
    """``(state before, state after, cost, edit)`` of a row: "-" must go, a capital letter is truncated."""
    edges = [(state, state, DELETE, "D") for state in range(4)]
    if letter != "-":
        late = LATE if letter.isupper() else 0
        edges += [(a, b, KEEP + late, "K") for (a, initial), b in _AFTER.items() if initial == letter.lower()]
        edges += [(a, b, REROLE + late, "R") for a, b in _FORCED.items()]
    return edges


_OUT = {c: [[e[1:] for e in _row_edges(c) if e[0] == q] for q in range(4)] for c in "-suaxSUAX"}
_IN = {c: [[(e[0], *e[2:]) for e in _row_edges(c) if e[1] == q] for q in range(4)] for c in "-suaxSUAX"}


def cheapest(letters: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """The least cost of editing the rows on the way from state ``entry`` to one of ``exits``, and its least audit."""
    n = len(letters)
    ahead: dict[tuple[int, int], tuple[int, str]] = {}
    behind: dict[tuple[int, int], tuple[int, str]] = {}
    forward = [(0, 0, "", entry)]
    reverse = [(0, -n, "", state) for state in exits]
    heapq.heapify(reverse)
    best = None

    def steps(i: int, state: int):
        if i < n:
            for after, cost, edit in _OUT[letters[i]][state]:
                yield (i + 1, after), cost, edit
        yield (i, _FORCED[state]), INSERT, "I"

    def steps_back(i: int, state: int):
        if i > 0:
            for before, cost, edit in _IN[letters[i - 1]][state]:
                yield (i - 1, before), cost, edit
        for before in _FORCED_FROM.get(state, ()):
            yield (i, before), INSERT, "I"

    while forward and reverse and (best is None or forward[0][0] + reverse[0][0] <= best):
        on = forward[0][0] <= reverse[0][0]
        cost, i, audit, state = heapq.heappop(forward if on else reverse)
        node = (abs(i), state)
        own, other = (ahead, behind) if on else (behind, ahead)
        if node in own:
            continue
        own[node] = (cost, audit)
        if node in other:
            best = min(cost + other[node][0], cost + other[node][0] if best is None else best)
        for to, more, edit in (steps if on else steps_back)(*node):
            if to in other:
                total = cost + more + other[to][0]
                best = total if best is None else min(total, best)
            if to not in own:
                if on:
                    heapq.heappush(forward, (cost + more, to[0], audit + edit, to[1]))
                else:
                    heapq.heappush(reverse, (cost + more, -to[0], edit + audit, to[1]))
    if best is None:
        return None
    crossings = [audit + behind[node][1] for node, (cost, audit) in ahead.items() if node in behind and cost + behind[node][0] == best]
    crossings += [
        audit + edit + behind[to][1]
        for node, (cost, audit) in ahead.items()
        for to, more, edit in steps(*node)
        if to in behind and cost + more + behind[to][0] == best
    ]
    return best, min(crossings)


Live = dict[int, tuple[int, str]]


@lru_cache(maxsize=200_000)
def _solved(letters: str) -> tuple[int, str]:
    return cheapest(letters, START, ENDS)


@lru_cache(maxsize=50_000)
def _cells(letters: str) -> list[tuple[int, int, int, str]]:
    """``(entry, exit, cost, audit)`` of a piece, for the states that it can lead between."""
    found = []
    for entry in range(4):
        for state in range(4):
            way = cheapest(letters, entry, (state,))
            if way is not None:
                found.append((entry, state, *way))
    return found


def advance(live: Live, cells: list[tuple[int, int, int, str]]) -> Live:
    """From the best ways to each state before a piece those to each state after it."""
    after: Live = {}
    for entry, state, cost, audit in cells:
        if entry in live:
            way = (live[entry][0] + cost, live[entry][1] + audit)
            if state not in after or way < after[state]:
                after[state] = way
    return after


def _through(letters: str, live: Live) -> Live:
    for begin in range(0, len(letters), PIECE):
        live = advance(live, _cells(letters[begin : begin + PIECE]))
    return live


def best_edits(letters: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if len(letters) <= WHOLE:
        return _solved(letters)
    live = _through(letters, {START: (0, "")})
    return min(live[state] for state in ENDS if state in live)


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with a fault put in by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its
    text, 2 takes away its ``.!?``, 3 repeats it, 4 makes its role user. Nulls are one space."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(fault == 4, "user").otherwise(text_of("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        conversations.filter(fault != 0)
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy"))
        .drop("_copy")
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    """``(position, conv_id, turn, initial, fault)``: all rows numbered in order, with their faults."""
    trimmed = F.rtrim(F.col("text"), F.lit(_SPACES))
    identity = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("conv_id").isNull(), F.length("role"), "role", "text")
    order = ["conv_id", "turn", "role", "text"]
    placed = stored(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            "turn",
            F.substring("role", 1, 1).alias("initial"),
            (trimmed == "").alias("blank"),
            (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
            F.unhex(F.sha2(identity, 256)).alias("identity"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "placed-messages",
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    # One row for each range partition.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).withColumn("x", F.struct("_part", "n"))
    offsets = (
        sizes.agg(F.sort_array(F.collect_list("x")).alias("x"))
        .select(F.col("x._part").alias("parts"), F.col("x.n").alias("sizes"))
        .select(F.posexplode("parts").alias("at", "_part"), "sizes")
        .select("_part", F.aggregate(F.slice("sizes", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("_before"))
    )
    position = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn("position", position)
    repeated = stored(
        numbered.filter("NOT blank")
        .groupBy("identity")
        .agg(F.min("position").alias("_first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "repeated-messages",
    )
    seen = F.coalesce(F.col("position") > F.col("_first"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(seen, DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(0)
    return numbered.join(repeated, "identity", "left").select("position", "conv_id", "turn", "initial", fault.alias("fault"))


_FACTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_CELL = pa.struct([("entry", pa.int8()), ("exit", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())])


class _Segment:
    """Rows of one conversation that follow each other, or what came out of them."""

    def __init__(self, turns: list, initials: list[str], faults: list[int]):
        known = [t for t in turns if t is not None]
        self.low, self.high = (known[0], known[-1]) if known else (None, None)
        self.turns = len(set(known))
        self.faults = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        letters = [i if i in ("s", "u", "a") else "x" for i in initials]
        self.first, self.last = letters[0], letters[-1]
        self.illegal = sum(a + b not in _LEGAL for a, b in zip(letters, letters[1:]))
        self.letters = "".join("-" if f in (BLANK, DUPLICATE) else c.upper() if f else c for c, f in zip(letters, faults))

    def cells(self) -> list[dict]:
        names = ("entry", "exit", "cost", "audit")
        return [dict(zip(names, (e, s, *way))) for e in range(4) for s, way in _through(self.letters, {e: (0, "")}).items()]


def _gaps(low, high, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, (1 << 63) - 1)


def _segments(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """For each conversation in each block of rows its segment: the result if the conversation is whole, else the cells."""
    names = ("block", "position", "conv_id", "turn", "initial", "fault")

    def emit(rows: list[tuple], whole: bool) -> dict:
        s = _Segment([r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows])
        cost, audit = best_edits(s.letters) if whole else (None, None)
        return {
            "conv_id": rows[0][2], "position": rows[0][1], "whole": whole, "first": s.first, "last": s.last, "low": s.low,
            "high": s.high, "turns": s.turns, "gaps": _gaps(s.low, s.high, s.turns), "blank": s.faults[0],
            "duplicate": s.faults[1], "truncated": s.faults[2], "illegal": s.illegal, "cost": cost, "audit": audit,
            "cells": None if whole else s.cells(),
        }

    def of_block(rows: list[tuple]) -> Iterator[dict]:
        begin = 0
        for end in range(1, len(rows) + 1):
            if end == len(rows) or rows[end][2] != rows[begin][2]:
                inside = rows[begin][1] % block_rows > 0 and rows[end - 1][1] % block_rows < block_rows - 1
                yield emit(rows[begin:end], inside)
                begin = end

    rows: list[tuple] = []
    for batch in batches:
        found: list[dict] = []
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if rows and row[0] != rows[0][0]:
                found.extend(of_block(rows))
                rows = []
            rows.append(row)
        yield _table(found, batch.schema)
    if rows:
        yield _table(list(of_block(rows)), batch.schema)


def _table(found: list[dict], given: pa.Schema) -> pa.RecordBatch:
    conv, turn = given.field("conv_id").type, given.field("turn").type
    long, text = pa.int64(), pa.string()
    fields = [("conv_id", conv), ("position", long), ("whole", pa.bool_()), ("first", text), ("last", text), ("low", turn),
              ("high", turn), ("turns", long), ("gaps", long), ("blank", long), ("duplicate", long), ("truncated", long),
              ("illegal", long), ("cost", long), ("audit", text), ("cells", pa.list_(_CELL))]
    return pa.RecordBatch.from_pylist(found, pa.schema(fields))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of conversations from their segments, which come in order."""
    fields = None
    total: dict | None = None
    live: Live = {}
    settled: list[str] = []

    def finished() -> dict:
        cost, audit = min(live[state] for state in ENDS if state in live)
        return {
            "conv_id": total["conv_id"], "gaps": _gaps(total["low"], total["high"], total["turns"]), "blank": total["blank"],
            "duplicate": total["duplicate"], "truncated": total["truncated"], "illegal": total["illegal"], "cost": cost,
            "audit": "".join(settled) + audit,
        }

    for batch in batches:
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        fields = pa.schema([("conv_id", batch.schema.field("conv_id").type), *[(c, pa.int64()) for c in names], ("audit", pa.string())])
        found = []
        for row in batch.to_pylist():
            if total is not None and row["conv_id"] != total["conv_id"]:
                found.append(finished())
                total = None
            if total is None:
                total, live, settled = row, {START: (0, "")}, []
            else:
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    total[name] += row[name]
                total["illegal"] += total["last"] + row["first"] not in _LEGAL
                total["last"] = row["last"]
                total["turns"] += row["turns"] - (row["low"] is not None and row["low"] == total["high"])
                total["low"] = row["low"] if total["low"] is None else total["low"]
                total["high"] = total["high"] if row["high"] is None else row["high"]
            live = advance(live, [(c["entry"], c["exit"], c["cost"], c["audit"]) for c in row["cells"]])
            # What all ways have in common is settled.
            common = os.path.commonprefix([audit for _, audit in live.values()])
            settled.append(common)
            live = {state: (cost, audit[len(common) :]) for state, (cost, audit) in live.items()}
        yield pa.RecordBatch.from_pylist(found, fields)
    if total is not None:
        yield pa.RecordBatch.from_pylist([finished()], fields)


def edits(rows: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of every conversation in ``rows``."""
    ship(rows.sparkSession)
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    marked = _with_faults(rows).withColumn("block", F.floor(F.col("position") / block_rows))
    blocks = marked.repartition("block").sortWithinPartitions("block", "position")
    segments = stored(
        blocks.mapInArrow(
            partial(_segments, block_rows=block_rows),
            f"conv_id {conv}, position bigint, whole boolean, first string, last string, low {turn}, high {turn}, turns bigint, "
            f"{_FACTS}, cells array<struct<entry: tinyint, exit: tinyint, cost: bigint, audit: string>>",
        ),
        "message-segments",
    )
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    cut = segments.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return segments.filter("whole").select(*names).unionByName(cut.mapInArrow(_joined, f"conv_id {conv}, {_FACTS}"))


def _messages(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired ``(role, text)`` of a conversation, given its rows in order."""
    odd = (len(audit) - audit.count("D")) % 2
    place = -odd  # of user in 0, 2, ...
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            yield role if edit == "K" else ("user", "assistant")[place % 2], text
            place += 1


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Each conversation's facts and its repaired messages, which must be read before going on."""

    def all_rows():
        for chunk in text_chunks(batches, "text"):
            yield from chunk.to_pylist()

    rows = all_rows()
    row = next(rows, None)
    while row is not None:
        conv, facts = row["conv_id"], None
        while row is not None and row["conv_id"] == conv and row["kind"] < 2:
            facts = row if row["kind"] == 1 or facts is None else facts
            row = next(rows, None)

        def own():
            nonlocal row
            while row is not None and row["conv_id"] == conv:
                yield row["role"], row["text"]
                row = next(rows, None)

        mine = own()
        yield facts, _messages(facts["audit"] or "", mine)
        for _ in mine:  # rows after the last one that the audit needs
            pass


def _arranged(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """For each conversation of ``conversations`` a row that names it, one with its edits, and its rows in order."""
    known = conversations.select("conv_id").distinct().withColumn("kind", F.lit(0))
    found = stored(edits(rows), "message-edits").withColumn("kind", F.lit(1))
    texts = rows.select("conv_id", "turn", "role", "text", F.lit(2).alias("kind"))
    together = known.unionByName(found, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    return together.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the repaired messages of every conversation."""
    ship(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches, schema = _peek(batches)
        if schema is None:
            return
        fields = pa.schema([("conv_id", schema.field("conv_id").type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        out: list[tuple] = []
        weight = 0
        for facts, messages in _streams(batches):
            for place, (role, text) in enumerate(messages):
                out.append((facts["conv_id"], place, role, text))
                weight += len(text)
                if len(out) >= 4000 or weight > 4 << 20:
                    yield _columns(out, fields)
                    out, weight = [], 0
        yield _columns(out, fields)

    return _arranged(conversations, rows).mapInArrow(emit, f"conv_id {conv}, place bigint, role string, text string")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``edits`` for every conversation of ``conversations``, of which ``rows`` are the present rows, with
    ``repaired_sha256``: the digest of its repaired ``role:text`` joined by newlines."""
    ship(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches, schema = _peek(batches)
        if schema is None:
            return
        fields = pa.schema(
            [("conv_id", schema.field("conv_id").type), *[(c, pa.int64()) for c in numbers], ("audit", pa.string()), ("repaired_sha256", pa.string())]
        )
        out: list[tuple] = []
        for facts, messages in _streams(batches):
            sha, between = hashlib.sha256(), ""
            for role, text in messages:
                sha.update(f"{between}{role}:{text}".encode())
                between = "\n"
            out.append((facts["conv_id"], *[facts[c] or 0 for c in numbers], facts["audit"] or "", sha.hexdigest()))
            if len(out) >= 4000:
                yield _columns(out, fields)
                out = []
        yield _columns(out, fields)

    return _arranged(conversations, rows).mapInArrow(digest, f"conv_id {conv}, {_FACTS}, repaired_sha256 string")


def _columns(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


def _peek(batches: Iterator[pa.RecordBatch]) -> tuple[Iterator[pa.RecordBatch], pa.Schema | None]:
    """The batches, and their schema if there are any."""
    first = next(batches, None)
    if first is None:
        return iter(()), None

    def again():
        yield first
        yield from batches

    return again(), first.schema
