"""Conversation repair against a plain search over all edits, and digests written out by hand."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalflow.llm import repair
from pedalflow.llm.queries import op13_conversation_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def plain_search(rows):
    """Cost, audit and messages: one heap ordered by cost, then audit, over (rows used, roles so far as a pattern state)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, tail, out = heapq.heappop(heap)
        key = (i, "" if not out else ("s" if len(out) == 1 and tail == "s" else tail[-1]))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", tail):
            return cost, audit, list(out)
        if key in done:
            continue
        done.add(key)

        def go(cost, edit, i, role, text):
            roles = tail + (role[:1] or "?")
            if re.fullmatch("s?(ua)*u?", roles):
                heapq.heappush(heap, (cost, audit + edit, i, roles, (*out, (role, text))))

        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, tail, out))
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                go(cost + late, "K", i + 1, role, text)
                for other in ("user", "assistant"):
                    go(cost + 1 + late, "R", i + 1, other, text)
        for other in ("user", "assistant"):
            go(cost + 5, "I", i, other, "")


def faults_of(rows):
    seen, marked = set(), []
    for role, text in rows:
        trimmed = text.strip(SPACES)
        fault = "blank" if not trimmed else "duplicate" if (role, text) in seen else "truncated" if trimmed[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    return marked


def by_hand(given_rows):
    """The contract's rows from plain Python."""
    convs = {}
    for r in given_rows:
        kept = convs.setdefault(r[0], [])
        conv, turn = (" " if x is None else x for x in r[:2])
        role, text = (" " if x is None else x for x in r[2:])
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(r[1], "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    result = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        marked = faults_of([r[1:] for r in rows])
        cost, audit, messages = plain_search(marked)
        count = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        letters = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        joined = "\n".join(f"{r}:{t}" for r, t in messages)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(joined.encode()).hexdigest())
    return result


def answer(df):
    found = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


LETTERS = st.text(st.sampled_from("-suaxSUAX"), max_size=14)


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_the_two_heaps_find_the_least_audit(letters):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}
    faults = ["blank" if c == "-" else "truncated" if c.isupper() else "" for c in letters]
    rows = [(names[c.lower()], "t", f) for c, f in zip(letters, faults)]
    assert repair.cheapest(letters, repair.START, repair.ENDS) == plain_search(rows)[:2]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("-suaxSUAX"), min_size=25, max_size=60))
def test_pieces_give_what_the_whole_gives(letters):
    assert repair.best_edits(letters) == repair.cheapest(letters, repair.START, repair.ENDS)


def test_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answer(op13_conversation_repair(spark, folder)) == by_hand(rows)


@pytest.mark.parametrize("block", [3, 16, 512])
def test_conversations_over_many_blocks(spark, block):
    """Blocks of a few rows cut conversations in all ways; one conversation holds most rows."""
    rows = [(1, t if t % 17 else None, ["user", "assistant", "tool", "system"][(t * t // 3) % 4], f"text {t % 29}" + ".?! "[t % 4]) for t in range(250)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(2, 40) for t in range(c % 5 + 1)]
    rows += [(99, t, "assistant", "always this.") for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = by_hand(rows)
    segments = {r.conv_id: r for r in repair.edits(repair.damaged(df), block).collect()}
    assert {c: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for c, r in segments.items()} == {
        c: e[:-1] for c, e in expected.items() if c in segments
    }


def test_awkward_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (1, None, "user", "b."), (1, None, "assistant", "c."),
        (1, 5, "user", "\t\n"), (1, 5, "", "no role."), (1, -(2**63), "user", "d"), (1, 2**63 - 1, "system", "e! "),
        (2, 1, "user", "x" * 100_000 + "."), (2, 2, "assistant", "ends in spaces. \x0b\x0c\r"), (3, 1, "system", "only a system."),
        (4, 1, "User", "capital?"), (5, 3, "user", "日本語。"), (6, 0, "unknown", "u by its letter."), (6, 1, "agent", "a by its letter!"),
    ]
    rows += [(7, t, "user", "dropped or not.") for t in range(3)] + [(c, 0, "user", "one.") for c in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("position", "kind", "block", "_part", "_first", "identity", "audit", "fault", "n"):
        df = df.withColumn(name, df["role"])
    expected = {c: (min(e[0], 2**63 - 1), *e[1:]) for c, e in by_hand(rows).items()}
    assert answer(repair.report(df, repair.damaged(df))) == expected
    none = df.filter("false")
    assert repair.report(none, repair.damaged(none)).collect() == [] and repair.repair(none, none).collect() == []


def test_a_conversation_without_rows_is_still_there(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "gone.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert answer(repair.report(df, repair.damaged(df))) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_messages(spark):
    rows = [(1, 0, "assistant", "first."), (1, 1, "assistant", "second."), (1, 2, "user", "third."), (2, 0, "system", "s."), (2, 1, "user", "cut")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, repair.repair(df, df).collect()))
    assert got == [(1, 0, "user", "first."), (1, 1, "assistant", "second.")]
    assert {r.conv_id: r.audit for r in repair.edits(df).collect()} == {1: "RKD", 2: "DD"}


def test_the_whole_of_a_conversation_streams(spark):
    """Thousands of rows in one conversation come out in order."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(5000)]
    got = repair.report(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA)).collect()
    joined = "\n".join(f"{r[2]}:{r[3]}" for r in rows)
    assert [(r.cost, r.audit, r.repaired_sha256) for r in got] == [(0, "K" * 5000, hashlib.sha256(joined.encode()).hexdigest())]
