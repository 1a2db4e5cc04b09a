"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from txrisk.llm import repair as mod
from txrisk.llm.repair import Costs, repair, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        h = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        own = out.setdefault(conv, [])
        if h:
            own += [(turn, role, text)] * (2 if h == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = text.rstrip(BLANK)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """(cost, audit, lines) by trying edits in order of cost: a plain shortest path over
    (rows used, initials given so far as far as the pattern tells them apart)."""
    import heapq

    kinds = faults(rows)
    heap, best = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, given, lines = heapq.heappop(heap)
        # what the pattern tells apart: nothing, s alone, or the last initial after a u
        state = (i, given if "u" not in given else given[-1] + "+")
        if state in best:
            continue
        best[state] = True
        if i == len(rows) and GOOD.match(given):
            return cost, audit, lines
        steps = [("I", 5, i, "u", "user:"), ("I", 5, i, "a", "assistant:")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append(("D", 2, i + 1, "", None))
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 if kinds[i] == "truncated" else 0
                if role[:1] in ("s", "u", "a") and role:
                    steps.append(("K", more, i + 1, role[0], f"{role}:{text}"))
                steps += [("R", 1 + more, i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for edit, c, j, initial, line in steps:
            after = given + initial
            if any(GOOD.match(after + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + c, audit + edit, j, after, lines if line is None else (*lines, line)))


def want(rows):
    out = []
    for conv, own in damage(rows).items():
        kinds = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = search(own)
        out.append((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in repaired(df).collect()), key=str)


def letters(rows):
    names = {"": "f", "truncated": "t", "blank": "b", "duplicate": "d"}
    at = lambda role: "sua".find(role[:1]) if role[:1] else -1
    return "".join(mod.LETTERS["ftbd".index(names[k]) * 4 + (at(r[1]) if at(r[1]) >= 0 else 3)] for k, r in zip(faults(rows), rows))


def test_edits_equal_exhaustive_search():
    rnd, costs = random.Random(6), Costs()
    for _ in range(2000):
        rows = [(i, rnd.choice(["system", "user", "assistant", "tool", ""]), rnd.choice(["a.", "b!", "c", "", f"{i}.", f"{i}"])) for i in range(rnd.randint(0, 9))]
        cost, audit, _ = search(rows)
        assert repair(letters(rows), costs) == (cost, audit)


def test_long_conversation_keeps_few_cost_vectors():
    rnd = random.Random(7)
    text = "".join(rnd.choice(mod.LETTERS) for _ in range(50_000))
    costs = Costs()
    cost, audit = repair(text, costs)
    assert len(audit.replace("I", "")) == len(text) and len(costs.known) < 2_000
    # the walk's own cost is the least cost
    state, total, i = 0, 0, 0
    for edit in audit:
        if edit == "I":
            total, state = total + 5, mod.NEXT[state]
            continue
        c, state = {e: (c, to) for e, c, to in mod.MOVES[text[i]][state]}[edit]
        total, i = total + c, i + 1
    assert total == cost and state in (mod.START, mod.ASSISTANT)


def conversation_rows(seed, convs):
    rnd = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, turn if rnd.random() > 0.05 else turn + 3, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
                         rnd.choice(["Fine.", "Well?", "and so", "", f"Number {turn}.", "zé日本!"])))
    # one row a turn, so that the order is settled
    return list({(r[0], r[1]): r for r in rows}.values())


def test_equals_search_over_tables(spark):
    rows = conversation_rows(8, 150)
    random.Random(1).shuffle(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == want(rows)


def test_long_conversation_over_pieces_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(mod, "PIECE", 64)
    rows = [(1, t, ("user", "assistant")[t % 2] if t % 7 else "user", "Same." if t % 5 == 0 else f"Turn {t}" + "." * (t % 3)) for t in range(3000)]
    rows += [(c, 0, "user", "Hello.") for c in range(2, 60)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(6)) == want(rows)


@pytest.mark.parametrize("extra", [False, True])
def test_odd_rows(spark, extra):
    rows = [(1, None, "user", "No turn."), (1, 5, None, "No role."), (1, 6, "user", None), (1, 7, "", "Empty role."),
            (None, 1, "user", "No conversation."), (None, None, "assistant", "Nor turn!"),
            (2, 1, "user", "word " * 30_000 + "."), (2, 2, "assistant", " \n\t\x0b "), (2, 3, "usher", "x" * 100_000),
            (3, None, None, None), (4, 1, "User", "Capital."), (5, -9, "user", "Far."), (5, 9, "assistant", "Off?")]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in ("conv", "copy", "key", "at", "own", "letter", "letters", "piece", "audit", "first", "hurt", "r", "t")})
    assert got(df) == want(rows)


def test_repeated_rows_are_duplicates(spark):
    rows = [(9, 3, "user", "Same.")] * 4 + [(9, 4, "assistant", "Yes.")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == want(rows)


def test_all_dropped_and_empty(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(7, gone, "user", "Gone.")], SCHEMA)
    assert got(df) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert got(df.limit(0)) == []
