"""Conversation repair against every possible list of edits, and against a plain row-by-row search."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from waybill.llm.queries import QUERIES
from waybill.llm.repair import repair_conversations, repair_digests, run_transition, unroll

LEGAL = re.compile(r"(s?(ua)+)?")


def result(rows: list[tuple[str, str, str]], letters: str) -> tuple[int, list[tuple[str, str]]] | None:
    """Cost and turns of some edits of rows ``(role, text, fault)``, if they are allowed."""
    said = sum(letter != "D" for letter in letters)
    want = ("s" if said % 2 else "") + "ua" * (said // 2)
    cost, at, turns, left = 0, 0, [], list(rows)
    for letter in letters:
        role, text, fault = ("", "", "") if letter == "I" else left.pop(0)
        if letter == "D":
            cost += 3
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += fault == "truncated"
        if letter in "IR":
            cost += 2
            role = {"u": "user", "a": "assistant"}.get(want[at : at + 1], "x")
        if role[:1] != want[at : at + 1]:
            return None
        turns.append((role, text))
        at += 1
    return (cost, turns) if not left and LEGAL.fullmatch(want) else None


def every_edit(rows) -> tuple[int, str]:
    best = None
    for letters in itertools.product("DKR", repeat=len(rows)):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + letter for n, letter in zip(inserts, [*letters, ""]))
            found = result(rows, audit)
            if found and (best is None or (found[0], audit) < best):
                best = (found[0], audit)
    return best


def row_by_row(rows) -> tuple[int, str]:
    """States by what the roles so far end with, each with its cheapest, then least, audit."""

    def said(state: str) -> str:
        return "a" if state == "u" else "u"

    def inserted(states):
        out = dict(states)
        for state, (cost, audit) in states.items():
            for n in (1, 2):
                state = said(state)
                found = (cost + 2 * n, audit + "I" * n)
                out[state] = min(out.get(state, found), found)
        return out

    states = {"": (0, "")}
    for role, _, fault in rows:
        new = {}

        def put(state, cost, audit):
            new[state] = min(new.get(state, (cost, audit)), (cost, audit))

        for state, (cost, audit) in inserted(states).items():
            put(state, cost + 3, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            put(said(state), cost + 2 + more, audit + "R")
            i = role[:1]
            if (i == "s" and state == "") or (i == "u" and state != "u") or (i == "a" and state == "u"):
                put(i, cost + more, audit + "K")
        states = new
    return min(found for state, found in inserted(states).items() if state in ("", "a"))


def symbols(rows) -> list[tuple[str, int]]:
    def of(role, fault):
        if fault in ("blank", "duplicate"):
            return "x"
        return (role[:1] if role[:1] in ("s", "u", "a") else "-") + ("+" if fault == "truncated" else "")

    return [(s, len(list(g))) for s, g in itertools.groupby(of(r, f) for r, _, f in rows)]


def by_runs(rows) -> tuple[int, str]:
    runs = symbols(rows)
    matrix = run_transition(runs)
    options = [(matrix.cost[0][p] + 2 * n, matrix.rank[0][p], p) for p, n in enumerate((0, 2, 1, 0))]
    cost, _, end = min(options)
    return cost, unroll(runs, 0, end) + "I" * (0, 2, 1, 0)[end]


def some_rows(rng, n, runs=False):
    kinds = [(r, f) for r in ("system", "user", "assistant", "tool") for f in ("", "", "", "truncated", "blank")]
    out = []
    while len(out) < n:
        kind = rng.choice(kinds)
        out += [kind] * (rng.randint(1, 40) if runs else 1)
    return [(r, f"t{i}", f) for i, (r, f) in enumerate(out[:n])]


def test_transitions_equal_every_edit_list():
    rng = random.Random(1)
    for _ in range(150):
        rows = some_rows(rng, rng.randint(0, 3))
        assert by_runs(rows) == every_edit(rows) == row_by_row(rows)


def test_transitions_equal_row_by_row():
    rng = random.Random(2)
    for _ in range(300):
        rows = some_rows(rng, rng.randint(0, 300), runs=rng.random() < 0.5)
        assert by_runs(rows) == row_by_row(rows)


def expected(turns: list[tuple]) -> list[tuple]:
    """The contract's rows from ``(conv_id, turn, role, text, copies)``."""
    out = []
    for conv in {t[0] for t in turns}:
        rows = [t for t in turns if t[0] == conv for _ in range(t[4])]
        rows = sorted(
            ((t is not None, t or 0, r or " " if r is None else r, " " if x is None else x, t) for _, t, r, x, _ in rows),
            key=lambda k: (*k[:3], k[3][:64], hashlib.sha256(k[3].encode()).hexdigest()),
        )
        seen, marked = set(), []
        for *_, role, text, _ in rows:
            said = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit = row_by_row(marked)
        numbers = [t for *_, t in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        counts = [sum(f == kind for *_, f in marked) for kind in ("blank", "duplicate", "truncated")]
        repaired = "\n".join(f"{role}:{text}" for role, text in result(marked, audit)[1])
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, copies int, at long, n int, rows string, first int, conv int"


def digests(spark, turns):
    table = spark.createDataFrame([(*t, 1, 2, "a", 3, 4) for t in turns], SCHEMA).repartition(3)
    rows = repair_digests(repair_conversations(table, copies_col="copies")).select(*COLUMNS).collect()
    return sorted(map(tuple, rows), key=str)


def test_messy_conversations(spark):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool", None, "", "User"]
    words = ["Yes.", "No", "", None, " \t", "So?", "é!", "one\ntwo.", "x" * 3000 + "."]
    turns = []
    for conv in range(40):
        for i in range(rng.randint(1, 12)):
            turn = rng.choice([i, i, i, None, 3, -5, 2**40])
            turns.append((conv, turn, rng.choice(roles), f"{rng.choice(words) or ''}", rng.choice([0, 1, 1, 1, 2])))
        turns.append((conv, 50, rng.choice(roles), rng.choice(words), 1))
    turns += [turns[5]] * 4 + [(None, 1, "user", "Hi.", 1), (None, 2, "assistant", "Hello.", 1), (77, 1, "user", "gone.", 0)]
    turns += [(78, None, None, None, 1), (79, 1, "user", "Same.", 100_000)]
    assert digests(spark, turns) == expected(turns)


def test_long_conversations_in_parts(spark):
    rng = random.Random(4)
    turns = [(1, i // 2, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}", "ok.", ""]), 1) for i in range(5000)]
    turns += [(2, None, "user", f"n{i}.", 1) for i in range(3000)] + [(3, 7, "user", "x" * 700_000 + f"{i}.", 1) for i in range(4)]
    assert digests(spark, turns) == expected(turns)


def test_empty_table(spark):
    assert digests(spark, []) == []


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    turns = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        turns.append((conv, turn, "user" if fault == 4 else role, text, {0: 0, 3: 2}.get(fault, 1)))
    got = QUERIES["op11_structure_repair"].run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select("conv_id", *COLUMNS[1:]).collect()), key=str) == expected(turns)
