"""Cheapest repair of a conversation's structure, by dynamic programming over runs.

Every row is a symbol: the initial of its role and its fault.  The states are what the repaired
roles may end with: nothing, a system turn, a user turn, an assistant turn.  A symbol's transition
says, from each state to each state, what the cheapest edits cost; transitions are multiplied
with (min, +), and a run of equal symbols takes the binary powers of its own, which are kept.

Among equally cheap edits the audit is the ASCII-least.  Edits from one state over the same rows
end with a row's edit, so none is the beginning of another, and it is enough to know their order:
a transition holds, next to the costs, the rank of its audits from each state.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import schema_with, stored

#: What parts words, how a whole text ends, the costs of edits.
SPACE = " \t\n\x0b\x0c\r"
FULL_STOPS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Inserted turns that make each state a whole conversation.
TAIL = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
#: Different rows, and characters, of a conversation that are worked on together.
PART_ROWS, PART_CHARS = 1024, 1 << 20


class Transition(NamedTuple):
    """For each pair of states: the cost, the audit's rank among those from the same state, and the
    state between the two factors."""

    cost: tuple[tuple[int, ...], ...]
    rank: tuple[tuple[int, ...], ...]
    via: tuple[tuple[int, ...], ...] = ()


IDENTITY = Transition(
    tuple(tuple(0 if p == q else NEVER for p in STATES) for q in STATES), tuple((0,) * 4 for _ in STATES)
)


def said_next(state: int) -> int:
    """The state after an inserted or re-roled turn."""
    return ASSISTANT if state == USER else USER


def kept_next(state: int, initial: str) -> int | None:
    """The state after a kept turn, if it fits."""
    if initial == "s" and state == NOTHING:
        return SYSTEM
    if initial == "u" and state != USER:
        return USER
    return ASSISTANT if initial == "a" and state == USER else None


@functools.cache
def edits(symbol: str) -> tuple[Transition, dict[tuple[int, int], str]]:
    """Transition and audits of one row.  ``symbol`` is ``x`` for a row that must go, else the
    role's initial (``-`` for any other) and ``+`` if the row is truncated."""
    least: dict[tuple[int, int], tuple[int, str]] = {}
    more = TRUNCATED if symbol.endswith("+") else 0
    for start in STATES:
        state = start
        # Three turns in a row lead where one does.
        for inserts in range(3):
            options = [(state, DELETE, "D")]
            if symbol != "x":
                options.append((said_next(state), REROLE + more, "R"))
                kept = kept_next(state, symbol[0])
                if kept is not None:
                    options.append((kept, more, "K"))
            for end, cost, letter in options:
                found = (cost + INSERT * inserts, "I" * inserts + letter)
                least[start, end] = min(least.get((start, end), (NEVER, "")), found)
            state = said_next(state)
    audits = {pair: audit for pair, (_, audit) in least.items()}
    cost = tuple(tuple(least[q, p][0] if (q, p) in least else NEVER for p in STATES) for q in STATES)
    order = [sorted(audits[q, p] for p in STATES if (q, p) in audits) for q in STATES]
    rank = tuple(tuple(order[q].index(audits[q, p]) if (q, p) in audits else 9 for p in STATES) for q in STATES)
    return Transition(cost, rank), audits


def _followed(cost: tuple[int, ...], rank: tuple[int, ...], by: Transition) -> tuple[list[int], list[int], list[int]]:
    """Costs, ranks and middle states from one state through two transitions."""
    costs, via = [], []
    for p in STATES:
        total, _, m = min((cost[m] + by.cost[m][p], rank[m], m) for m in STATES)
        costs.append(min(total, NEVER))
        via.append(m)
    keys = [(rank[via[p]], by.rank[via[p]][p]) for p in STATES]
    order = sorted({key for key, c in zip(keys, costs) if c < NEVER})
    return costs, [order.index(key) if c < NEVER else 9 for key, c in zip(keys, costs)], via


@functools.lru_cache(100_000)
def _product(a: Transition, b: Transition) -> Transition:
    rows = [_followed(a.cost[q], a.rank[q], b) for q in STATES]
    return Transition(*(tuple(tuple(row[i]) for row in rows) for i in range(3)))


def product(a: Transition, b: Transition) -> Transition:
    """First ``a``, then ``b``.  Costs are taken from the least one, so that few products differ."""
    low = min(map(min, a.cost))
    if not 0 < low < NEVER:
        return _product(a._replace(via=()), b._replace(via=()))
    shifted = tuple(tuple(c - low if c < NEVER else c for c in row) for row in a.cost)
    out = _product(Transition(shifted, a.rank), b._replace(via=()))
    return out._replace(cost=tuple(tuple(c + low if c < NEVER else c for c in row) for row in out.cost))


@functools.cache
def power(symbol: str, j: int) -> Transition:
    """The transition of ``2 ** j`` rows of one symbol."""
    if j == 0:
        return edits(symbol)[0]
    half = power(symbol, j - 1)
    return product(half, half)


def steps(symbol: str, count: int) -> Iterator[tuple[str, int]]:
    """The binary powers whose product is a run's transition."""
    for j in range(count.bit_length()):
        if count >> j & 1:
            yield symbol, j


def _audit(symbol: str, j: int, q: int, p: int) -> str:
    """Audit of ``2 ** j`` rows of one symbol from state q to state p."""
    if j > 10:
        m = power(symbol, j).via[q][p]
        return _audit(symbol, j - 1, q, m) + _audit(symbol, j - 1, m, p)
    return _short_audit(symbol, j, q, p)


@functools.lru_cache(10_000)
def _short_audit(symbol: str, j: int, q: int, p: int) -> str:
    if j == 0:
        return edits(symbol)[1][q, p]
    m = power(symbol, j).via[q][p]
    return _short_audit(symbol, j - 1, q, m) + _short_audit(symbol, j - 1, m, p)


def run_transition(runs: list[tuple[str, int]]) -> Transition:
    out = IDENTITY
    for symbol, count in runs:
        for step in steps(symbol, count):
            out = product(out, power(*step))
    return out


def unroll(runs: list[tuple[str, int]], start: int, end: int) -> str:
    """The ASCII-least of the cheapest audits of some runs from one state to another."""
    cost, rank = [NEVER] * 4, [9] * 4
    cost[start], rank[start] = 0, 0
    taken = [step for symbol, count in runs for step in steps(symbol, count)]
    middles = []
    for step in taken:
        cost, rank, via = _followed(cost, rank, power(*step))
        middles.append(via)
    pieces = []
    for (symbol, j), via in zip(reversed(taken), reversed(middles)):
        pieces.append(_audit(symbol, j, via[end], end))
        end = via[end]
    return "".join(reversed(pieces))


def repaired_turns(rows: Iterator[tuple[str, str]], audit: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """Turns that an audit makes of some rows, and the state after them."""
    out = []
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = kept_next(state, role[:1])
        else:
            state = said_next(state)
            role = "assistant" if state == ASSISTANT else "user"
        out.append((role, text))
    return out, state


class Part:
    """Neighbouring rows of one conversation, equal rows as one with their number."""

    def __init__(self, conv):
        self.conv = conv
        self.rows: list[tuple[str, str, int]] = []
        self.runs: list[tuple[str, int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = self.chars = 0
        self.turns: list[int] = []

    def add(self, turn: int | None, role: str, text: str, n: int, first: bool) -> None:
        if not n:
            return
        initial = role[:1]
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + initial not in LEGAL
        # Two equal initials are never legal.
        self.illegal += n - 1
        said = text.rstrip(SPACE)
        if not said:
            self.blank += n
            self._symbol("x", n)
        else:
            self.duplicate += n - bool(first)
            if first:
                short = said[-1] not in FULL_STOPS
                self.truncated += short
                self._symbol((initial if initial and initial in "sua" else "-") + ("+" if short else ""), 1)
            self._symbol("x", n - bool(first))
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.distinct += 1
            self.turns = [*self.turns[:1], turn]
        self.rows.append((role, text, n))
        self.chars += len(role) + len(text)

    def _symbol(self, symbol: str, n: int) -> None:
        if n and self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = symbol, self.runs[-1][1] + n
        elif n:
            self.runs.append((symbol, n))

    def record(self, at: int) -> dict:
        matrix = run_transition(self.runs)
        return {
            "conv": self.conv, "at": at, "rows": [{"role": r, "text": t, "n": n} for r, t, n in self.rows],
            "runs": [{"symbol": s, "n": n} for s, n in self.runs],
            "cost": [c for row in matrix.cost for c in row], "rank": [r for row in matrix.rank for r in row],
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "distinct": self.distinct, "first_turn": self.turns[0] if self.turns else None,
            "last_turn": self.turns[-1] if self.turns else None,
            "first_initial": self.rows[0][0][:1] if self.rows else None,
            "last_initial": self.rows[-1][0][:1] if self.rows else None,
        }


_PART = (
    "at long, rows array<struct<role:string,text:string,n:bigint>>, runs array<struct<symbol:string,n:bigint>>, "
    "cost array<bigint>, rank array<int>, blank long, duplicate long, truncated long, illegal long, distinct long, "
    "first_turn long, last_turn long, first_initial string, last_initial string"
)
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_STATS = ", ".join(f"{name} long" for name in _COUNTS)
#: Parts of conversations whose states are kept in memory at once, in a task.
_OUT_ROWS = 1000


def _cut(rows: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """Parts of the conversations in rows sorted by conversation and turn."""
    part = None
    for batch in rows:
        columns = [batch.column(name).to_pylist() for name in ("conv", "turn", "role", "text", "n", "first")]
        for conv, *row in zip(*columns):
            if part is None or conv != part.conv or len(part.rows) >= PART_ROWS or part.chars >= PART_CHARS:
                if part is not None:
                    yield part
                part = Part(conv)
            part.add(*row)
    if part is not None:
        yield part


def _route(parts: list[dict]) -> Iterator[dict]:
    """States before and after each part of one conversation; its counts go with the last."""
    cost, rank = [NEVER] * 4, [9] * 4
    cost[NOTHING], rank[NOTHING] = 0, 0
    middles = []
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0)
    first = last = last_initial = None
    for part in parts:
        matrix = Transition(*(tuple(tuple(part[k][i : i + 4]) for i in range(0, 16, 4)) for k in ("cost", "rank")))
        cost, rank, via = _followed(cost, rank, matrix)
        middles.append(via)
        for name in counts:
            counts[name] += part[name]
        if part["first_turn"] is not None:
            counts["distinct"] -= part["first_turn"] == last
            first = part["first_turn"] if first is None else first
            last = part["last_turn"]
        if part["first_initial"] is not None:
            counts["illegal"] += last_initial is not None and last_initial + part["first_initial"] not in LEGAL
            last_initial = part["last_initial"]
    total, _, end = min((cost[p] + INSERT * TAIL[p], rank[p], p) for p in STATES if cost[p] < NEVER)
    gaps = 0 if first is None else last - first + 1 - counts.pop("distinct")
    route = {"gaps": gaps if gaps < 2**63 else None, "cost": total, "tail": TAIL[end]} | {k: counts[k] for k in _COUNTS if k in counts}
    for part, via in zip(reversed(parts), reversed(middles)):
        yield {"at": part["at"], "start": via[end], "end": end} | route
        route = {}
        end = via[end]


def _records(rows: Iterator[dict], schema: pa.Schema, size: int = _OUT_ROWS) -> Iterator[pa.RecordBatch]:
    waiting: list[dict] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) >= size:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
) -> DataFrame:
    """The cheapest repair of every conversation, in parts:
    ``conv, at, audit, turns, gaps, blank, duplicate, truncated, illegal, cost``.

    A conversation's rows are taken by turn (NULL first); equal numbers by role, then the text's
    beginning and hash, so that repeated rows are neighbours.  NULL roles and texts count as one
    space.  Each row has one fault at most: blank (nothing but white space), duplicate (role and text
    seen earlier), truncated (does not end like a sentence).  ``audit`` has a letter per edit: Keep,
    Rerole, Delete, Insert; ``turns`` are the repaired ones.  ``at`` orders the parts; the counts stand
    with the last part of a conversation and are NULL in the others.  ``gaps`` is NULL if it
    does not fit 64 bits.  ``copies_col`` says how often a row counts (NULL: once); a conversation of which no row
    counts has zeros and an empty audit.  A NULL conversation is one of its own.  Other columns
    are not read; an empty table gives an empty result.

    Equal rows are one with a number before anything moves, and earlier texts are found by their
    least turn, never by a window; rows are then dealt by ranges of conversation and turn, so a
    conversation of any length is spread over tasks and no task holds more than a part.
    """
    n = F.lit(1) if copies_col is None else F.coalesce(F.col(f"`{copies_col}`"), F.lit(1))
    counts = n.cast("long") > 0
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        # Rows that do not count only name their conversation.
        F.when(counts, F.col(f"`{turn_col}`").cast("long")).alias("turn"),
        F.when(counts, F.coalesce(F.col(f"`{role_col}`"), F.lit(" "))).otherwise("").alias("role"),
        F.when(counts, F.coalesce(F.col(f"`{text_col}`"), F.lit(" "))).otherwise("").alias("text"),
        n.cast("long").alias("n"),
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    earliest = F.min(F.struct(F.col("turn").isNotNull(), F.col("turn").alias("turn")))["turn"]
    firsts = rows.filter("n > 0").groupBy("conv", "role", "digest").agg(earliest.alias("turn"))
    firsts = firsts.select("conv", "turn", "role", F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n"), "digest", F.lit(True).alias("first"))
    whole = (
        rows.withColumn("first", F.lit(False))
        .unionByName(firsts)
        .groupBy("conv", "turn", "role", "digest")
        .agg(F.max("text").alias("text"), F.sum("n").alias("n"), F.max("first").alias("first"))
    )
    order: list[Column] = [
        F.col("conv"), F.col("turn").isNotNull(), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.col("digest"),
    ]
    ordered = whole.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest")
    schema = schema_with(rows, ["conv"], _PART)
    arrow = _arrow(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges ascend with the number of the partition.
        base = TaskContext.get().partitionId() << 32
        yield from _records((part.record(base + i) for i, part in enumerate(_cut(batches))), arrow, 64)

    parts = stored(ordered.mapInArrow(cut, schema), "conversation-parts")

    narrow = [name for name in parts.columns if name not in ("rows", "runs")]
    routes = schema_with(parts, [], f"at long, start int, `end` int, tail int, {_STATS}")
    arrow_routes = _arrow(routes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of() -> Iterator[dict]:
            waiting: list[dict] = []
            for batch in batches:
                for part in batch.to_pylist():
                    if waiting and part["conv"] != waiting[0]["conv"]:
                        yield from _route(waiting)
                        waiting = []
                    waiting.append(part)
            if waiting:
                yield from _route(waiting)

        yield from _records(of(), arrow_routes)

    routed = parts.select(*narrow).repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(route, routes)
    with_states = parts.select("conv", "at", "rows", "runs").join(routed, "at")
    out = schema_with(parts, ["conv"], f"at long, audit string, turns array<struct<role:string,text:string>>, {_STATS}")
    arrow_out = _arrow(out)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of() -> Iterator[dict]:
            for batch in batches:
                for part in batch.to_pylist():
                    audit = unroll([(run["symbol"], run["n"]) for run in part["runs"]], part["start"], part["end"])
                    audit += "I" * (part["tail"] or 0)
                    rows = ((row["role"], row["text"]) for row in part["rows"] for _ in range(row["n"]))
                    turns, _ = repaired_turns(rows, audit, part["start"])
                    said = [{"role": role, "text": text} for role, text in turns]
                    yield {name: part[name] for name in ("conv", "at", *_COUNTS)} | {"audit": audit, "turns": said}

        yield from _records(of(), arrow_out, 64)

    return with_states.mapInArrow(repair, out)


def repair_digests(parts: DataFrame) -> DataFrame:
    """One row per conversation: its counts, the whole audit, and the sha256 of the repaired turns as
    ``role:text``, one to a line.  Parts are read in order, so only the audit is held whole."""
    schema = schema_with(parts, ["conv"], f"{_STATS}, audit string, repaired_sha256 string")
    arrow = _arrow(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of() -> Iterator[dict]:
            row = None
            for batch in batches:
                for part in batch.to_pylist():
                    if row is None or part["conv"] != row["conv"]:
                        if row is not None:
                            yield row | {"audit": "".join(audits), "repaired_sha256": said.hexdigest()}
                        row, audits, said, between = {"conv": part["conv"]}, [], hashlib.sha256(), b""
                    audits.append(part["audit"])
                    for turn in part["turns"]:
                        said.update(between + f"{turn['role']}:{turn['text']}".encode())
                        between = b"\n"
                    if part["cost"] is not None:
                        row |= {name: part[name] for name in _COUNTS}
            if row is not None:
                yield row | {"audit": "".join(audits), "repaired_sha256": said.hexdigest()}

        yield from _records(of(), arrow)

    return parts.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(digest, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with known faults: ``conv_id, turn, role, text, copies``, by a hash of id and turn."""
    text = F.coalesce("text", F.lit(" "))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
