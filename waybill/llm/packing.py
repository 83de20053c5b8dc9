"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Pieces of one length are interchangeable, so the packing is planned on the histogram of
lengths: at most ``capacity`` numbers, whatever the size of the corpus.  The plan says which
ranks of a length go to which sequences; each piece finds its place by its rank.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import per_worker, stored
from waybill.llm.token_counts import WORD, byte_letters, load_vocabulary

Group = tuple[tuple[int, ...], int]

#: Characters of white space in a row from which tokenizers encodes a text.
LONG_RUN = 10_000
LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")


class Encoder:
    """Ids of texts as the tokenizers library gives them.

    If ranks follow ids, a vocabulary needs no merge list, and the faster tiktoken gives the
    same ids; otherwise tokenizers itself is used.  So it is for texts with very long runs of white
    space, whose pattern exhausts the other's stack.
    """

    def __init__(self, path: str):
        self.fast = None
        self.path = path
        try:
            spec = load_vocabulary(path)
        except ValueError:
            return
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        plain = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
        if made == sorted(made) and len(plain) == 256 + len(set(made)):
            self.fast = tiktoken.Encoding(
                "vocabulary", pat_str=WORD.pattern, mergeable_ranks=plain, special_tokens=added
            )

    @functools.cached_property
    def slow(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self.path)

    def encode(self, text: str) -> list[int]:
        if self.fast is None or (len(text) > LONG_RUN and LONG_SPACE.search(text)):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")


def reduce_by_dominance(sizes: Counter, capacity: int) -> list[Group]:
    """Takes out of ``sizes`` all sets of at most three items that dominate every other set
    holding their largest item, so that some best packing has them; returns them.

    For an item j with room r beside it: j alone if nothing fits; j with an exact partner;
    j with the largest fitting item if no two others fit, or, where three never fit, if it is
    at least as large as any fitting pair; or that item with the best third, if every other
    fitting pair can be put in their places.
    """
    fixed: list[Group] = []
    if full := sizes.pop(capacity, 0):
        fixed.append(((capacity,), full))
    changed = True
    while changed:
        changed = False
        for j in sorted(sizes, reverse=True):
            while sizes[j] > 0:
                chosen = _dominating(sizes, j, capacity - j)
                if chosen is None:
                    break
                # Using a set only takes items away, so the choice stays right until one of
                # its own items runs out.
                need = Counter(chosen)
                times = min(sizes[item] // n for item, n in need.items())
                fixed.append((chosen, times))
                for item, n in need.items():
                    sizes[item] -= n * times
                changed = True
            if not sizes[j]:
                del sizes[j]
        for item in [s for s, n in sizes.items() if not n]:
            del sizes[item]
    return fixed


def _dominating(sizes: Counter, j: int, room: int) -> tuple[int, ...] | None:
    """A set with ``j`` that dominates all others with it, or None."""
    sizes[j] -= 1
    try:
        left = sorted(s for s, n in sizes.items() if n > 0 and s <= room)
        if not left:
            return (j,)
        if left[-1] == room:
            return j, room
        smallest = [s for s in left[:3] for _ in range(min(3, sizes[s]))][:3]
        best = left[-1]
        if len(smallest) < 2 or smallest[0] + smallest[1] > room:
            return j, best
        if len(smallest) == 3 and sum(smallest) <= room:
            return None
        # The widest fitting pair (p, q), p >= q, of each q.
        pairs = []
        for q in left:
            fitting = bisect(left, room - q)
            p = left[fitting - 1] if fitting else 0
            if p > q or (p == q and sizes[q] > 1):
                pairs.append((p, q))
        if all(p + q <= best for p, q in pairs):
            return j, best
        third = max((q for p, q in pairs if p == best), default=0)
        if third and all(q <= third or p + q <= best for p, q in pairs):
            return j, best, third
        return None
    finally:
        sizes[j] += 1


def best_fit(sizes: Counter, capacity: int) -> list[Group]:
    """Best-fit decreasing on a histogram: as one by one, but many equal bins at a time."""
    rooms: dict[int, list[Group]] = {0: []}
    done = rooms[0]
    for size in sorted(sizes, reverse=True):
        left = sizes[size]
        while left:
            room = min((r for r, groups in rooms.items() if r >= size and groups), default=None)
            items, bins = rooms[room].pop() if room is not None else ((), left)
            room = capacity if room is None else room
            each = min(room // size, left)
            used = min(bins, left // each)
            left -= each * used
            group = ((*items, *[size] * each), used)
            rooms.setdefault(room - each * size, []).append(group)
            if items and used < bins:
                rooms[room].append((items, bins - used))
    return [*done, *(g for r, groups in rooms.items() if r for g in groups)]


def plan_runs(sizes: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int]]]:
    """For each length its runs ``(first rank, first sequence, offset)``, in order of rank."""
    rest = Counter(sizes)
    groups = reduce_by_dominance(rest, capacity) + best_fit(rest, capacity)
    runs: dict[int, list[tuple[int, int, int]]] = {size: [] for size in sizes}
    placed: Counter = Counter()
    sequence = 0
    for items, bins in groups:
        offset = 0
        for size in items:
            runs[size].append((placed[size], sequence, offset))
            placed[size] += bins
            offset += size
        sequence += bins
    return runs


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document's tokens, cut if longer than ``capacity``, placed in sequences.

    Per piece: ``id, piece, start, length, ids_crc32, sequence_id, offset``.  A NULL text
    counts as empty: its document is the end id alone.  Rows stay apart, so a NULL or
    repeated id gives pieces of its own; other columns are not read.  Texts are never cut
    short, and an empty table gives an empty result.  Only the histogram of lengths, at most
    ``capacity`` rows, goes to the driver, and the plan made of it, a few runs per length,
    goes back to the tasks.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"encoder {path}", lambda: Encoder(path))
        part = TaskContext.get().partitionId()
        ranks: Counter = Counter()
        for batch in batches:
            owner, piece, start, length, crc, rank = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.array([*encoder.encode(text.as_py()), end_id], dtype="<u4")
                first = len(ids) % capacity or capacity
                borders = [0, *range(first, len(ids) + 1, capacity)]
                for i, (a, b) in enumerate(zip(borders, borders[1:])):
                    owner.append(row)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    rank.append(ranks[b - a])
                    ranks[b - a] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    pa.array([part] * len(owner), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                ["id", "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    pieces = stored(
        rows.mapInArrow(
            cut,
            f"id {id_type}, piece int, start long, length long, ids_crc32 long, part int, rank long",
        ),
        "pieces",
    )
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n"))
    runs = plan_runs({r["length"]: r["n"] for r in histogram.collect()}, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {size: np.array(found).T for size, found in runs.items()}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for size in np.unique(length):
                here = length == size
                ranks, sequences, offsets = tables[int(size)]
                run = np.searchsorted(ranks, rank[here], side="right") - 1
                sequence[here] = sequences[run] + rank[here] - ranks[run]
                offset[here] = offsets[run]
            kept = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(before, ["length", "part"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )
    placed = ranked.mapInArrow(
        place,
        f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return placed.withColumnRenamed("id", id_col)
