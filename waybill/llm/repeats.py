"""Removal of repeated passages: windows of words counted exactly in super-k-mers.

A window's minimiser is the least hash of the short word runs in it.  Consecutive windows of
a text that share one occurrence of their minimiser are a super-k-mer.  Equal windows have equal
minimisers, so they meet in one bucket.

1. Only minimisers travel at first: a window can be repeated only if its minimiser occurs in
   two super-k-mers.
2. Super-k-mers whose minimiser does go, as one packed string each, to its bucket.  There
   their windows are sorted, and equal neighbours are repeated.
3. The ranges of repeated words go back to their texts.

A super-k-mer that a task has sent before is repeated already: it is marked on the spot, and
one witness more goes to the bucket.  The windows of a minimiser with very many super-k-mers
travel one by one, each to the bucket of its own hash.  So no bucket gets more than a few
rows of a task for one string, and no more than ``hot`` super-k-mers that differ.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import carried, schema_with, stored
from waybill.llm.words import Words, ngram_hashes, sorted_groups, text_chunks

#: Words of the runs whose hashes are compared.
MINIMISER = 8
#: Bytes of packed strings that a task remembers as sent before it forgets those met only once.
REMEMBERED = 32 << 20
#: Two hashes of a row, and what stands there in a row of which nothing is to be removed.
Key = tuple[int | None, int | None]
WITNESS: Key = (None, None)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least of each ``width`` neighbours, by doubling."""
    place, reach = np.arange(len(x)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = place[:-step], place[step:]
        place = np.where(x[right] < x[left], right, left)
        reach += step
    return place


def super_kmers(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows and minimiser of each super-k-mer."""
    none = np.zeros(0, np.int64)
    short = min(MINIMISER, window)
    grams = ngram_hashes(words.hashes, short)
    long = words.sizes >= window
    if not long.any():
        return none, none, none, np.zeros(0, np.uint64)
    least = sliding_least(grams, window - short + 1)
    counts = np.where(long, words.sizes - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = least[words.starts[text] + first]
    # One place of the minimiser, so that equal windows of one text are in two super-k-mers.
    at = np.flatnonzero(np.diff(place, prepend=-1))
    return text[at], first[at], np.diff(np.append(at, len(text))), grams[place[at]]


def windows_of(packed: bytes, window: int) -> list[bytes]:
    """All windows of a packed super-k-mer."""
    borders = [0]
    at = packed.find(b" ")
    while at >= 0:
        borders.append(at + 1)
        at = packed.find(b" ", at + 1)
    borders.append(len(packed) + 1)
    return [packed[a : b - 1] for a, b in zip(borders, borders[window:])]


class Sender:
    """What a task sends to the buckets, and what it marks on the spot."""

    def __init__(self, window: int):
        self.window = window
        self.sent: dict[bytes, bool] = {}
        self.bytes = 0
        self.rows: list[tuple[int, bytes | None, Key, int, int]] = []
        self.marked: int | None = None

    def mark(self, key: Key, first: int, n: int) -> None:
        """A range to remove; one that meets the last one of the same text makes that longer.

        Without a string a row only passes through, by way of its text's hash.
        """
        if self.marked is not None:
            bucket, _, last_key, start, length = self.rows[self.marked]
            if last_key == key and start <= first <= start + length:
                self.rows[self.marked] = (bucket, None, key, start, max(length, first + n - start))
                return
        self.marked = len(self.rows)
        self.rows.append((key[0], None, key, first, n))

    def send(self, bucket: int, packed: bytes, key: Key, first: int, n: int) -> None:
        told = self.sent.get(packed)
        if told is None:
            if self.bytes > REMEMBERED:
                # Strings met again stay, so that a common one is sent once a task; too many go as well.
                self.sent = {p: True for p, again in self.sent.items() if again}
                self.bytes = sum(len(p) + 100 for p in self.sent)
                if self.bytes > REMEMBERED // 2:
                    self.sent, self.bytes = {}, 0
            self.bytes += len(packed) + 100
            self.sent[packed] = False
            self.rows.append((bucket, packed, key, first, n))
            return
        self.mark(key, first, n + self.window - 1)
        if not told:
            self.sent[packed] = True
            self.rows.append((bucket, packed, WITNESS, first, n))

    def take(self) -> pa.RecordBatch:
        rows = ((bucket, packed, *key, first, n) for bucket, packed, key, first, n in self.rows)
        columns = zip(*rows) if self.rows else ([], [], [], [], [], [])
        self.rows, self.marked = [], None
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "packed", "key", "tag", "first", "n"]
        )


def repeated_ranges(rows: list[tuple[bytes, Key, int]], window: int) -> Iterator[tuple[Key, int, int]]:
    """Ranges ``(key, first word, words)`` of repeated windows among one bucket's super-k-mers."""
    holders: dict[bytes, list[tuple[Key, int]]] = {}
    for packed, key, first in rows:
        holders.setdefault(packed, []).append((key, first))
    windows = sorted(
        (w, k, i, len(found) > 1)
        for k, (packed, found) in enumerate(holders.items())
        for i, w in enumerate(windows_of(packed, window))
    )
    repeated: list[list[int]] = [[] for _ in holders]
    for n, (w, k, i, often) in enumerate(windows):
        before = n > 0 and windows[n - 1][0] == w
        after = n + 1 < len(windows) and windows[n + 1][0] == w
        if often or before or after:
            repeated[k].append(i)
    for marks, found in zip(repeated, holders.values()):
        marks.sort()
        runs: list[list[int]] = []
        for i in marks:
            if runs and i == runs[-1][1] + 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        for key, first in found:
            if key != WITNESS:
                for a, b in runs:
                    yield key, first + a, b - a + window


def remove_repeats(
    docs: DataFrame,
    window: int = 35,
    hot: int = 2000,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """The columns ``keep``, then ``n_words, n_removed, kept`` of each row.

    Words are runs without ASCII white space, unchanged.  A word is removed if a window of
    ``window`` consecutive words of its text covers it whose words also start anywhere else,
    in this text or another; windows are those of the input, not of what is left.  ``kept`` is
    the other words, joined by one space.  A NULL or empty text has no words and an empty
    ``kept``; one with fewer words than a window keeps all.  Ids play no part: rows with one
    id are texts of their own, and a repeated row repeats its windows.  Of other columns only
    ``keep`` is read.  An empty table gives an empty result.
    """
    rows, names, _ = carried(docs, keep, text_col)
    # Equal texts have equal ranges, so 96 bits of hash of the row's kept columns and text may
    # stand for the row; the columns spread the rows of a hot text.
    tag = F.shiftright(F.xxhash64(F.lit(1), *names, "text"), 32).cast("int")
    rows = rows.select("*", F.xxhash64(*names, "text").alias("key"), tag.alias("tag"))

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            owner, first, n, minimiser = super_kmers(Words(texts), window)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(pa.array(owner)) for c in ("key", "tag")),
                    pa.array(first.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(minimiser.view(np.int64)),
                ],
                ["key", "tag", "first", "n", "minimiser"],
            )

    found = stored(
        rows.select("key", "tag", "text").mapInArrow(outline, "key long, tag int, first int, n int, minimiser long"),
        "super-kmers",
    )
    # Written, so that both sides of the join are dealt out for it alone and Spark may split
    # the rows of a common minimiser.
    often = found.groupBy("minimiser").agg(F.count("*").alias("times")).filter("times > 1")
    often = stored(often, "often")
    found_part = F.struct("first", "n", "minimiser", (F.col("times") > hot).alias("hot"))
    wanted = found.join(often, "minimiser").groupBy("key", "tag")
    wanted = wanted.agg(F.sort_array(F.collect_set(found_part)).alias("parts"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(window)
        for part, texts in text_chunks(batches):
            lists = part.column("parts").to_pylist()
            keys = zip(part.column("key").to_pylist(), part.column("tag").to_pylist())
            for key, text, parts in zip(keys, texts, lists):
                words = text.split()
                for p in parts:
                    first, n = p["first"], p["n"]
                    packed = b" ".join(words[first : first + n + window - 1])
                    if p["hot"]:
                        for i, one in enumerate(windows_of(packed, window)):
                            bucket = xxhash.xxh3_64_intdigest(one) - 2**63
                            sender.send(bucket, one, key, first + i, 1)
                    else:
                        sender.send(p["minimiser"], packed, key, first, n)
            yield sender.take()

    candidates = rows.join(wanted, ["key", "tag"]).select("key", "tag", *names, "text", "parts")
    sent = candidates.mapInArrow(send, "bucket long, packed binary, key long, tag int, first int, n int")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ("bucket",)):
            packed = group.column("packed").to_pylist()
            key = list(zip(group.column("key").to_pylist(), group.column("tag").to_pylist()))
            first, n = group.column("first").to_pylist(), group.column("n").to_pylist()
            marks = [(k, f, m) for p, k, f, m in zip(packed, key, first, n) if p is None]
            marks += repeated_ranges([(p, k, f) for p, k, f in zip(packed, key, first) if p is not None], window)
            columns = zip(*((*k, f, m) for k, f, m in marks)) if marks else ([], [], [], [])
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["key", "tag", "first", "n"]
            )

    marks = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        count, "key long, tag int, first int, n int"
    )
    ranges = marks.groupBy("key", "tag").agg(F.collect_set(F.struct("first", "n")).alias("ranges"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            n_words, n_removed, kept = [], [], []
            for text, covered in zip(texts, part.column("ranges").to_pylist()):
                words = text.split()
                n_words.append(len(words))
                if covered:
                    change = np.zeros(len(words) + 1, np.int64)
                    for r in covered:
                        change[r["first"]] += 1
                        change[r["first"] + r["n"]] -= 1
                    left = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    words = [words[i] for i in left.tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    *map(part.column, names),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                [*names, "n_words", "n_removed", "kept"],
            )

    marked = rows.join(ranges, ["key", "tag"], "left").select(*names, "text", "ranges")
    found = "n_words long, n_removed long, kept string"
    out = marked.mapInArrow(remove, schema_with(rows, names, found))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "n_words", "n_removed", "kept")
