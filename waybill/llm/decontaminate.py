"""Benchmark passages inside documents, found by winnowing, with native expressions only.

A window is ``window`` consecutive words of an item.  Texts are cut into hashes of ``GRAM`` words;
of all those inside a window the least is the window's fingerprint.  Equal windows have equal
fingerprints, so a document that holds a window shows the item's fingerprint there, and
neighbouring windows mostly share one: a document gives a run of windows per fingerprint, about
one for every four words.  The runs that meet a fingerprint of the items are then extended to
their windows, which are compared as words.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import stored

#: Fixed value: what parts words, once letters are lower-case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a hash.
GRAM = 4


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), 0)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased and other letters as they are; NULL has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, BETWEEN, -1), "")


def window_fingerprints(words: Column, length: int) -> Column:
    """The fingerprint of every window of ``length`` words, in order."""
    gram = min(GRAM, length)
    hashes = F.transform(words, lambda x, i: F.xxhash64(x, *(F.get(words, i + j) for j in range(1, gram))))
    count = F.greatest(F.size(words) - (length - 1), F.lit(0))

    def least(h: Column) -> Column:
        others = range(1, length - gram + 1)
        least_of = (lambda x, i: F.least(x, *(F.get(h, i + j) for j in others))) if others else lambda x, i: x
        return F.transform(F.slice(h, F.lit(1), count), least_of)

    return _let(hashes, least)


def fingerprint_runs(words: Column, length: int) -> Column:
    """Runs ``(hash, start, stop, length)`` of neighbouring windows with one fingerprint."""

    def of(prints: Column) -> Column:
        begins = F.filter(
            F.transform(prints, lambda x, i: F.when((i == 0) | (F.get(prints, i - 1) != x), i)), lambda i: i.isNotNull()
        )
        return _let(
            begins,
            lambda b: F.transform(
                b,
                lambda start, j: F.struct(
                    F.get(prints, start).alias("hash"),
                    start.alias("start"),
                    F.coalesce(F.get(b, j + 1), F.size(prints)).alias("stop"),
                    F.lit(length).alias("length"),
                ),
            ),
        )

    return _let(window_fingerprints(words, length), of)


def _window(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def _ranges(sorted_ranges: Column) -> Column:
    """Ranges ``(start, stop)`` joined where they meet, of ones sorted so that within equal
    ``length`` starts and stops both ascend."""
    r = sorted_ranges

    def begins(i: Column) -> Column:
        # i counts from 0; beyond the end there is NULL, which begins something new.
        here, before = F.get(r, i), F.get(r, i - 1)
        goes_on = (here["length"] == before["length"]) & (here["start"] <= before["stop"])
        return (i == 0) | ~F.coalesce(goes_on, F.lit(False))

    firsts = F.filter(r, lambda x, i: begins(i))
    lasts = F.filter(r, lambda x, i: begins(i + 1))
    return F.zip_with(
        firsts, lasts, lambda a, b: F.struct(a["start"].alias("start"), b["stop"].alias("stop"), F.lit(0).alias("length"))
    )


def _covered(ranges: Column) -> Column:
    """Every place inside some range once, in order."""
    places = F.flatten(F.transform(ranges, lambda r: F.sequence(r["start"], r["stop"] - 1)))
    return F.array_sort(F.array_distinct(places))


def mark_benchmark_words(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``keep`` columns, ``n_words, n_hit, spans, items`` of every document.

    ``spans`` are the ranges ``(start, stop)`` of words that lie inside an occurrence of some
    item's window, joined where they touch; ``n_hit`` counts those words; ``items`` are the ids, as
    sorted strings, of the items with a window in the document.  An item with fewer than
    ``window`` words, but not none, is one window.  Texts that are NULL or without words have
    none and are never hit.  Rows with one item id are one item, a NULL id is the empty string;
    repeated documents each give their row, NULL ids included, and columns that are not in ``keep``
    are not read.  Without items, or in an empty table, nothing is hit.

    Nothing has a size limit.  Every document is read twice: for its fingerprints, and, if one
    of them is an item's, for the windows themselves.  Equal windows are one row on the items' side
    of each join, so a window that many documents hold, or many items, gives one row per
    occurrence; Spark chooses the join and splits hot keys.  Only the lengths of windows, at
    most ``window`` numbers, reach the driver.
    """
    asked = items.select(
        F.coalesce(F.col(f"`{item_id_col}`").cast("string"), F.lit("")).alias("item"),
        words_of(F.col(f"`{item_text_col}`")).alias("words"),
    ).filter(F.size("words") > 0)
    asked = stored(asked.withColumn("length", F.least(F.size("words"), F.lit(window))), "benchmark-words")
    lengths = sorted(row["length"] for row in asked.select("length").distinct().collect())

    def all_runs(words: Column, of_length: Column | None = None) -> Column:
        none = F.array().cast("array<struct<hash:bigint,start:int,stop:int,length:int>>")
        runs = [fingerprint_runs(words, n) for n in lengths]
        if of_length is not None:
            runs = [F.when(of_length == n, r).otherwise(none) for n, r in zip(lengths, runs)]
        return F.concat(none, *runs)

    # What is joined on keys that may be hot is written first: Spark splits only plain reads.
    prints = asked.select(F.inline(all_runs(F.col("words"), F.col("length")))).select("hash", "length").distinct()
    prints = stored(prints, "benchmark-fingerprints")
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    windows = (
        asked.select("item", "words", "length", F.explode(starts).alias("start"))
        .select("item", _window(F.col("words"), F.col("start"), F.col("length")).alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    windows = stored(windows, "benchmark-windows")

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    scanned = _let(
        words_of(text),
        lambda words: F.struct(F.size(words).cast("long").alias("n_words"), all_runs(words).alias("runs")),
    )
    # The short key may rarely stand for two texts: it only chooses what is compared.
    prepared = docs.select(
        *kept, F.xxhash64(text).alias("key"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), scanned.alias("s")
    )
    names = [f"k{i}" for i in range(len(keep))]
    prepared = stored(prepared.select(*names, "key", "digest", "s.n_words", "s.runs"), "fingerprints")

    runs = prepared.select("key", F.inline("runs"))
    met = runs.join(prints, ["hash", "length"], "left_semi")
    met = stored(met.groupBy("key").agg(F.collect_set(F.struct("start", "stop", "length")).alias("runs")), "met")
    texts = docs.select(F.xxhash64(text).alias("key"), text.alias("text")).join(met, "key")

    def candidates(words: Column) -> Column:
        def of(run: Column) -> Column:
            return F.transform(
                F.sequence(run["start"], run["stop"] - 1),
                lambda start: F.struct(
                    run["length"].alias("length"),
                    start.alias("start"),
                    (start + run["length"]).alias("stop"),
                    _window(words, start, run["length"]).alias("window"),
                ),
            )

        # A text with another's key can be shorter than its runs say.
        inside = F.filter("runs", lambda run: run["stop"] - 1 + run["length"] <= F.size(words))
        return F.flatten(F.transform(inside, of))

    candidate = texts.select(
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.inline(_let(words_of(F.col("text")), candidates)),
    )
    hits = (
        candidate.join(windows, "window")
        .groupBy("digest")
        .agg(
            F.sort_array(F.collect_set(F.struct("length", "start", "stop"))).alias("found"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select("digest", "items", _let(_ranges(F.col("found")), _covered).alias("places"))
    )
    single = F.transform(
        "places", lambda p: F.struct(p.alias("start"), (p + 1).alias("stop"), F.lit(0).alias("length"))
    )
    spans = _let(
        _let(single, _ranges),
        lambda all_of: F.transform(all_of, lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop"))),
    )
    hits = hits.select("digest", "items", F.size("places").cast("long").alias("n_hit"), spans.alias("spans"))
    joined = prepared.drop("runs", "key").join(stored(hits, "hits"), "digest", "left")
    return joined.select(
        *(F.col(name).alias(c) for name, c in zip(names, keep)),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
