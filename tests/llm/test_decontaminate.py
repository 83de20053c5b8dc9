"""Benchmark words against a search of every window."""

import random
import re

import pytest

from waybill.llm.decontaminate import mark_benchmark_words, window_fingerprints, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def expected(docs, items, window):
    windows = {}
    for item, text in items:
        said = words(text)
        size = min(window, len(said))
        for i in range(len(said) - size + 1 if size else 0):
            windows.setdefault(tuple(said[i : i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        said, hit, held = words(text), set(), set()
        for size in sizes:
            for i in range(len(said) - size + 1):
                found = windows.get(tuple(said[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    held |= found
        spans = []
        for p in sorted(hit):
            if spans and spans[-1][1] == p:
                spans[-1] = (spans[-1][0], p + 1)
            else:
                spans.append((p, p + 1))
        out.append((doc, len(said), len(hit), spans, sorted(held)))
    return sorted(out, key=str)


def marked(spark, docs, items, window=10):
    docs = spark.createDataFrame(
        [(d, t, "h", 1, 2, 3, 4, 5) for d, t in docs],
        "doc_id long, text string, hash string, key int, digest int, n_words int, runs int, items int",
    )
    items = spark.createDataFrame([(i, t, "l", 1) for i, t in items], "item_id long, text string, length string, window int")
    rows = mark_benchmark_words(docs.repartition(3), items, window=window).collect()
    return sorted(((r[0], r[1], r[2], [tuple(s) for s in r[3]], list(r[4])) for r in rows), key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcde0é", k=rng.randint(1, 5))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [(i, prose(rng.randint(10, 40)).upper()) for i in range(12)]
    items += [(20, items[0][1]), (21, items[1][1] + " more"), (21, prose(15)), (None, prose(12))]
    items += [(30, None), (31, ""), (32, " !? "), (33, "the"), (34, "one two three"), (35, "a b c d"), (36, "a b c d e f g")]
    items += [(37, "x " * 30), (38, "É é ÄÖ straße K K İ ab cd ef gh")]
    docs = [(i, prose(rng.randint(0, 60))) for i in range(20)]
    docs += [(100 + i, f"{prose(9)}, {text}\n{prose(5)}") for i, (_, text) in enumerate(items)]
    docs += [(200, " ".join(words(items[3][1])[:10])), (201, " ".join(words(items[3][1])[:9])), (202, "x-" * 5000)]
    docs += [(203, prose(30_000) + " " + items[4][1] + " THE end"), (204, items[38 - 20][1].lower() if items[18][1] else "")]
    docs += [(300, docs[25][1])] * 4 + [(None, docs[26][1]), (None, None), (205, "Straße K k"), (206, "z\x7fq the.THE")]
    return docs, items


def test_equals_every_window(spark, tables):
    docs, items = tables
    assert marked(spark, docs, items) == expected(docs, items, 10)


def test_other_window_lengths(spark, tables):
    docs, items = tables
    for window in (1, 3, 5):
        assert marked(spark, docs, items, window) == expected(docs, items, window)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert marked(spark, [], items) == []
    assert marked(spark, docs, []) == expected(docs, [], 10)


def test_equal_windows_share_a_fingerprint(spark):
    text = "p q r " + " ".join(f"w{i}" for i in range(12)) + " s t"
    rows = spark.createDataFrame([(text,), (" ".join(f"w{i}" for i in range(12)),)], "text string")
    whole, part = (r[0] for r in rows.select(window_fingerprints(words_of(rows.text), 10)).collect())
    assert whole[3:6] == part and len(whole) == 17 - 9
