"""Repeated passages and near-duplicate classes against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import repeats
from waybill.llm.components import components
from waybill.llm.jaccard import (
    Family,
    least_overlap,
    looked_at,
    must_share,
    near_duplicate_classes,
    one_of_each_class,
)
from waybill.llm.repeats import remove_repeats, sliding_least


def left_over(texts: list[str], window: int) -> list[tuple[int, int, str]]:
    """Words, removed words and the rest of each text, by counting all windows."""
    words = [t.encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((len(w), len(gone), kept))
    return out


@pytest.mark.parametrize(("window", "hot"), [(35, 2000), (35, 1), (5, 3), (3, 2000)])
def test_repeats(spark, messy, messy_rows, window, hot):
    got = remove_repeats(messy, window=window, hot=hot, keep=["doc_id"])
    rows = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.fillna(-1).collect())
    want = left_over([text for _, text in messy_rows], window)
    assert rows == sorted((-1 if i is None else i, *w) for (i, _), w in zip(messy_rows, want))


def test_many_copies_of_a_row(spark):
    words = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, words)] * 300 + [(2, words + " end")] * 2 + [(3, "short")], "doc_id long, text string")
    got = Counter((r["doc_id"], r["kept"]) for r in remove_repeats(df.repartition(7), hot=10).collect())
    assert got == {(1, ""): 300, (2, ""): 2, (3, "short"): 1}


def test_kept_columns_may_have_any_name(spark, messy):
    got = remove_repeats(messy, window=35, keep=["doc_id", "key", "n_words", "k0", "score"])
    assert got.columns == ["doc_id", "key", "n_words", "k0", "score", "n_words", "n_removed", "kept"]
    assert got.count() == messy.count()


def test_sliding_least():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, 200)
    for width in (1, 2, 3, 7, 28):
        want = [i + int(np.argmin(x[i : i + width])) for i in range(len(x) - width + 1)]
        assert sliding_least(x, width).tolist() == want


def shingles(text: str, n: int) -> set:
    words = text.encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def grouped(rows: list[tuple[int | None, str]], n: int, percent: int) -> tuple[list[set], list[int]]:
    """Shingles and group of each row, by comparing all pairs."""
    sets = [shingles(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def classes(rows: list[tuple[int | None, str]], n: int, percent: int) -> list[tuple]:
    """``id, shingles, smallest id`` of each row."""
    sets, group = grouped(rows, n, percent)
    smallest: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[group[i]] = min(doc_id, smallest.get(group[i], doc_id))
    return sorted(
        ((d, len(s), smallest.get(g) if s else d) for (d, _), s, g in zip(rows, sets, group)), key=str
    )


def test_classes(spark, messy, messy_rows):
    got = near_duplicate_classes(messy)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == classes(messy_rows, 5, 80)


@pytest.fixture(scope="module")
def chained(spark):
    """Texts that differ more and more from the first, so that links form chains."""
    rng = random.Random(8)
    rows = []
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(rng.randint(5, 60))]
        for _ in range(12):
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"n{rng.random()}"
            rows.append((rng.randint(0, 10_000), " ".join(words)))
    return rows


def test_chains_and_small_blocks(spark, chained, monkeypatch):
    monkeypatch.setattr("waybill.llm.jaccard.BLOCK_SHINGLES", 100)
    df = spark.createDataFrame(chained, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, near_duplicate_classes(df).collect()), key=str) == classes(chained, 5, 80)


def test_one_of_each_class(spark, messy, messy_rows):
    got = one_of_each_class(messy)
    assert got.columns == messy.columns
    rows = [(r["doc_id"], r["text"] or "") for r in got.collect()]
    sets, group = grouped(messy_rows, 5, 80)
    ids: dict[int, list] = {}
    for (doc_id, _), found, g in zip(messy_rows, sets, group):
        if found:
            ids.setdefault(g, []).append(doc_id)
    want = Counter(min((d for d in members if d is not None), default=None) for members in ids.values())
    assert Counter(d for d, t in rows if t.split()) == want
    assert sum(not t.split() for _, t in rows) == sum(not t.split() for _, t in messy_rows)


def test_search_finds_every_partner():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(20):
        base = rng.choice(10_000, rng.integers(1, 80), replace=False)
        for _ in range(rng.integers(1, 9)):
            other = base.copy()
            other[rng.random(len(other)) < 0.06] = rng.integers(10_000, 20_000)
            sets.append(np.unique(other).astype(np.uint64))
    sets.sort(key=len)
    family = Family(sets, 80)
    for i, a in enumerate(sets):
        shared = [len(np.intersect1d(a, b)) for b in sets]
        want = [j for j, (n, b) in enumerate(zip(shared, sets)) if 100 * n >= 80 * (len(a) + len(b) - n)]
        assert sorted(family.partners(i).tolist()) == want


def joined(near: list[set[int]]) -> set[frozenset]:
    """Groups of linked sets, by union-find over all links."""
    root = list(range(len(near)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, found in enumerate(near):
        for j in found:
            root[find(i)] = find(j)
    return parts([find(i) for i in range(len(near))])


def parts(group: list[int]) -> set[frozenset]:
    return {frozenset(i for i, g in enumerate(group) if g == h) for h in set(group)}


def chain(start: int, length: int) -> list[np.ndarray]:
    """Sets of one size, each linked to the one before and the one after it only."""
    return [np.arange(start + 2 * i, start + 2 * i + 18, dtype=np.uint64) for i in range(length)]


def linked_pairs(sets: list[np.ndarray]) -> list[set[int]]:
    """The sets linked to each, by comparing all pairs."""
    shared = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    return [
        {j for j, b in enumerate(sets) if 100 * shared[i][j] >= 80 * (len(a) + len(b) - shared[i][j])}
        for i, a in enumerate(sets)
    ]


class Links(Family):
    """A family of given links."""

    def __init__(self, near: list[set[int]]):
        self.sets, self.near = near, near

    def partners(self, x: int) -> np.ndarray:
        return np.array(sorted(self.near[x] | {x}))


def test_groups_when_the_largest_changes_between_passes():
    path = dict(zip([0, 1, 3, 2, 4, 6, 5, 7], chain(0, 8)))
    # Linked to set 5 only.
    path[8] = np.unique(np.append(np.delete(path[5], [8, 9]), [100, 101])).astype(np.uint64)
    sets = [path[i] for i in range(9)]
    near = linked_pairs(sets)
    links = {(i, j) for i, found in enumerate(near) for j in found if i < j}
    assert links == {(0, 1), (2, 3), (2, 4), (5, 6), (5, 7), (5, 8), (1, 3), (4, 6)}
    assert parts(Family(sets, 80).groups().tolist()) == joined(near) == {frozenset(range(9))}


def test_groups_of_chains_in_any_order():
    rng = random.Random(3)
    for _ in range(40):
        sets = [s for k in range(rng.randint(1, 3)) for s in chain(1000 * k, rng.randint(1, 25))]
        rng.shuffle(sets)
        assert parts(Family(sets, 80).groups().tolist()) == joined(linked_pairs(sets))


@pytest.mark.parametrize("in_order", [True, False])
def test_groups_of_linked_stars(in_order):
    """Stars of which each is larger than those before it, joined by links between their leaves."""
    rng = random.Random(7)
    for _ in range(2000):
        starts = [0]
        for k in range(rng.randint(2, 6)):
            starts.append(starts[-1] + k + rng.randint(1, 3))
        number = list(range(starts[-1]))
        if not in_order:
            rng.shuffle(number)
        leaves = [range(a + 1, b) for a, b in zip(starts, starts[1:]) if b > a + 1]
        links = [(a, i) for a, b in zip(starts, starts[1:]) for i in range(a + 1, b)]
        links += [tuple(rng.choice(rng.choice(leaves)) for _ in "ab") for _ in range(rng.randint(1, 6))] if leaves else []
        near: list[set[int]] = [set() for _ in number]
        for a, b in links:
            near[number[a]].add(number[b])
            near[number[b]].add(number[a])
        assert parts(Links(near).groups().tolist()) == joined(near)


def test_linked_sets_share_what_is_required():
    rng = random.Random(9)
    for _ in range(3000):
        size = rng.randint(1, 60)
        a = set(rng.sample(range(1000), size))
        b = set(a)
        for _ in range(rng.randint(0, 8)):
            b.discard(rng.choice(sorted(a)))
            b.add(rng.randint(0, 1000))
        if not b or 100 * len(a & b) < 80 * len(a | b):
            continue
        assert len(a & b) >= least_overlap(len(a), 80)
        heads = [set(sorted(s)[: looked_at(len(s), 80)]) for s in (a, b)]
        assert len(heads[0] & heads[1]) >= max(must_share(len(a), 80), must_share(len(b), 80))


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {i: i for e in edges for i in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    alone = {a for a, b in edges if a == b} - {i for a, b in edges if a != b for i in (a, b)}
    assert got == {k: v for k, v in root.items() if k not in alone}


def test_empty_tables(spark, messy):
    none = messy.filter("false")
    assert remove_repeats(none).count() == 0
    assert near_duplicate_classes(none).count() == 0
    assert one_of_each_class(none).count() == 0
    blank = messy.withColumn("text", F.lit(None).cast("string"))
    assert near_duplicate_classes(blank).filter("n_shingles = 0").count() == messy.count()


def test_a_common_string_is_sent_once_a_task(monkeypatch):
    monkeypatch.setattr(repeats, "REMEMBERED", 2000)
    sender = repeats.Sender(2)
    for i in range(300):
        sender.send(1, b"a common one", (i, -i), 0, 1)
        sender.send(2, b"string %d" % i, (i, -i), 9, 1)
    rows = sender.take().to_pylist()
    # The first row and one witness go to the bucket; the other rows are marked on the spot.
    assert [r["key"] for r in rows if r["packed"] == b"a common one"] == [0, None]
    assert sum(r["packed"] is None for r in rows) == 299
    assert sum(r["packed"] is not None and r["bucket"] == 2 for r in rows) == 300


def test_components_of_a_star_a_chain_and_loops(spark):
    edges = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (2000, 2000)]
    edges += [(499, 1040), (3001, 3000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    found = {r["node"]: r["root"] for r in components(df).collect()}
    want = {i: 0 for i in [*range(500), *range(1000, 1041)]} | {3000: 3000, 3001: 3000}
    assert found == want
    assert components(df.filter("a = b")).count() == 0
