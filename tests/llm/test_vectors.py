"""Both searches against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm.ann import search_neighbours
from waybill.llm.exact_topk import LEVELS, Block, exact_top_k, scaled, segment_statistics

SCHEMA = "vec_id long, embedding array<float>, id string, v int, block int, party int, list int, score int, rank int"


def vectors(n: int, width: int) -> list[tuple]:
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, width))
    x[n // 2 :] = x[7]  # one common vector
    x[10] *= 50
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    odd = [None, [], [0.0] * width, [None, *[1.0] * (width - 1)], [float("nan")] * width, [float("inf")] * width]
    rows += [(n + i, v) for i, v in enumerate(odd)] + [(None, x[0].tolist())]
    return [(i, v, "a", 1, 2, 3, 4, 5, 6) for i, v in rows]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(vectors(400, 24), SCHEMA).repartition(5).cache()


def usable(rows: list[tuple], zero: bool) -> list[tuple[int, np.ndarray]]:
    out = []
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or (zero and not any(v)):
            continue
        out.append((i, np.array(v, dtype=np.float32).astype(float)))
    return out


def test_exact(spark, table):
    whole = table.withColumn("embedding", scaled(F.col("embedding")))
    got = exact_top_k(whole, whole.filter("vec_id % 9 = 0"), k=5, block_rows=50, query_rows=10)
    rows = [(i, np.floor(256 * v).astype(np.int64)) for i, v in usable(vectors(400, 24), zero=False)]
    want = []
    for q, y in rows:
        if q % 9 == 0:
            scored = sorted((-int(x @ y), i) for i, x in rows if i != q)[:5]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(50, 30)) * 256)
    for segments in (1, 4, 16, 30):
        table = segment_statistics(x, segments)
        low = ((table[:, None] - table[None]) ** 2).sum(axis=2)
        far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        assert (low <= far + 1e-6).all()


def test_each_level_keeps_all_that_may_be_best():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 64))
    x = np.floor(256 * (centres[rng.integers(0, 20, 500)] + 0.1 * rng.normal(size=(500, 64))))
    block, k = Block(np.arange(500), x), 5
    owners = np.arange(0, 500, 50)
    left = list(block.survivors(owners, x[owners], np.full(len(owners), -np.inf), k))
    assert len(left) == len(LEVELS)
    for q, owner in enumerate(owners):
        scores = x @ x[owner]
        scores[owner] = -np.inf
        best = np.flatnonzero(scores >= np.sort(scores)[-k])
        for alive in left:
            assert alive[q, best].all() and not alive[q, owner]
    counts = [int(alive.sum()) for alive in left]
    assert counts == sorted(counts, reverse=True) and counts[-1] < 500


def test_large_components(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(-(2**29), 2**29, size=(60, 8))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<long>")
    got = exact_top_k(df, df.filter("vec_id % 7 = 0"), k=4, block_rows=20, query_rows=3)
    want = []
    for q in range(0, 60, 7):
        scored = sorted((-sum(a * b for a, b in zip(x[i].tolist(), x[q].tolist())), i) for i in range(60) if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:4], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    wide = spark.createDataFrame([(0, [2.0**31, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        exact_top_k(wide, wide, k=1).collect()


def test_neighbours(spark, table):
    got = search_neighbours(table, table.filter("vec_id % 5 = 0"), k=7, sample_rows=64, block_rows=40)
    rows = usable(vectors(400, 24), zero=True)
    by_query = {}
    for r in got.collect():
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q, y in rows:
        if q % 5:
            continue
        scores = {i: float((x * y).sum()) for i, x in rows if i != q}
        found = sorted(by_query[q])
        assert [rank for rank, _, _ in found] == list(range(1, 8))
        assert all(abs(scores[i] - s) < 1e-9 for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted(((s, i) for _, i, s in found), key=lambda p: (-p[0], p[1]))
        least = sorted(scores.values(), reverse=True)[6]
        hits += sum(s >= least - 1e-9 for _, _, s in found)
        total += 7
    assert hits / total >= 0.9


def test_neighbours_fewer_than_asked(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random(), rng.random()]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert search_neighbours(df, df.filter("vec_id = 0"), k=20).count() == 3
    whole = df.withColumn("embedding", scaled(F.col("embedding")))
    assert exact_top_k(whole, whole.filter("vec_id = 0"), k=5).count() == 3


def test_empty_tables(spark, table):
    none = table.filter("false")
    for search in (search_neighbours, exact_top_k):
        got = search(none, none, k=3)
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
        assert search(table.filter("vec_id < 50"), none, k=3).count() == 0


def test_other_width_fails(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<double>")
    for search in (search_neighbours, exact_top_k):
        with pytest.raises(Exception, match="components"):
            search(df, df, k=1).collect()


def test_rows_that_share_an_id_all_count(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 4)).astype(np.float32)
    rows = [(i // 2, v) for i, v in enumerate(x.tolist())] + [(0, x[0].tolist()), (5, x[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = search_neighbours(df, df.filter("vec_id % 5 = 0"), k=6)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got.collect())
    want = []
    for i, (q, y) in enumerate(rows):
        if q % 5 == 0:
            y = np.array(y)
            scored = sorted((-round(float(np.dot(y, v)), 9), j) for at, (j, v) in enumerate(rows) if at != i)[:6]
            want += [(q, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    assert found == sorted(want)
