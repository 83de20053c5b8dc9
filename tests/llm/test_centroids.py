"""Clustering against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from waybill.llm.centroids import build_tree, cluster_vectors, nearest, with_inertia

SCHEMA = "vec_id long, embedding array<float>, id string, v int, cluster string, distance int, ticket int"


def plain(rows, clusters, rounds, seed, width):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    ticket = lambda row: (hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1])
    centroids = [v for _, v in sorted(kept, key=ticket)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    total = sum(d for d, _ in found)
    per = {k: sum(d for d, c in found if c == k) for _, k in found}
    return sorted(((i, k, d, per[k], total) for (i, _), (d, k) in zip(kept, found)), key=str), centroids


def some_vectors(n, width, scale=1.0):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(n, width)) * scale).astype(np.float32)
    x[n // 2 : n // 2 + n // 3] = x[5]  # one common vector
    x[3] = -x[4]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    odd = [None, [], [1.0] * (width + 1), [None, *[1.0] * (width - 1)], [float("nan")] * width, [float("-inf")] * width]
    rows += [(n + i, v) for i, v in enumerate(odd)] + [(n + 50, [0.0] * width)]
    return rows + [rows[2], rows[2], (7, rows[9][1]), (None, rows[1][1]), (None, rows[3][1])]


@pytest.mark.parametrize("n, width, clusters, scale", [(150, 8, 12, 1.0), (150, 8, 12, 0.01), (40, 3, 60, 1.0), (30, 5, 1, 50_000.0)])
def test_equals_plain(spark, n, width, clusters, scale):
    rows = some_vectors(n, width, scale)
    table = spark.createDataFrame([(i, v, "a", 1, "c", 2, 3) for i, v in rows], SCHEMA).repartition(3)
    assigned, centroids = cluster_vectors(table, clusters=clusters, rounds=3, seed=2, width=width)
    got = sorted(map(tuple, with_inertia(assigned).collect()), key=str)
    want, want_centroids = plain(rows, clusters, 3, 2, width)
    assert got == want
    assert centroids.tolist() == want_centroids


def test_tree_search_is_exact_with_ties():
    rng = np.random.default_rng(8)
    for k, width, high in [(1, 3, 5), (5, 2, 3), (40, 4, 4), (40, 64, 300), (200, 3, 50)]:
        centroids = rng.integers(-high, high, (k, width))
        centroids[k // 2] = centroids[0]
        x = np.concatenate([rng.integers(-high, high, (500, width)), centroids])
        far = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
        number, best = nearest(x, centroids, build_tree(centroids))
        assert (best == far.min(axis=1)).all()
        assert (number == far.argmin(axis=1)).all()


def test_tree_leaves_sides_out(monkeypatch):
    import waybill.llm.centroids as C

    looked = []
    plain_distances = C.squared_distances
    rng = np.random.default_rng(9)
    centroids = rng.integers(-1000, 1000, (200, 2))
    nodes = build_tree(centroids)
    monkeypatch.setattr(C, "squared_distances", lambda x, c: looked.append(len(x) * len(c)) or plain_distances(x, c))
    nearest(rng.integers(-1000, 1000, (1000, 2)), centroids, nodes)
    assert sum(looked) < 1000 * 200 / 3


def test_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [2.0**19, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="not below"):
        cluster_vectors(table, clusters=1, rounds=1, width=2)[0].collect()


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assigned, centroids = cluster_vectors(table)
    assert with_inertia(assigned).collect() == [] and len(centroids) == 0
