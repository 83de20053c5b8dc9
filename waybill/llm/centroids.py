"""Centroid clustering on integers; the nearest centroid is found in a vantage-point tree.

Each round the tree is built over the centroids and broadcast.  A vantage point parts the centroids
below it into those within its radius and those beyond, and knows the least and the greatest
distance on each side.  By the triangle inequality that bounds a vector's distance to a side
from below.  Every vector looks at its most promising side first and leaves a side out only if
its bound is greater than the best distance so far, so equal distances are always seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import stored
from waybill.llm.vectors import matrix, usable

#: Centroids that a leaf holds at most.
LEAF = 4
#: Vectors that search together.
CHUNK_ROWS = 4096
#: Components must be smaller: squared distances then fit 64 bits.
LIMIT = 2**26
#: Relative slack on bounds, far more than the rounding of a square root.
SLACK = 1e-9


class Node(NamedTuple):
    """A vantage point with two sides, or a leaf (no sides); centroids by number."""

    members: np.ndarray
    sides: tuple[int, int] | None
    #: Least and greatest distance from the vantage point to the members of each side.
    spans: tuple[tuple[float, float], tuple[float, float]] | None


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as 64-bit integers."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for i, c in enumerate(centroids):
        gap = x - c
        out[:, i] = np.einsum("ij,ij->i", gap, gap)
    return out


def build_tree(centroids: np.ndarray) -> list[Node]:
    """Nodes, the root first.  The member farthest from the lowest-numbered one is the vantage point."""
    nodes: list[Node] = []

    def add(members: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(Node(members, None, None))
        if len(members) <= LEAF:
            return at
        far = squared_distances(centroids[members], centroids[members[:1]])[:, 0]
        vantage = members[int(far.argmax())]
        others = members[members != vantage]
        gaps = squared_distances(centroids[others], centroids[[vantage]])[:, 0]
        order = np.argsort(gaps, kind="stable")
        half = len(others) // 2
        parts = [order[:half], order[half:]]
        spans = tuple((float(np.sqrt(gaps[p].min())), float(np.sqrt(gaps[p].max()))) for p in parts)
        nodes[at] = Node(np.array([vantage]), None, spans)
        sides = tuple(add(others[p]) for p in parts)
        nodes[at] = nodes[at]._replace(sides=sides)
        return at

    add(np.arange(len(centroids)))
    return nodes


def nearest(x: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of each row, ties to the smaller
    number.  Each row keeps its own order of nodes, best bound first; rows that are at the
    same node do their sums together."""
    n = len(x)
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, len(centroids))
    waiting = np.full((n, len(nodes)), np.inf)
    waiting[:, 0] = 0.0
    active = np.arange(n)
    while len(active):
        at = waiting[active].argmin(axis=1)
        bound = waiting[active, at]
        going = bound <= np.sqrt(best[active].astype(float)) * (1 + SLACK)
        # A row whose best bound is beyond its distance is done; NaN-free, since bounds are never negative.
        going &= np.isfinite(bound)
        active, at, bound = active[going], at[going], bound[going]
        for k in np.unique(at):
            here = at == k
            rows, low = active[here], bound[here]
            waiting[rows, k] = np.inf
            node = nodes[k]
            far = squared_distances(x[rows], centroids[node.members])
            for j, c in enumerate(node.members):
                better = (far[:, j] < best[rows]) | ((far[:, j] == best[rows]) & (c < number[rows]))
                best[rows[better]] = far[better, j]
                number[rows[better]] = c
            if node.sides:
                d = np.sqrt(far[:, 0].astype(float))
                for side, (least, most) in zip(node.sides, node.spans):
                    gap = np.maximum(np.maximum(d - most, least - d), 0.0)
                    gap -= SLACK * (d + most)
                    waiting[rows, side] = np.maximum(low, np.maximum(gap, 0.0))
    return number, best


def _components(vector: Column, width: int) -> Column:
    """Components as integers of a vector that takes part, or NULL."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256))
    large = F.exists(vector, lambda x: F.abs(x.cast("double")) * 256 >= LIMIT)
    refused = F.raise_error(F.lit(f"a component is not below {LIMIT} in size")).cast("array<int>")
    return F.when(
        usable(vector) & (F.size(vector) == width), F.when(large, refused).otherwise(whole.cast("array<int>"))
    )


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    seed: int = 2,
    width: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every vector that takes part, and the final centroids.

    Vectors of exactly ``width`` components, none NULL or non-finite, take part; a component x
    counts as floor(256 * x), and one of 2^26 or more fails the job, since distances would not
    fit 64 bits.  The first centroids are the vectors with the least sha256 of ``seed:id``, in
    that order (a NULL id counts as empty text; among rows with one id the least vector goes
    first); fewer vectors give fewer centroids.  In each round every vector goes to its nearest
    centroid (ties: the smaller number), then each centroid with vectors becomes the floor of
    their mean.  A last assignment follows.  Repeated rows all count.  Other columns are
    not read; an empty table gives an empty result and no centroids.

    Tasks add up what they assign, so a round moves and sends to the driver at most ``clusters``
    rows of sums per task, whatever the input's size; the tree is as small.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), _components(F.col(f"`{vector_col}`"), width).alias("v"))
    rows = stored(rows.filter(F.col("v").isNotNull()), "vectors")
    ticket = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(ticket.alias("ticket"), "v").orderBy("ticket", "v").limit(clusters).collect()
    centroids = np.array([row["v"] for row in first], np.int64).reshape(len(first), width)
    if not len(first):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).filter("false"), centroids

    def assigned(batch: pa.RecordBatch, tree) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for start in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(start, CHUNK_ROWS)
            x = matrix(part.column("v")).astype(np.int64)
            points, nodes = tree.value
            yield part, x, *nearest(x, points, [Node(*node) for node in nodes])

    def broadcast():
        # Plain tuples: what is broadcast must not need this package on a worker's path.
        return spark.sparkContext.broadcast((centroids, [tuple(node) for node in build_tree(centroids)]))

    for _ in range(rounds):
        tree = broadcast()

        def add_up(batches: Iterator[pa.RecordBatch], tree=tree) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((clusters, width), np.int64)
            counts = np.zeros(clusters, np.int64)
            for batch in batches:
                for _, x, number, _ in assigned(batch, tree):
                    counts += np.bincount(number, minlength=clusters)
                    np.add.at(sums, number, x)
            there = np.flatnonzero(counts)
            columns = [pa.array(there, pa.int32()), pa.array(counts[there]), pa.array(list(sums[there]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

        parts = rows.select("v").mapInArrow(add_up, "cluster int, n long, sums array<long>")
        # Sums of sums may pass 64 bits.
        wide = "decimal(38,0)"
        total = parts.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", i).cast(wide)) for i in range(width))).alias("sums")
        )
        for row in total.collect():
            centroids[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
        tree.unpersist()

    tree = broadcast()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, number, best in assigned(batch, tree):
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(number, pa.int32()), pa.array(best)], ["id", "cluster", "distance"]
                )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(assign, f"id {id_type}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame) -> DataFrame:
    """Adds ``cluster_inertia`` and ``inertia``: distances added up over the cluster and over all."""
    assigned = stored(assigned, "assigned")
    # At most one row per cluster.
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    by_cluster = {row["cluster"]: int(row["total"]) for row in sums.collect()}
    known = F.create_map(*(F.lit(x) for c, s in by_cluster.items() for x in (c, s))) if by_cluster else None
    own = F.element_at(known, F.col("cluster")) if by_cluster else F.lit(0)
    return assigned.withColumns(
        {"cluster_inertia": own.cast("long"), "inertia": F.lit(sum(by_cluster.values())).cast("long")}
    )
