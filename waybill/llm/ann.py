"""Approximate inner-product search: inverted lists and an adaptive scan of dimensions.

Vectors get one more component that makes all of them equally long, so that the largest inner
product is the smallest distance.  Rotated at random, any few components estimate a distance
of which the rest is like it; so a list is scanned in blocks of columns, and a candidate is
abandoned as soon as a test on its partial distance says that it is too far.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import stored
from waybill.llm.vectors import best, matrix, same_width, usable


class Index(NamedTuple):
    """What a bounded sample teaches: list centres, rotation and the sample itself."""

    longest: float
    centres: np.ndarray
    rotation: np.ndarray
    sample_rows: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def distances(self, lengthened: np.ndarray) -> np.ndarray:
        """Squared distances to the centres, but for a term that all centres share."""
        return (self.centres**2).sum(axis=1) - 2 * lengthened @ self.centres.T


def fit_index(rows: np.ndarray, ids: np.ndarray, x: np.ndarray, longest: float, lists: int, seed: int, rounds: int = 12) -> Index:
    """k-means on the lengthened sample and a random rotation."""
    random = np.random.default_rng(seed)
    width = x.shape[1] + 1
    rotation, _ = np.linalg.qr(random.normal(size=(width, width)))
    index = Index(longest, np.zeros((1, width)), rotation, rows, ids, x)
    points = index.lengthened(x)
    centres = points[random.permutation(len(points))[:lists]]
    for _ in range(rounds):
        near = index._replace(centres=centres).distances(points).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return index._replace(centres=centres)


class Columns:
    """One list's vectors, rotated, in blocks of columns.  ``rows`` tells the vectors apart."""

    def __init__(self, index: Index, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, step: int):
        self.index, self.rows, self.ids, self.x, self.step = index, rows, ids, x, step
        self.columns = np.ascontiguousarray((index.lengthened(x) @ index.rotation).T)

    def search(
        self, own: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, confidence: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For some queries at once: number of the query, position here and inner product of the
        k best that no test abandons.  ``own`` is each query's own row, ``floor`` an inner
        product that its k best reach.

        A block of columns adds to the partial distances of all queries by one matrix product
        over the candidates that some query still has; the tests look at the whole matrix.
        """
        width = len(self.columns)
        turned = np.column_stack([q, np.zeros(len(q))]) @ self.index.rotation
        # |x' - q'|^2 = longest^2 + |q|^2 - 2 x.q
        level = self.index.longest**2 + (q**2).sum(axis=1)

        def limit_of(score: np.ndarray) -> np.ndarray:
            reached = np.maximum(level - 2 * score, 0.0) * (1 + 1e-9) + 1e-12 + 1e-9 * level
            return np.where(np.isfinite(score), reached, np.inf)

        limit = limit_of(floor)
        cols = np.arange(len(self.rows))
        alive = self.rows[None, :] != own[:, None]
        partial = np.zeros(alive.shape)
        for start in range(0, width, self.step):
            seen = min(start + self.step, width)
            block, part = self.columns[start:seen, cols], turned[:, start:seen]
            partial += (block**2).sum(axis=0)[None, :] + (part**2).sum(axis=1)[:, None] - 2 * part @ block
            if start == 0 and len(cols) > 4 * k + 1:
                # Exact scores of the most promising bring the limit down.
                ahead = np.argpartition(np.where(alive, partial, np.inf), 4 * k, axis=1)[:, : 4 * k]
                scores = np.einsum("ijk,ik->ij", self.x[cols[ahead]], q)
                scores = np.where(np.take_along_axis(alive, ahead, axis=1), scores, -np.inf)
                limit = np.minimum(limit, limit_of(np.partition(scores, -k, axis=1)[:, -k]))
            if seen == width:
                alive &= partial <= limit[:, None]
            else:
                bound = limit * (1 + confidence / np.sqrt(seen)) ** 2 * (seen / width)
                alive &= partial <= bound[:, None]
            left = alive.any(axis=0)
            if not left.all():
                cols, alive, partial = cols[left], alive[:, left], partial[:, left]
        asked, at = np.nonzero(alive)
        scores = (self.x[cols[at]] * q[asked]).sum(axis=1)
        out = []
        borders = np.searchsorted(asked, np.arange(len(q) + 1))
        for i, (first, last) in enumerate(zip(borders, borders[1:])):
            top = best(self.ids[cols[at[first:last]]], scores[first:last], k)
            out.append((np.full(len(top), i), cols[at[first:last]][top], scores[first:last][top]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(map(np.concatenate, zip(*out)))


#: Queries that search together.
TOGETHER = 64


def search_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    sample_rows: int = 2048,
    rows_per_list: int = 2048,
    probe_share: float = 0.8,
    first_share: float = 0.1,
    block_rows: int = 4096,
    step: int = 16,
    confidence: float = 2.1,
    seed: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score``: for each query the k nearest found, exact scores.

    The index is fitted on ``sample_rows`` vectors, chosen by a hash of their id; every vector
    is put in a list.  There is a list per ``rows_per_list`` rows, at most one per eight sample
    rows; a query probes ``probe_share`` of them.  The default suits vectors without clusters,
    where near vectors lie in many lists.  The nearest ``first_share`` of the probed lists are
    scanned first: the k-th best found there is the limit from which the others start.
    ``confidence`` is how many deviations a partial distance may lie above the limit.  A list of
    more than ``block_rows`` is split, so that a group is bounded whatever the rows are.

    Scores are inner products in double precision; ties go to the smaller id; a query's own row,
    one with its id and vector, is no candidate.  Rows that share an id all count, as queries
    and as candidates.  Vectors that are NULL, empty, zero or hold NULL or non-finite components
    take no part, nor do NULL ids; widths that differ fail the job.  Other columns are not read;
    empty tables give an empty result.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
        return rows.filter(F.exists("v", lambda x: x != 0))

    data, asked = prepared(vectors), prepared(queries)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = data.agg(F.count("*").alias("n"), F.first(F.size("v")).alias("width"), F.max(norm).alias("longest")).first()
    id_type = data.schema["id"].dataType.simpleString()
    if not facts["n"]:
        empty = data.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_col))
        return empty.withColumn("score", F.lit(0.0)).filter("false")
    data, asked = (same_width(df, "v", facts["width"]) for df in (data, asked))
    # Rows get a number where they are written, so that it never changes.
    data = stored(data.withColumn("row", F.monotonically_increasing_id()), "vectors")
    numbers = data.groupBy("id", "v").agg(F.min("row").alias("own"))
    asked = asked.withColumn("query", F.monotonically_increasing_id()).join(numbers, ["id", "v"], "left")
    asked = stored(asked.withColumn("own", F.coalesce("own", F.lit(-1))), "queries")
    sample = data.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).toPandas()
    lists = max(1, min(-(-facts["n"] // rows_per_list), len(sample) // 8))
    index = fit_index(sample["row"].to_numpy(), sample["id"].to_numpy(), np.stack(sample["v"].to_list()), facts["longest"], lists, seed)
    probes = max(1, round(probe_share * lists))
    first = max(1, round(first_share * probes))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = index.distances(index.lengthened(matrix(batch.column("v")))).argmin(axis=1)
                yield batch.append_column("list", pa.array(near.astype(np.int32)))

    assigned = stored(data.mapInArrow(assign, f"id {id_type}, v array<double>, row long, list int"), "lists")
    # One row per list; lists grow with the root of the table and stay below sample_rows / 8.
    sizes = {row["list"]: row["count"] for row in assigned.groupBy("list").count().collect()}
    pieces = np.array([-(-sizes.get(i, 0) // block_rows) for i in range(lists)], dtype=np.int32)
    split = F.array(*map(F.lit, np.maximum(pieces, 1).tolist()))
    parts = assigned.withColumn("piece", F.pmod(F.xxhash64("id", "v"), split[F.col("list")]).cast("int"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                few = batch.slice(start, 256)
                q, own = matrix(few.column("v")), few.column("own").to_numpy()
                # The k-th best inner product within the sample: the k best reach it too.
                scores = np.where(index.sample_rows[None, :] == own[:, None], -np.inf, q @ index.sample.T)
                floor = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), -np.inf)
                far = (index.centres**2).sum(axis=1) - 2 * np.column_stack([q, np.zeros(len(q))]) @ index.centres.T
                probed = np.argsort(far, axis=1, kind="stable")[:, :probes]
                counts = pieces[probed]
                owner = np.repeat(np.arange(len(q)), counts.sum(axis=1))
                chosen = np.repeat(probed.ravel(), counts.ravel())
                start_of = np.repeat(np.cumsum(counts.ravel()) - counts.ravel(), counts.ravel())
                early = np.repeat(np.tile(np.arange(probes) < first, len(q)), counts.ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(few.column(name).take(pa.array(owner)) for name in ("query", "own", "v")),
                        pa.array(floor[owner]),
                        pa.array(chosen.astype(np.int32)),
                        pa.array((np.arange(len(chosen)) - start_of).astype(np.int32)),
                        pa.array(early),
                    ],
                    ["query", "own", "v", "floor", "list", "piece", "early"],
                )

    def searched(columns: Columns, query: np.ndarray, own: np.ndarray, q: np.ndarray, floor: np.ndarray) -> pd.DataFrame:
        parts = []
        for start in range(0, len(q), TOGETHER):
            few = slice(start, start + TOGETHER)
            who, at, scores = columns.search(own[few], q[few], floor[few], k, confidence)
            parts.append(pd.DataFrame({"query": query[few][who], "row": columns.rows[at], "id": columns.ids[at], "score": scores}))
        return pd.concat(parts)

    def seed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = Columns(index, index.sample_rows, index.sample_ids, index.sample, step)
        for batch in batches:
            if len(batch):
                none = np.full(len(batch), -np.inf)
                q = np.stack(batch["v"].to_list())
                yield searched(columns, batch["query"].to_numpy(), batch["own"].to_numpy(), q, none)

    pairs = f"query long, row long, id {id_type}, score double"
    seeds = asked.mapInPandas(seed_rows, pairs)
    routing = "query long, own long, v array<double>, floor double, list int, piece int, early boolean"
    routed = asked.mapInArrow(route, routing)

    def scan(theirs: pd.DataFrame, ours: pd.DataFrame) -> pd.DataFrame:
        if not len(theirs) or not len(ours):
            return pd.DataFrame({"query": [], "row": [], "id": theirs["id"][:0], "score": []}).astype({"query": int, "row": int, "score": float})
        columns = Columns(index, theirs["row"].to_numpy(), theirs["id"].to_numpy(), np.stack(theirs["v"].to_list()), step)
        q = np.stack(ours["v"].to_list())
        return searched(columns, ours["query"].to_numpy(), ours["own"].to_numpy(), q, ours["floor"].to_numpy())

    def scanned(probing: DataFrame) -> DataFrame:
        theirs, ours = parts.groupBy("list", "piece"), probing.groupBy("list", "piece")
        return theirs.cogroup(ours).applyInPandas(scan, pairs)

    # A query whose best sample rows lie in lists that it does not probe still has k rows.
    early = stored(scanned(routed.filter("early").drop("early")).unionByName(seeds), "early")
    early = early.groupBy("query", "row").agg(F.max("score").alias("score"), F.first("id").alias("id"))
    nearest_first = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    early = early.withColumn("place", F.row_number().over(nearest_first)).filter(F.col("place") <= k)
    kth = early.filter(F.col("place") == k).select("query", F.col("score").alias("kth"))
    late = routed.filter("NOT early").join(kth, "query", "left")
    late = late.select("query", "own", "v", F.greatest("floor", "kth").alias("floor"), "list", "piece")
    found = early.drop("place").unionByName(scanned(late))
    found = found.groupBy("query", "row").agg(F.max("score").alias("score"), F.first("id").alias("id"))
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)
    names = asked.select("query", F.col("id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", F.col("id").alias(id_col), "score")
