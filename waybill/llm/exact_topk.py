"""Exact top-k inner products with bounds from segment statistics, coarse to fine.

Of two vectors cut into the same segments, a squared distance is at least the sum over
segments of length * ((difference of means)^2 + (difference of deviations)^2).  With
x.y = (|x|^2 + |y|^2 - |x - y|^2) / 2 that bounds the inner product from above.  Finer segments
bound more closely, so each level looks only at what the coarser one left over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.vectors import best, same_width, usable

#: Numbers of segments, coarse to fine.
LEVELS = (1, 4, 16, 32)
#: Squared lengths from which products of two vectors might not fit 64 bits.
TOO_LONG = 2.0**62
#: Queries whose bounds are in memory at once.
PARTY = 128
#: What a pass over blocks gives: the k-th best score of a query, or its k best rows.
FLOOR, BEST = "mark long, id {0}, score long", "query_id {0}, id {0}, score long"


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """For each row, mean and deviation of each segment, times the root of the segment's
    length: the squared distance of two such rows is the lower bound."""
    borders = np.linspace(0, x.shape[1], segments + 1).astype(int)
    parts = [
        np.stack([x[:, a:b].mean(axis=1), x[:, a:b].std(axis=1)], axis=1) * np.sqrt(b - a)
        for a, b in zip(borders, borders[1:])
        if b > a
    ]
    return np.concatenate(parts, axis=1)


class Block:
    """Vectors of one block with their statistics."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.whole = x.astype(np.int64)
        self.norms = (x**2).sum(axis=1)
        self.levels = [segment_statistics(x, n) for n in LEVELS if n <= x.shape[1]]

    def survivors(self, owners: np.ndarray, y: np.ndarray, floors: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """After each level, which rows (columns of the matrix) may be among the k best of each
        query; a query's own rows never are.  Floors are scores that k candidates reach."""
        norms = (y**2).sum(axis=1)
        # A unit, and a share of the lengths far above rounding, of slack.
        slack = 1 + 1e-10 * (norms[:, None] + self.norms)
        alive = self.ids != owners[:, None]
        floors = floors.copy()
        for table in self.levels:
            own = segment_statistics(y, table.shape[1] // 2)
            gaps = (own**2).sum(axis=1)[:, None] + (table**2).sum(axis=1) - 2 * own @ table.T
            bounds = np.where(alive, (norms[:, None] + self.norms - gaps) / 2, -np.inf)
            if len(self.ids) > k:
                # Exact scores of the most promising raise the floor under the k-th best.
                ahead = np.argpartition(-bounds, min(4 * k, len(self.ids)) - 1)[:, : 4 * k]
                scores = np.einsum("qrd,qd->qr", self.x[ahead], y)
                scores = np.where(np.take_along_axis(alive, ahead, axis=1), scores, -np.inf)
                floors = np.maximum(floors, -np.partition(-scores, k - 1, axis=1)[:, k - 1])
            alive = alive & (bounds >= floors[:, None] - slack)
            yield alive

    def top(
        self, owners: np.ndarray, y: np.ndarray, floors: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of the query, ids and exact scores of its k best that reach its floor."""
        for start in range(0, len(y), PARTY):
            part = slice(start, start + PARTY)
            for alive in self.survivors(owners[part], y[part], floors[part], k):
                pass
            for i, row in enumerate(alive, start):
                left = np.flatnonzero(row)
                scores = self.whole[left] @ y[i].astype(np.int64)
                at = best(self.ids[left], scores, k)
                yield i, self.ids[left][at], scores[at]


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    block_rows: int = 4096,
    query_rows: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score``: each query's k highest integer inner products.

    Vectors are integers (any numeric type); one whose squared length is 2^62 or more fails the
    job, as products might not fit 64 bits.  Ties go to the smaller id; a query's own id is no
    candidate; with fewer candidates all are returned.  Vectors that are NULL or empty or hold
    NULL or non-finite components take no part, nor do NULL ids; widths that differ fail the
    job.  The k-th best score of one block is each query's floor in all others.  Each pair of a
    block of vectors and a block of queries is one group of bounded size, whatever its rows
    hold, so repeated vectors need no care; rows with one id all count.  Other columns are not
    read.  Empty tables give an empty result.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        return rows.filter(F.col("id").isNotNull() & usable(F.col("v")))

    data, asked = prepared(vectors), prepared(queries)
    sizes = data.agg(F.count("*").alias("n"), F.first(F.size("v")).alias("width")).first()
    n_queries = asked.count()
    if not sizes["n"] or not n_queries:
        return data.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score")
        ).filter("false").withColumnRenamed("id", id_col)
    data, asked = (_products_fit(same_width(df, "v", sizes["width"])) for df in (data, asked))
    blocks = -(-sizes["n"] // block_rows)
    parties = -(-n_queries // query_rows)

    def spread(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Each row in one of n blocks, once for each of the m blocks of the other side."""
        rows = df.withColumn(own, F.pmod(F.xxhash64("id", "v"), F.lit(n)))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))))

    left = spread(data, "block", blocks, "party", parties)
    id_type = data.schema["id"].dataType.simpleString()

    def searched(block_count: int, floors: Column, theirs: DataFrame, ours: DataFrame, found: str) -> DataFrame:
        """Every query against the first blocks: its best rows, or the floor they give."""
        right = spread(ours.withColumn("floor", floors), "party", parties, "block", block_count)

        def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple] = []
            if len(rows) and len(queries):
                block = Block(rows["id"].to_numpy(), np.stack(rows["v"].to_list()))
                owners, mark = queries["id"].to_numpy(), queries["mark"].to_numpy()
                floor = queries["floor"].astype(float).fillna(-np.inf).to_numpy()
                for i, ids, scores in block.top(owners, np.stack(queries["v"].to_list()), floor, k):
                    if found == FLOOR:
                        out += [(mark[i], owners[i], scores[-1])] if len(ids) == k else []
                    else:
                        out += [(owners[i], *pair) for pair in zip(ids, scores)]
            return pd.DataFrame(out, columns=[field.split()[0] for field in found.split(", ")])

        groups = theirs.groupBy("block", "party").cogroup(right.groupBy("block", "party"))
        return groups.applyInPandas(search, found.format(id_type))

    # The mark tells queries that share an id apart; equal ones have equal floors.
    asked = asked.withColumn("mark", F.xxhash64("v"))
    floors = searched(1, F.lit(None).cast("long"), left.filter("block = 0"), asked, FLOOR)
    floors = floors.groupBy("id", "mark").agg(F.min("score").alias("floor"))
    near = searched(blocks, F.col("floor"), left, asked.join(floors, ["id", "mark"], "left"), BEST)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _products_fit(vectors: DataFrame) -> DataFrame:
    """Fails on a vector whose products with others might not fit 64 bits."""
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    wrong = F.raise_error(F.lit("the components of a vector are too large for products of 64 bits"))
    return vectors.withColumn("v", F.when(length < TOO_LONG, F.col("v")).otherwise(wrong))


def scaled(vector: Column, factor: int = 256) -> Column:
    """Components as ``floor(factor * x)``; NULL and non-finite ones make the vector NULL."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))
    return F.when(usable(vector), whole)
