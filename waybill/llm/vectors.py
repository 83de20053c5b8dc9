"""Vector columns as matrices, and rows in blocks of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them neither NULL nor NaN nor infinite."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~odd, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def same_width(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """Fails on a vector of another width instead of leaving it out."""
    wrong = F.raise_error(F.concat(F.lit(f"a vector has not {width} components but "), F.size(column)))
    return vectors.withColumn(column, F.when(F.size(column) == width, F.col(column)).otherwise(wrong))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, in that order."""
    if len(scores) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= bound)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]
