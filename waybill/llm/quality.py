"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from waybill.llm.common import carried, schema_with, texts_of

#: Statistics of a text, in the order in which ``statistics`` gives them.
STATISTICS = (
    "words", "word_length", "longest_word", "upper", "digits", "marks", "symbols", "exclaims", "pipes",
    "controls", "other", "distinct", "commonest", "short", "lines", "distinct_lines", "commonest_line",
    "shouted", "marked", "stopped", "entropy", "repeats",
)
#: Rows whose cosines are in memory at once.
ROWS = 1000
_KIND = np.zeros(256, dtype=np.int64)
_KIND[[*range(97, 123)]] = 1
_KIND[[*range(65, 91)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 4
_KIND[[ord(c) for c in "#$%&*@^~_=+<>{}[]\\/`"]] = 5
_KIND[ord("!")] = 6
_KIND[ord("|")] = 7
_KIND[[*range(0, 9), *range(14, 32), 127]] = 8
_KIND[[*range(128, 256)]] = 9
_MARKS = tuple(bytes([b]) for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?'\")")


def statistics(text: str) -> list[float]:
    """The statistics of a whole text; an empty one has zeros."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(data)
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, codes, 10) / size
    share = codes[codes > 0] / size
    counts = Counter(words)
    lines = Counter(line for line in data.split(b"\n") if line)
    lengths = np.fromiter(map(len, words), np.int64, n)
    n_lines = lines.total()
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    return [
        math.log1p(n),
        float(lengths.mean()),
        math.log1p(int(lengths.max())),
        *kinds[[2, 3, 4, 5, 6, 7, 8, 9]].tolist(),
        len(counts) / n,
        max(counts.values()) / n,
        float((lengths <= 3).mean()),
        math.log1p(n / n_lines),
        len(lines) / n_lines,
        max(lines.values()) / n_lines,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        sum(c for w, c in counts.items() if w.endswith(_MARKS)) / n,
        sum(c for w, c in counts.items() if w.endswith((b".", b","))) / n,
        float(-(share * np.log(share)).sum()),
        1.0 - pairs,
    ]


class Kernel(NamedTuple):
    """Standardised statistics, turned by random frequencies into cosines."""

    mean: np.ndarray
    spread: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.cos(z @ self.frequencies + self.phases) * math.sqrt(2 / len(self.phases))
        return np.column_stack([np.ones(len(x)), waves])


class Scorer(NamedTuple):
    kernel: Kernel
    weights: np.ndarray
    #: Calibration: raw scores, ascending, and the scores they stand for.
    raw: np.ndarray
    calibrated: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.kernel.cosines(x) @ self.weights, self.raw, self.calibrated), 0, 1)


def with_statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``x``, the statistics of each row's whole text; map-only.

    NULL and empty texts have zeros.  Rows stay apart, so NULL and repeated ids do no harm;
    of other columns only ``keep`` is read.
    """
    rows, names, text_name = carried(docs, keep, text_col, once=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(text) for text in texts_of(batch.column(text_name))]
            found = pa.array(x, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), found], [*names, "x"])

    found = rows.mapInArrow(run, schema_with(rows, names, "x array<double>"))
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "x")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows, so that few cosines are in memory at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def learn_quality(
    rows: DataFrame, labelled: DataFrame, cosines: int = 256, width: float = 1.0, ridge: float = 1e-3, seed: int = 7
) -> Scorer | None:
    """Fits the scorer: ``rows`` with ``x`` set the scale, ``labelled`` with ``x, label`` the weights.

    Every labelled row with label 0 or 1 counts: partitions sum their normal equations, which
    are then added by row of the matrix, and the calibration adds counts per thousandth of
    the raw score.  Only those sums, of fixed size, reach the driver.  Labels that are NULL or
    neither 0 nor 1 are left out, repeated rows count each time; None if no row has a label or
    there are no rows.  Other columns are not read.
    """
    d = len(STATISTICS)
    scale = rows.select(
        *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)),
        *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)),
    ).first()
    if scale["m0"] is None:
        return None
    mean = np.array([scale[f"m{i}"] for i in range(d)])
    spread = np.array([max(scale[f"s{i}"], 1e-6) for i in range(d)])
    random = np.random.default_rng(seed)
    kernel = Kernel(
        mean,
        spread,
        random.normal(size=(d, cosines)) * math.sqrt(2 / d) / width,
        random.uniform(0, 2 * math.pi, cosines),
    )
    used = labelled.filter(F.col("label").isin(0, 1)).select("x", F.col("label").cast("double").alias("label"))
    side = cosines + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((side, side + 1)), 0
        for batch in _slices(batches):
            z = kernel.cosines(_matrix(batch.column("x")))
            total += z.T @ np.column_stack([z, batch.column("label").to_numpy()])
            n += len(z)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(side), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "sums"]
            )

    def added(table: pa.Table) -> pa.Table:
        total = np.stack(table.column("sums").to_pylist()).sum(axis=0)
        return pa.table({"i": table.column("i")[:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    parts = used.mapInArrow(sums, "i int, sums array<double>")
    found = parts.groupBy("i").applyInArrow(added, "i int, sums array<double>").orderBy("i").collect()
    if not found:
        return None
    normal = np.array([row["sums"] for row in found])
    weights = np.linalg.solve(normal[:, :-1] + ridge * normal[0, 0] * np.eye(side), normal[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            score = kernel.cosines(_matrix(batch.column("x"))) @ weights
            bins = np.clip(np.floor(score * 1000), -500, 1500).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    bins = (
        used.mapInArrow(raw, "bin int, label double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("good"))
        .orderBy("bin")
        .collect()
    )
    steps = isotonic([(row["bin"] / 1000, row["n"], row["good"]) for row in bins])
    return Scorer(kernel, weights, *map(np.array, zip(*steps)))


def isotonic(points: Sequence[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """Pool adjacent violators: ``(position, weight, sum)`` ascending to steps' ends and means."""
    blocks: list[list[float]] = []
    for at, n, total in points:
        blocks.append([at, at, n, total])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, end, n, total = blocks.pop()
            blocks[-1][1:] = [end, blocks[-1][2] + n, blocks[-1][3] + total]
    return [(at, total / n) for start, end, n, total in blocks for at in dict.fromkeys((start, end))]


def add_quality(
    rows: DataFrame, scorer: Scorer | None, keep: Sequence[str] = ("doc_id",), like: StructType | None = None
) -> DataFrame:
    """The columns ``keep`` of ``rows``, then ``score, predicted``; without a scorer, 0.5 and 1.
    ``like`` has those columns as they were before they were stored, when all became nullable."""
    names = [f"k{i}" for i in range(len(keep))]
    given = rows.select(*(F.col(f"`{c}`").alias(n) for n, c in zip(names, keep)), "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            score = scorer.score(x) if scorer else np.full(len(x), 0.5)
            predicted = pa.array((score >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(score), predicted], [*names, "score", "predicted"]
            )

    fields = [like[c] if like else rows.schema[c] for c in keep]
    kept = StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(names, fields)])
    scored = given.mapInArrow(run, StructType([*kept, *StructType.fromDDL("score double, predicted int")]))
    return scored.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "score", "predicted")
