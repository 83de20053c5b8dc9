"""Words of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

from waybill.llm.common import Memo, per_worker

#: Texts that are hashed together.
CHUNK_ROWS = 500


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: as bytes, as hashes, and each text's place."""

    def __init__(self, texts: Sequence[bytes]):
        # split() without arguments cuts bytes at exactly those six characters.
        self.of = [text.split() for text in texts]
        self.sizes = np.fromiter(map(len, self.of), np.int64, len(self.of))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        memo = per_worker("word hashes", lambda: Memo(xxhash.xxh3_64_intdigest, 100_000))
        self.hashes = np.fromiter(
            map(memo.__getitem__, chain.from_iterable(self.of)), np.uint64, int(self.sizes.sum())
        )


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, whatever text they belong to."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    factors = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    count = len(hashes) - n + 1
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total += hashes[i : i + count] * factors[i]
    return mixed(total)


def text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in chunks, each with its texts as bytes."""
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(start, CHUNK_ROWS)
            yield part, part.column("text").cast(pa.binary()).to_pylist()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, of a partition sorted by them; one run in memory."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = np.zeros(batch.num_rows - 1, dtype=bool)
        for key in keys:
            column = batch.column(key)
            differs = pa.compute.not_equal(column[1:], column[:-1])
            changes |= differs.to_numpy(zero_copy_only=False).astype(bool)
        borders = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for a, b in zip(borders, borders[1:]):
            key = tuple(batch.column(k)[a].as_py() for k in keys)
            if key != last and waiting:
                yield pa.Table.from_batches(waiting)
                waiting = []
            last = key
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield pa.Table.from_batches(waiting)
