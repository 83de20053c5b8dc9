"""Token counts of byte-level BPE by heap and linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import SPACE, Memo, per_worker

#: White-space runs but for their last character, and words with a space before them: no
#: token crosses a border of these chunks, as the pattern below cuts there too.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The split pattern of the byte-level vocabulary.
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """The file's content, if it is of the kind that this module reproduces."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and spec["normalizer"] is None
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not model.get("ignore_merges")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
    return spec


class TokenCounter:
    """Counts tokens of texts.  Symbols are vocabulary ids in a doubly linked list."""

    def __init__(self, path: str):
        spec = load_vocabulary(path)
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for c in byte_letters()]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.words = Memo(self.word)
        self.chunks = Memo(self.chunk)

    def word(self, word: str) -> int:
        """Initial symbols minus merges: pop the lowest-rank, then leftmost, pair again and again."""
        ids = [self.first[b] for b in word.encode()]
        n = left = len(ids)
        rank_of, push, pop = self.merges.get, heapq.heappush, heapq.heappop
        heap = []
        for i in range(n - 1):
            if found := rank_of(ids[i] << 32 | ids[i + 1]):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, a, b, merged = pop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := rank_of(merged << 32 | ids[k]):
                    push(heap, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := rank_of(ids[h] << 32 | merged)):
                push(heap, (found[0], h, ids[h], merged, found[1]))
        return left

    def chunk(self, chunk: str) -> int:
        return sum(map(self.words.__getitem__, WORD.findall(chunk)))

    def plain(self, text: str) -> int:
        return sum(map(self.chunks.__getitem__, CHUNK.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a text; each added token's string inside it counts as one."""
        if self.added is None or not (marks := len(self.added.findall(text))):
            return self.plain(text)
        return marks + sum(map(self.plain, self.added.split(text)))


def count_tokens(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of each row, map-only.

    A NULL text counts as empty: 0 bytes, 0 tokens.  Rows are neither joined nor merged, so
    a NULL or repeated id is returned as it is; other columns, whatever their names, are not
    read.  Texts are never cut; a text's cost grows with its length only (times the logarithm
    of its longest word).  An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(f"counter {path}", lambda: TokenCounter(path))
        for batch in batches:
            texts = batch.column("text")
            counts = [counter.count(text.as_py()) for text in texts]
            sizes = [len(text.as_buffer()) if text.as_buffer() else 0 for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
