"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Memo, per_worker

#: The mark that stands for a space.
MARK = "▁"


#: Cuts at marks, and where letters meet other characters; digits stand alone.
FINE = re.compile(rf"{MARK}*[^\W\d_]+|{MARK}*(?:[^\w{MARK}]|_)+|{MARK}+|[^{MARK}]")
COARSE = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
WHOLE = re.compile(r"(?s).+")


class PieceCodec:
    """Encodes as the library does, segment by segment.

    A border between two characters is safe to cut if no piece has them next to each other,
    as then no merge joins them.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, size = self.library, self.library.get_piece_size()
        bytes_of, self.order, self.ids = {}, {}, {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_of[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.order[piece], self.ids[piece] = -sp.get_score(i), i
        if len(bytes_of) != 256:
            raise ValueError(f"{path} has no byte pieces")
        self.bytes = [bytes_of[b] for b in range(256)]
        pairs = {pair for piece in self.order for pair in map("".join, zip(piece, piece[1:]))}
        crossed = [pair for pair in pairs if len(FINE.findall(pair)) > 1]
        self.crossed = re.compile("|".join(map(re.escape, crossed))) if crossed else None
        self.rough = WHOLE if any(pair[1] == MARK != pair[0] for pair in pairs) else COARSE
        # A line break is no part of a piece, so what follows it is encoded as if alone.
        self.breaks = not any("\n" in piece for piece in self.order)
        self.lead = sp.encode("\n")
        self.segments = Memo(self.found)
        self.unchecked: list[tuple[str, tuple[int, ...]]] = []

    def agenda(self, segment: str) -> tuple[int, ...]:
        """Joins the best-scored, then leftmost, adjacent pair again and again."""
        symbols, order = list(segment), self.order.get
        n = len(symbols)
        heap = []
        for i, joined in enumerate(map("".join, zip(symbols, symbols[1:]))):
            if (rank := order(joined)) is not None:
                heap.append((rank, i, joined, symbols[i]))
        if heap:
            push, pop = heapq.heappush, heapq.heappop
            heapq.heapify(heap)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while heap:
                _, i, joined, left = pop(heap)
                j = after[i]
                if symbols[i] != left or j >= n or left + symbols[j] != joined:
                    continue
                symbols[i], symbols[j] = joined, ""
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    longer = joined + symbols[k]
                    if (rank := order(longer)) is not None:
                        push(heap, (rank, i, longer, joined))
                h = before[i]
                if h >= 0:
                    longer = symbols[h] + joined
                    if (rank := order(longer)) is not None:
                        push(heap, (rank, h, longer, symbols[h]))
        out: list[int] = []
        for symbol in symbols:
            if symbol:
                if (known := self.ids.get(symbol)) is not None:
                    out.append(known)
                else:
                    out.extend(self.bytes[b] for b in symbol.encode())
        return tuple(out)

    def found(self, segment: str) -> tuple[int, ...]:
        ids = self.agenda(segment)
        self.unchecked.append((segment, ids))
        return ids

    def encode(self, text: str) -> list[int]:
        text = self.library.normalize(text)
        rough = self.crossed is not None and self.crossed.search(text)
        segments = (self.rough if rough else FINE).findall(text)
        return list(chain.from_iterable(map(self.segments.__getitem__, segments)))

    def check(self) -> None:
        """Stops the job if the library gives other ids for a segment met since the last check."""
        texts, expected = [], []
        for segment, ids in self.unchecked:
            raw = segment.replace(MARK, " ")
            if self.breaks:
                texts.append("\n" + raw)
                expected.append([*self.lead, *ids])
            elif len(raw) > 1 and raw[0] == " ":
                texts.append(raw[1:])
                expected.append(list(ids))
        self.unchecked = []
        if self.library.encode(texts, num_threads=1) != expected:
            raise ValueError("the library encodes a segment otherwise")

    def compare(self, text: str, ids: list[int]) -> None:
        """Stops the job if the library gives other ids for a whole text."""
        if self.library.encode(text) != ids:
            raise ValueError(f"the library encodes a text of {len(text)} characters otherwise")


def encode_pieces(
    docs: DataFrame, path: str, check_every: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, ids, decoded`` of each row, map-only.

    Ids come from the agenda.  The library checks them in the Arrow batches: every distinct
    segment when a worker first meets it, and every ``check_every``-th text as a whole
    (1: all); a difference fails the job.  ``decoded`` is the library's text for the ids.  A
    NULL or empty text has no ids and decodes to an empty text.  A NULL or repeated id is
    returned as it is; other columns are not read.  Texts are never cut.  An empty table
    gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker(f"codec {path}", lambda: PieceCodec(path))
        for batch in batches:
            for part in _slices(batch):
                encoded, decoded = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = codec.encode(text)
                    if i % check_every == 0:
                        codec.compare(text, ids)
                    encoded.append(ids)
                    decoded.append(codec.library.decode(ids))
                codec.check()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(encoded, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                    ["id", "ids", "decoded"],
                )

    out = rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
