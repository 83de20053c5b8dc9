"""Token counts, piece encoding and packing against the libraries themselves."""

import time
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from waybill.llm.packing import best_fit, pack_documents, plan_runs, reduce_by_dominance
from waybill.llm.pieces import PieceCodec, encode_pieces
from waybill.llm.token_counts import TokenCounter, count_tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab  \n\t▁eé²._-,1234'\"中ИЖ😀́ﬁ\x00\x1c\x85\xa0  tion the 's<|endoftext|>"


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(BPE)


def odd_texts(n: int) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 25))) for _ in range(n)]


def test_counts_equal_the_library(spark, messy, messy_rows, tokenizer):
    got = sorted(map(tuple, count_tokens(messy, BPE, limit=512).collect()), key=str)
    expected = []
    for doc_id, text in messy_rows:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        expected.append((doc_id, len(text.encode()), n, n > 512))
    assert got == sorted(expected, key=str)


def test_counts_of_odd_texts(tokenizer):
    counter = TokenCounter(BPE)
    for text in odd_texts(3000):
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        TokenCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_equal_the_library(spark, messy, messy_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = [(r["doc_id"], r["ids"], r["decoded"]) for r in encode_pieces(messy, PIECES, check_every=1).collect()]
    expected = [(i, ids := library.encode(text), library.decode(ids)) for i, text in messy_rows]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_pieces_of_odd_texts():
    codec = PieceCodec(PIECES)
    for text in odd_texts(5000):
        codec.compare(text, codec.encode(text))
    codec.check()


def test_a_difference_from_the_library_is_an_error():
    codec = PieceCodec(PIECES)
    codec.unchecked.append(("▁word", (5, 6)))
    with pytest.raises(ValueError):
        codec.check()
    with pytest.raises(ValueError):
        codec.compare("word", [5])


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing(spark, messy, messy_rows, tokenizer, capacity):
    rows = pack_documents(messy, BPE, capacity=capacity).collect()
    documents = Counter()
    for doc_id, text in messy_rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
            documents[(doc_id, piece, a, b - a, crc)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == documents
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(sequences) <= least * 1.1 + 1


def optimum(sizes: list[int], capacity: int) -> int:
    """Fewest bins, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i: int, rooms: list[int]) -> None:
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            rooms[k] -= sizes[i]
            place(i + 1, rooms)
            rooms[k] += sizes[i]
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(11)
    for _ in range(1500):
        capacity = rng.randint(8, 40)
        least = rng.randint(1, capacity // 3)
        sizes = [rng.randint(least, capacity) for _ in range(rng.randint(1, 9))]
        rest = Counter(sizes)
        fixed = reduce_by_dominance(rest, capacity)
        bins = sum(n for _, n in fixed)
        assert all(sum(items) <= capacity for items, _ in fixed)
        assert sorted([*rest.elements(), *(i for items, n in fixed for i in items * n)]) == sorted(sizes)
        assert bins + optimum(list(rest.elements()), capacity) == optimum(sizes, capacity)


def test_best_fit_places_every_item():
    rng = random.Random(2)
    sizes = Counter(rng.randint(1, 100) for _ in range(5000))
    groups = best_fit(sizes, 100)
    assert Counter(i for items, n in groups for i in items * n) == sizes
    assert all(sum(items) <= 100 for items, _ in groups)
    assert sum(n for _, n in groups) <= -(-sum(sizes.elements()) // 100) * 1.02


def test_runs_cover_all_ranks():
    sizes = {700: 10, 324: 12, 300: 5, 1: 1000}
    runs = plan_runs(dict(sizes), 1024)
    assert all(runs[s][0][0] == 0 and [r[0] for r in runs[s]] == sorted(r[0] for r in runs[s]) for s in sizes)


def test_empty_table(spark, messy):
    none = messy.filter("false")
    assert count_tokens(none, BPE, limit=1).count() == 0
    assert encode_pieces(none, PIECES).count() == 0
    assert pack_documents(none, BPE).count() == 0
    assert count_tokens(messy, BPE, limit=1).filter(F.col("n_bytes").isNull()).count() == 0


def test_packing_takes_very_long_runs(spark):
    texts = [" " * 2_000_000, "a" + "\n" * 2_000_000, "\t" * 2_000_000 + "b", " \n" * 1_000_000, (" " * 9_999 + "x") * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    start = time.perf_counter()
    rows = pack_documents(docs, path, capacity=1024, end_id=2).collect()
    assert time.perf_counter() - start < 120
    for doc_id, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        pieces = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc_id)
        assert sum(length for _, _, length, _ in pieces) == len(ids)
        for _, first, length, crc in pieces:
            assert zlib.crc32(np.array(ids[first : first + length], dtype="<u4").tobytes()) == crc
