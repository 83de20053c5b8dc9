"""Every registered query on whole small tables, against its SQL or brute force."""

import hashlib
import os

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tests.llm.test_texts import classes, left_over
from tests.test_queries import comparable
from waybill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name].run(spark, FOLDER).collect()))


@pytest.mark.parametrize("name", [name for name, query in QUERIES.items() if query.sql])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = con.execute(QUERIES[name].sql).df()
    assert comparable(QUERIES[name].run(spark, FOLDER).toPandas()) == comparable(expected)


def test_substring_dedup(spark, documents):
    want = left_over([text for _, text in documents], 35)
    want = [(d, n, gone, sha256(kept)) for (d, _), (n, gone, kept) in zip(documents, want)]
    assert rows(spark, "op2_substring_dedup") == sorted(want)


def test_nearest_neighbours(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], dtype=float)
    found = {}
    for query, rank, vec_id, score in rows(spark, "op3_nearest_neighbours"):
        found.setdefault(query, {})[vec_id] = score
    asked = ids[ids % 20 == 0]
    assert sorted(found) == sorted(asked)
    hits = total = 0
    for query in asked:
        scores = x @ x[ids == query][0]
        scores[ids == query] = -np.inf
        best = ids[np.argsort(-scores)[: min(20, len(ids) - 1)]]
        hits += len(set(best) & found[query].keys())
        total += len(best)
    assert hits / total >= 0.9


def test_token_counts_and_pieces(spark, documents):
    bpe = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = [(d, len(t.encode()), len(bpe.encode(t, add_special_tokens=False).ids)) for d, t in documents]
    assert rows(spark, "op8_token_counts") == sorted((d, b, n, n > 512) for d, b, n in counts)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for d, text in documents:
        ids = library.encode(text)
        want.append((d, len(ids), sha256(",".join(map(str, ids))), sha256(library.decode(ids))))
    assert rows(spark, "op5_sentencepiece") == sorted(want)


def test_packing_covers_every_token(spark, documents):
    bpe = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(bpe.encode(text, add_special_tokens=False).ids) + 1 for _, text in documents)
    packed = QUERIES["op4_best_fit_packing"].run(spark, FOLDER).collect()
    assert sum(r["length"] for r in packed) == total
    assert len({r["sequence_id"] for r in packed}) <= -(-total // 1024) * 1.05 + 1


def test_jaccard_join(spark, documents):
    assert rows(spark, "op10_jaccard_join") == sorted(classes(documents, 5, 80))
