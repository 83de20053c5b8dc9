"""The stages of the pipeline, each on its predecessor's rows."""

import os
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.test_texts import classes, left_over
from tokenizers import Tokenizer

import corpus_pipeline
from waybill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def by_name(name: str):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_order_of_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality classifier", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


@pytest.mark.parametrize("name", ["toxicity", "quality classifier"])
def test_filters_keep_whole_rows(spark, docs, name):
    odd = docs.selectExpr("*", "1 AS score", "2 AS predicted", "3 AS row", "4 AS `a b`")
    got = by_name(name)(spark, odd, FOLDER)
    assert got.schema == odd.schema
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in odd.collect()}
    assert got.count() > 0.6 * odd.count()


def test_near_duplicates(spark, docs):
    got = by_name("n-gram Jaccard join")(spark, docs, FOLDER)
    assert got.columns == docs.columns
    want = {c for _, n, c in classes(rows_of(docs), 5, 80) if n} | {d for d, t in rows_of(docs) if not t.split()}
    assert sorted(d for d, _ in rows_of(got)) == sorted(want)


def test_repeated_passages(spark, docs):
    got = by_name("substring dedup")(spark, docs, FOLDER)
    assert got.schema == docs.schema
    given = rows_of(docs)
    want = {d: kept for (d, _), (_, _, kept) in zip(given, left_over([t for _, t in given], 35))}
    assert dict(rows_of(got)) == want
    assert got.filter("n_chars != length(text)").count() == 0


def test_whole_pipeline(spark):
    rows = QUERIES["pipeline"].run(spark, FOLDER).collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        ends = [0]
        for offset, length in sorted(found):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024


def what_stays(spark, name, docs, labels, folder):
    """Rows that a stage must make of ``docs``: by its query's predictions on them, or by brute force."""
    given = [r.asDict() for r in docs.collect()]
    texts = [(r["doc_id"], r["text"]) for r in given]
    if name in ("toxicity", "quality classifier"):
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        query, stays = {"toxicity": ("op7_toxicity", 0), "quality classifier": ("op9_quality", 1)}[name]
        predicted = {r["doc_id"]: r["predicted"] for r in QUERIES[query].run(spark, folder).collect()}
        assert len(predicted) == len(given)
        return [r for r in given if predicted[r["doc_id"]] == stays]
    if name == "n-gram Jaccard join":
        first = {d: c for d, n, c in classes(texts, 5, 80) if n}
        return [r for r in given if first.get(r["doc_id"], r["doc_id"]) == r["doc_id"]]
    rest = [kept for _, _, kept in left_over([t for _, t in texts], 35)]
    return [r | {"text": kept, "n_chars": len(kept)} for r, kept in zip(given, rest)]


def pieces_of(rows, capacity=1024, end_id=2):
    """``doc_id, piece, start, length, ids_crc32`` of all rows, by the tokenizers library."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = Counter()
    for r in rows:
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, end_id]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            found[r["doc_id"], piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    return found


def test_whole_pipeline_keeps_every_decision_of_its_stages(spark, docs, tmp_path):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    left = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        want = what_stays(spark, name, left, labels, f"{tmp_path}/{i}")
        rows = Counter(tuple(r[c] for c in docs.columns) for r in want)
        assert Counter(map(tuple, stage(spark, left, FOLDER).collect())) == rows, name
        # Each stage has something to do.
        assert rows != Counter(map(tuple, left.collect())), name
        left = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in want], docs.schema)
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces_of(want)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, messy, name):
    stage = by_name(name)
    odd = messy.withColumn("n_chars", F.length("text").cast("long"))
    got = stage(spark, odd, FOLDER)
    last = name == "best-fit packing"
    rows = got.collect()
    if not last:
        assert got.columns == odd.columns
        same = [c for c in odd.columns if c not in ("text", "n_chars")]
        given = Counter(tuple(r[c] for c in same) for r in odd.collect())
        assert not Counter(tuple(r[c] for c in same) for r in rows) - given
        assert any(r["doc_id"] is None for r in rows)
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in odd.collect()}
    none = stage(spark, odd.filter("false"), FOLDER)
    assert none.count() == 0 and none.columns == got.columns


def test_the_choice_among_rows_with_one_id_and_text_is_defined(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "x"), (2, "a b c d e f", "w")]
    seen = set()
    for seed in range(3):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").orderBy(F.rand(seed)).repartition(3)
        seen.add(tuple(map(tuple, by_name("n-gram Jaccard join")(spark, df, FOLDER).collect())))
    assert len(seen) == 1 and len(next(iter(seen))) == 1
