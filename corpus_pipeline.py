"""From raw documents to packed training sequences, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents.  All but the last return the columns of
the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import crc_of_id, stored
from waybill.llm.jaccard import one_of_each_class
from waybill.llm.packing import pack_documents
from waybill.llm.quality import add_quality, learn_quality, with_statistics
from waybill.llm.repeats import remove_repeats
from waybill.llm.toxicity import learn_field, tag_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rather toxic, with all their columns as they are.

    The field learns from the labels of the training share alone.  NULL and empty texts have no
    toxic word and stay; rows with NULL or repeated ids are judged by their own text; without
    labels, or documents, nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = learn_field(docs, labels.filter(crc_of_id(F.col("doc_id")) % 5 != 0))
    return tag_toxicity(docs, field, keep=docs.columns, clean_only=True)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.5, with all their columns as they are.

    Every row is judged by its own text's statistics, zeros for NULL and empty ones; NULL ids have no
    label, repeated ones each have theirs.  Without labels, or documents, nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.filter(crc_of_id(F.col("doc_id")) % 3 != 1)
    known = known.select("doc_id", F.col("quality").alias("label"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items()))
    rows = stored(with_statistics(plain, plain.columns, names["text"]), "statistics")
    labelled = rows.select(F.col(names["doc_id"]).alias("doc_id"), "x").join(known, "doc_id")
    kept = add_quality(rows, learn_quality(rows, labelled), plain.columns, plain.schema).filter("predicted = 1")
    return kept.select(*(F.col(name).alias(c) for c, name in names.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, with all its columns: the one with the smallest id,
    NULL last; of rows with one id, that with the least hash of its text, then of its columns.

    Texts that are NULL or without words are in no class and all stay.
    """
    return one_of_each_class(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without words of repeated passages and ``n_chars`` to match.

    Repeated rows repeat each other's passages, whatever their ids; NULL texts become empty; other
    columns are as they are.
    """
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    left = remove_repeats(docs.select(others, "text"), window=35, keep=["row"])
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return left.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024.

    Every row gives its pieces, under its id, repeated and NULL ids included; NULL and empty
    texts are their end mark alone; an empty table gives an empty result.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packing),
]

#: No stage but the third can be said in SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
