"""The queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from waybill.llm.ann import search_neighbours
from waybill.llm.centroids import cluster_vectors, with_inertia
from waybill.llm.chat import BREAK, END, NEXT, START, format_conversations, read_loss, read_turns
from waybill.llm.common import crc_of_id, stored
from waybill.llm.decontaminate import mark_benchmark_words
from waybill.llm.exact_topk import exact_top_k, scaled
from waybill.llm.jaccard import near_duplicate_classes
from waybill.llm.packing import pack_documents
from waybill.llm.pieces import encode_pieces
from waybill.llm.quality import add_quality, learn_quality, with_statistics
from waybill.llm.repair import damaged, repair_conversations, repair_digests
from waybill.llm.repeats import remove_repeats
from waybill.llm.token_counts import count_tokens
from waybill.llm.toxicity import learn_field, tag_toxicity
from waybill.plans.catalog import Query, query_in, table

QUERIES: dict[str, Query] = {}
query = functools.partial(query_in, QUERIES)

EXTRA_TEXT = f"{END}{START}assistant ok"

_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"

OP1_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{EXTRA_TEXT}'
    UNION ALL SELECT -1, 1, 'assistant', '{EXTRA_TEXT}'
), numbered AS (
    SELECT *, row_number() OVER w AS i, lag(role) OVER w AS earlier
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), marked AS (
    SELECT *, earlier IS NOT DISTINCT FROM role AS goes_on, {_ESCAPED.format("text")} AS e_text,
        replace({_ESCAPED.format("role")}, chr(10), '{BREAK}') AS e_role
    FROM numbered
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i)) AS loss_sha256,
    sum(length(e_text) + CASE WHEN goes_on THEN {len(NEXT)}
        ELSE length(e_role) + {len(START) + 1 + len(END) + 1} END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query(OP1_SQL)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    chats = format_conversations(turns.unionByName(extra)).select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"), "segments", "formatted"
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    digest = chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        read_loss(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return digest.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search_neighbours(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path, capacity=1024, end_id=2)


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, sf_dir, "documents"), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query(OP6_SQL)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    whole = vectors.select("vec_id", scaled(F.col("embedding")).alias("embedding"))
    return exact_top_k(whole, whole.filter(F.col("vec_id") % 50 == 0), k=5)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id(F.col("doc_id")) % 5 == 0
    field = learn_field(docs, labels.filter(~held_out))
    tagged = tag_toxicity(docs, field)
    return tagged.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, limit=512)


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    rows = stored(with_statistics(docs), "statistics")
    known = labels.filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = add_quality(rows, learn_quality(rows, rows.join(known, "doc_id")))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), words=5, percent=80)


@query()
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = repair_conversations(damaged(table(spark, sf_dir, "conversations")), copies_col="copies")
    return repair_digests(parts).withColumnRenamed("conv", "conv_id")


_OP12_WORDS = r"regexp_extract_all(translate({}, '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    "coalesce(text, '')", string.ascii_uppercase, string.ascii_lowercase
)

OP12_SQL = f"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_OP12_WORDS} AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS m, list_aggregate(words[i:i + least(len(words), 10) - 1], 'string_agg', ' ') AS w
    FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0)
), docs AS (
    SELECT doc_id, row_number() OVER () AS r, {_OP12_WORDS} AS words FROM documents
), found AS (
    SELECT DISTINCT r, i, m, item
    FROM (
        SELECT r, i, m, list_aggregate(words[i:i + m - 1], 'string_agg', ' ') AS w
        FROM (
            SELECT r, words, m, unnest(range(1, len(words) - m + 2)) AS i
            FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(words) >= m
        )
    ) JOIN windows USING (m, w)
), words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r
), hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(docs.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words w USING (r) LEFT JOIN hit_items USING (r)
"""


@query(OP12_SQL)
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    marked = mark_benchmark_words(docs, items, window=10)
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _nearest_sql(i: int) -> str:
    """Every vector's nearest centroid of table ``c{i}``."""
    return f"""a{i} AS (
    SELECT r, cluster, d AS distance FROM (
        SELECT r, cluster, list_sum(list_transform(range(1, 65), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT AS d
        FROM kept, c{i}
    ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1
)"""


def _round_sql(i: int) -> str:
    """Table ``c{i}`` from the assignment before."""
    return f"""c{i} AS (
    SELECT cluster, coalesce(n, c) AS c FROM c{i - 1} LEFT JOIN (
        SELECT cluster, list(m ORDER BY j) AS n FROM (
            SELECT cluster, j, floor(sum(v[j]) / count(*))::BIGINT AS m
            FROM a{i - 1} JOIN kept USING (r), range(1, 65) AS js(j) GROUP BY cluster, j
        ) GROUP BY cluster
    ) USING (cluster)
)"""


CLUSTERS, ROUNDS = 40, 5
OP13_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1)::INTEGER AS cluster, v AS c FROM kept
    ORDER BY sha256('2:' || vec_id), v LIMIT {CLUSTERS}
), {_nearest_sql(0)},
{", ".join(f"{_round_sql(i)}, {_nearest_sql(i)}" for i in range(1, ROUNDS + 1))}
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN c{ROUNDS} USING (cluster)
"""


@query(OP13_SQL)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), clusters=CLUSTERS, rounds=ROUNDS, seed=2)
    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    # One text per cluster, at most CLUSTERS.
    text = F.get(F.array(*map(F.lit, texts)).cast("array<string>"), F.col("cluster"))
    return with_inertia(assigned).select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(text.cast("binary"), 256).alias("centroid_sha256"),
    )


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
