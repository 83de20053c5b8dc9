"""Queries: documents to texts, their status, samples, paths and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import html as H
from waybill.functions.markdown import html_to_structured_markdown
from waybill.functions.patterns import PREVIEW_CHARS, PREVIEW_SHORT_CHARS, SAMPLE_SEED, SAMPLE_SIZE
from waybill.operators import documents as D
from waybill.operators.status import document_status
from waybill.operators.status import extraction_status as status_counts
from waybill.plans.catalog import query, table, texts
from waybill.plans.load_docs import load_docs
from waybill.sources import files, sinks

BLANK_EVERY = 17
DOCUMENTS_PER_FILE = 1024
PRUNED_SOURCE = "src7"


@query(f"SELECT page_id, {H.plain_sql('html')} AS text FROM pages")
def html_to_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = texts(spark, sf_dir, "pages")
    return pages.select("page_id", H.html_to_plain(F.col("html")).alias("text"))


@query(f"SELECT page_id, {H.markdown_sql('html')} AS text FROM pages")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = texts(spark, sf_dir, "pages")
    return pages.select("page_id", H.html_to_markdown(F.col("html")).alias("text"))


# One page per order whose text is known from the row.
_NAME = "replace(o_orderpriority, '-', ' <&> ')"
_PAGE = (
    "'<!DOCTYPE html>' || chr(10) || '<html><head><TITLE>no</TITLE><style>p [x]</style><!-- <p>no</p> --></head>' "
    "|| chr(10) || '<body class=a><h2 id=x>Order&nbsp;' || o_orderkey || '</h2><p>Priority &mdash; <b>' "
    f"|| replace(replace(replace({_NAME}, '&', '&amp;'), '<', '&lt;'), '>', '&#62;') "
    "|| '</b></p><script type=x>var a = \"</p>\" < 1;</script><ul><li class=n>key &#x23;' || o_custkey "
    "|| '</li><LI>' || o_orderstatus || '&#8217;s &amp;lt;&eacute;&unknown;</LI></ul>one<br/>two' "
    "|| CASE WHEN o_orderkey % 2 = 0 THEN ' <!-- open <em' ELSE '<br>' || chr(10) || ' three ' END"
)


def _page_text(heading: str, part: str, bold: str, first: str, item: str) -> str:
    """The text of that page, by what stands for its marks."""
    marks = {k: f"'{v}'".replace("\n", "' || chr(10) || '") for k, v in locals().items()}
    return (
        f"SELECT o_orderkey AS order_key, {marks['heading']} || 'Order ' || o_orderkey || {marks['part']} "
        f"|| 'Priority — ' || {marks['bold']} || {_NAME} || {marks['bold']} || {marks['first']} || 'key #' "
        f"|| o_custkey || {marks['item']} || o_orderstatus || '’s &lt;é&unknown;' || {marks['part']} "
        "|| 'one' || chr(10) || 'two' || CASE WHEN o_orderkey % 2 = 0 THEN ' <!-- open <em' "
        "ELSE chr(10) || 'three' END AS text FROM orders"
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A row of some bytes becomes a page, so a split holds many of them.
    orders = files.spread(table(spark, sf_dir, "orders"), finer=8)
    return orders.select(F.col("o_orderkey").alias("order_key"), F.expr(_PAGE).alias("html"))


@query(_page_text("", "\n", "", "\n", "\n"))
def page_to_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("order_key", H.html_to_plain(F.col("html")).alias("text"))


@query(_page_text("## ", "\n\n", "**", "\n\n- ", "\n\n- "))
def page_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("order_key", H.html_to_markdown(F.col("html")).alias("text"))


_LINES_SQL = (
    "SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS lines, list(part ORDER BY l_linenumber) AS parts "
    "FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY ALL) GROUP BY l_orderkey"
)


def _each(text: str) -> str:
    """``text`` for every line of an order, joined; ``$n``, ``$i`` and ``$p`` are its number, its
    count from the first line's number, and its part."""
    said = text.replace("$n", "' || n || '").replace("$i", "' || (lines[1] + list_position(lines, n) - 1) || '").replace("$p", "' || parts[list_position(lines, n)] || '").replace("\n", "' || chr(10) || '")
    return f"coalesce(array_to_string(list_transform(lines, lambda n: '{said}'), ''), '')"


@query(
    f"WITH l AS ({_LINES_SQL}) SELECT o_orderkey AS order_key, rtrim('# Order ' || o_orderkey || repeat(chr(10), 2) "
    "|| 'By [customer ' || o_custkey || '](/c/' || o_custkey || '?a=1&b=%282%29) & **co**' || repeat(chr(10), 2) "
    + f"|| {_each('$i. Line\n    - part *$p*\n')} || CASE WHEN lines IS NULL THEN '' ELSE chr(10) END "
    + "|| '| Line | Part \\| no |' || chr(10) || '| --- | --- |' || chr(10) "
    + f"|| {_each('| $n | $p x |\n')} || chr(10) "
    "|| '```' || chr(10) || 'a  =  ' || o_orderkey || repeat(chr(10), 2) || '  if a < ' || o_custkey || ':' || chr(10) "
    "|| '```' || repeat(chr(10), 2) || '![n&m](i/' || o_orderkey || '.png)') AS text "
    "FROM orders LEFT JOIN l ON l_orderkey = o_orderkey"
)
def page_to_structured_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order, with its lines as nested lists and as a table."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    lines = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "part"))).alias("lines"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def each(*text: str) -> Column:
        said = [{"$n": "l_linenumber", "$p": "part"}.get(t, t) for t in text]
        one = lambda line: F.concat(*(line[t].cast("string") if t in ("l_linenumber", "part") else F.lit(t) for t in said))
        return F.coalesce(F.array_join(F.transform("lines", one), "\n"), F.lit(""))

    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    first = F.coalesce(F.get("lines", 0)["l_linenumber"], F.lit(1)).cast("string")
    page = F.concat(
        F.lit("<html><body><H1>Order "), key, F.lit('</H1>\n<p>By <a class="c" href="/c/'), customer,
        F.lit('?a=1&amp;b=(2)">customer '), customer, F.lit("</a> &amp; <STRONG>co</STRONG>\n<ol start='"), first, F.lit("'>\n"),
        each("<li>Line<ul>\n <li>part <em>", "$p", "</em></ul></li>"),
        F.lit("</ol><table><tr><th>Line<th>Part | no</tr>"), each("<tr><td>", "$n", "</td> <td>", "$p", "<br>x</td></tr>"),
        F.lit("</table><pre>\na  =  "), key, F.lit("\n\n  if a &lt; "), customer,
        F.lit(':\n</pre><img alt="n&amp;m" src="i/'), key, F.lit('.png"></body></html>'),
    )
    pages = files.spread(rows.select(F.col("o_orderkey").alias("order_key"), page.alias("html")), orders, finer=8)
    return pages.select("order_key", html_to_structured_markdown(F.col("html")).alias("text"))


@query(
    f"SELECT page_id, method, text FROM (SELECT page_id, 'plain' AS method, "
    f"{H.plain_sql('html')} AS text FROM pages UNION ALL SELECT page_id, 'markdown', "
    f"{H.markdown_sql('html')} FROM pages) t WHERE text <> ''"
)
def method_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored texts of both methods, read back from the table they are written to."""
    rendered = D.render_methods(texts(spark, sf_dir, "pages"), "html", ["page_id"])
    path = files.shared_folder(spark, "method_texts")
    sinks.write_partitioned(D.method_texts(rendered), path, "method")
    return spark.read.parquet(path).select("page_id", "method", "text")


@query(
    "SELECT conv_id, string_agg(text || chr(10), '' ORDER BY turn) AS text FROM conversations "
    "WHERE coalesce(text, '') <> '' GROUP BY ALL"
)
def concat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.join_pages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query(
    f"SELECT count(*) AS n_documents, count(*) FILTER (WHERE o_orderkey % {BLANK_EVERY} <> 0) "
    f"AS n_ok, count(*) FILTER (WHERE o_orderkey % {BLANK_EVERY} = 0 AND o_orderkey % 2 = 0) "
    f"AS n_empty, count(*) FILTER (WHERE o_orderkey % {BLANK_EVERY} = 0 AND o_orderkey % 2 = 1) "
    f"AS n_failed, count(*) FILTER (WHERE o_orderkey % {BLANK_EVERY} <> 0) > 0 AS passed "
    "FROM orders"
)
def extraction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 17th text is blanked: half of those are empty, half unreadable."""
    docs = load_docs(spark, sf_dir)
    blanked = F.when(F.col("order_key") % BLANK_EVERY != 0, F.col("text")).when(
        F.col("order_key") % 2 == 0, ""
    )
    return status_counts(document_status(docs.withColumn("text", blanked)))


_STEM = r"^((?:.*/)?\.*[^./][^/]*)\.[^./]*$"


@query(
    "SELECT page_id, url, 'txt/' || regexp_replace(CASE WHEN starts_with(url, 'https://') "
    f"THEN substr(url, 9) ELSE url END, '{_STEM}', '\\1') || '.txt' AS text_path FROM pages"
)
def path_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = D.output_path(F.col("url"), "https://", "txt/")
    return texts(spark, sf_dir, "pages").select("page_id", "url", path.alias("text_path"))


@query(
    "SELECT doc_id, source, lang FROM documents "
    f"ORDER BY md5(CAST(doc_id AS VARCHAR) || '{SAMPLE_SEED}'), doc_id LIMIT {SAMPLE_SIZE}"
)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return D.seeded_sample(documents, "doc_id")


@query(
    "SELECT doc_id, greatest(0, (SELECT count(*) FROM documents) - 5) AS n_more "
    "FROM documents ORDER BY doc_id LIMIT 5"
)
def first_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_listing(table(spark, sf_dir, "documents"), "doc_id")


@query(
    f"SELECT doc_id, substring(text, 1, {PREVIEW_CHARS}) AS preview, "
    f"substring(text, 1, {PREVIEW_SHORT_CHARS}) AS short_preview, "
    f"CAST(len(regexp_extract_all(substring(text, 1, {PREVIEW_CHARS}), '[#*\\[\\]`]')) AS INTEGER) "
    "AS markdown_elements FROM documents"
)
def preview_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.preview(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def _text_folder(spark: SparkSession, sf_dir: str) -> str:
    path = files.shared_folder(spark, "texts")
    documents = table(spark, sf_dir, "documents")
    sinks.write_text(documents, path, "source", records_per_file=DOCUMENTS_PER_FILE)
    return path


@query(
    "SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, "
    "CAST(sum(length(text) + 1) AS BIGINT) AS n_chars, "
    "CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines, "
    "0 AS n_unreadable, 0 AS n_elsewhere FROM documents GROUP BY source"
)
def scan_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files scanned back from ``source=`` folders, added up per source.

    ``n_elsewhere`` counts files whose address does not name their source.
    """
    texts = files.scan_text_files(spark, _text_folder(spark, sf_dir))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    folder = F.concat(F.lit("/source="), F.col("source"), F.lit("/"))
    return texts.groupBy("source").agg(
        F.sum(F.octet_length("text")).alias("n_bytes"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(lines).alias("n_lines"),
        F.count_if(F.col("text").isNull()).alias("n_unreadable"),
        F.count_if(~F.contains(files.display_path(F.col("source_file")), folder)).alias("n_elsewhere"),
    )


@query(
    "SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes "
    "FROM documents GROUP BY source"
)
def discover_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found at any depth, added up per source folder; contents are not read."""
    found = files.discover_documents(spark, _text_folder(spark, sf_dir), ".TXT")
    source = F.regexp_extract("path", r"/source=([^/]+)/", 1)
    return found.groupBy(source.alias("source")).agg(F.sum("length").alias("n_bytes"))


@query(f"SELECT doc_id, text, lang, n_chars, source FROM documents WHERE source = '{PRUNED_SOURCE}'")
def source_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_folder(spark, "documents")
    sinks.write_partitioned(table(spark, sf_dir, "documents"), path, "source")
    return files.read_source(spark, path, PRUNED_SOURCE)


_BAD_SOURCES = "('src3', 'src7')"


@query(
    f"SELECT source, CASE WHEN source IN {_BAD_SOURCES} THEN 'failed' ELSE 'ok' END AS status, "
    f"CAST(sum(strlen(text) + CASE WHEN source IN {_BAD_SOURCES} THEN 2 ELSE 1 END) AS BIGINT) AS n_bytes, "
    f"(SELECT count(DISTINCT source) > 0 FROM documents WHERE source IN {_BAD_SOURCES}) AS any_failed "
    "FROM documents GROUP BY source"
)
def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of which some are not UTF-8: written apart in one pass, the unreadable bytes kept,
    the counts observed by that pass."""
    documents = table(spark, sf_dir, "documents")
    # A byte that starts no character.
    bad = F.when(F.col("source").isin("src3", "src7"), F.unhex(F.lit("FF")).cast("string")).otherwise("")
    texts_at = files.shared_folder(spark, "odd-texts")
    odd = documents.select(F.concat("text", bad).alias("text"), "source")
    sinks.write_text(odd, texts_at, "source", records_per_file=DOCUMENTS_PER_FILE)
    apart = files.shared_folder(spark, "by-status")
    counts = sinks.write_by_status(files.scan_text_files(spark, texts_at, keep_unreadable=True), apart)
    rows = spark.read.parquet(apart)
    n_bytes = F.sum(F.coalesce(F.octet_length("unreadable"), F.octet_length("text"))).alias("n_bytes")
    return rows.groupBy("source", "status").agg(n_bytes).withColumn("any_failed", F.lit(counts.get["n_failed"] > 0))


@query(
    "SELECT source, CASE WHEN source < 'src5' THEN 1 ELSE 2 END AS run, "
    "CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source"
)
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files that arrive in two parts, read by two runs of one stream: the second reads only what
    is new."""
    documents = table(spark, sf_dir, "documents")
    texts_at, out, checkpoint = (files.shared_folder(spark, name) for name in ("arrivals", "scanned", "progress"))
    for run, part in ((1, F.col("source") < "src5"), (2, ~(F.col("source") < "src5"))):
        rows = documents.filter(part)
        sinks.write_text(rows, texts_at, "source", records_per_file=DOCUMENTS_PER_FILE, mode="append")
        arrived = files.stream_text_files(spark, texts_at, partitions="source string")
        sinks.append_stream(arrived.withColumn("run", F.lit(run)), out, checkpoint)
    scanned = spark.read.parquet(out)
    return scanned.groupBy("source", "run").agg(F.sum(F.octet_length("text")).alias("n_bytes"))
