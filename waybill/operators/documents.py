"""Documents to texts: render, join pages, map paths, sample and preview."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.html import html_to_markdown, html_to_plain
from waybill.functions.patterns import (
    PREVIEW_CHARS,
    PREVIEW_SHORT_CHARS,
    SAMPLE_SEED,
    SAMPLE_SIZE,
)
from waybill.functions.quality import markdown_elements

PLAIN, MARKDOWN = "plain", "markdown"

# Page numbers whose pages are joined together before a document's parts are.
PAGES_PER_PART = 4096


def render_methods(
    df: DataFrame,
    html: str,
    keep: Sequence[str],
    markdown: Callable[[Column], Column] = html_to_markdown,
) -> DataFrame:
    """One row per document and method: ``keep, method, text``.

    ``markdown`` may be ``html_to_structured_markdown``, which keeps nested lists, tables and links.
    """
    both = F.array(
        F.struct(F.lit(PLAIN).alias("method"), html_to_plain(F.col(html)).alias("text")),
        F.struct(F.lit(MARKDOWN).alias("method"), markdown(F.col(html)).alias("text")),
    )
    return df.select(*keep, F.inline(both))


def method_texts(texts: DataFrame) -> DataFrame:
    """The texts worth storing: those that are not empty."""
    return texts.filter(F.coalesce("text", F.lit("")) != "")


def join_pages(
    df: DataFrame, document: str, page: str, text: str, pages_per_part: int = PAGES_PER_PART
) -> DataFrame:
    """Non-empty pages in page order, each with a line end: ``document, text``, one row each.

    Pages are joined in blocks of page numbers first, so that a long document's pages are
    sorted by many tasks; only its finished blocks meet in its row.
    """
    part = F.floor(F.col(page) / pages_per_part)
    pages = F.array_sort(F.collect_list(F.struct(F.col(page).alias("page"), F.col(text).alias("text"))))
    joined = F.array_join(F.transform(pages, lambda p: F.concat(p["text"], F.lit("\n"))), "")
    blocks = (
        df.filter(F.coalesce(F.col(text), F.lit("")) != "")
        .groupBy(F.col(document), part.alias("part"))
        .agg(joined.alias("block"))
    )
    parts = F.array_sort(F.collect_list(F.struct("part", "block")))
    whole = F.array_join(F.transform(parts, lambda p: p["block"]), "")
    return blocks.groupBy(document).agg(whole.alias("text"))


def output_path(path: Column, input_root: str, output_root: str) -> Column:
    """The path of a document's text: same place below ``output_root``, ending ``.txt``."""
    relative = F.when(
        path.startswith(input_root), F.substring(path, F.lit(len(input_root) + 1), F.length(path))
    ).otherwise(path)
    # The extension is what follows the last dot of a name that does not start with it.
    stem = F.regexp_replace(relative, r"(?s)^((?:.*/)?\.*[^./][^/]*)\.[^./]*$", "$1")
    return F.concat(F.lit(output_root), stem, F.lit(".txt"))


def seeded_sample(
    df: DataFrame, key: str, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED
) -> DataFrame:
    """``n`` rows (all, if there are fewer), always the same for a seed.

    A top-n by hash: every task keeps ``n`` rows, nothing is sorted as a whole.
    """
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(ticket, F.col(key)).limit(n)


def first_listing(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` keys, each with how many more there are."""
    total = df.select(F.count("*").alias("_total"))
    top = df.select(key).orderBy(key).limit(n)
    return top.withColumn("n_more", F.greatest(F.lit(0), total.scalar() - n))


def preview(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """How each text begins, and the Markdown marks in that beginning."""
    start = F.substring(F.col(text), 1, PREVIEW_CHARS)
    return df.select(*keep, start.alias("preview")).select(
        *keep,
        "preview",
        F.substring("preview", 1, PREVIEW_SHORT_CHARS).alias("short_preview"),
        markdown_elements(F.col("preview")).alias("markdown_elements"),
    )
