"""Chat formatting with a loss mask, by native expressions only.

A conversation's turns are collected in blocks of ``BLOCK`` turn numbers, merged and joined
there; only the finished blocks meet in the conversation's row, which holds its whole text
in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.dialect import let

#: The marks of the template.
START, END, NEXT, BREAK = "<|im_start|>", "<|im_end|>", "<|im_next|>", "<|im_break|>"
#: Turn numbers that are collected together.
BLOCK = 256


def escape(text: Column) -> Column:
    """No mark can occur in the result: ``<|`` becomes ``<\\|``, and so on with more strokes."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _merged(turns: Column) -> Column:
    """Runs ``(role, texts)`` of adjacent turns with one role, in linear time."""

    def run(start: Column, following: Column) -> Column:
        texts = F.transform(F.slice(turns, start + 1, following - start), lambda turn: turn["text"])
        return F.struct(F.get(turns, start)["role"].alias("role"), texts.alias("texts"))

    begins = F.transform(
        turns, lambda turn, i: F.when((i == 0) | (F.get(turns, i - 1)["role"] != turn["role"]), i)
    )
    return let(
        F.filter(begins, lambda i: i.isNotNull()),
        lambda starts: F.transform(
            starts, lambda start, j: run(start, F.coalesce(F.get(starts, j + 1), F.size(turns)))
        ),
    )


def _segments(runs: Column, opens: Column, closes: Column) -> Column:
    """Segments ``(text, loss)`` of one block; the first run may go on, the last stay open."""

    def of(run: Column, i: Column) -> Column:
        head = F.when((i > 0) | opens, F.concat(F.lit(START), run["role"], F.lit("\n"))).otherwise(NEXT)
        tail = F.when((i < F.size(runs) - 1) | closes, F.lit(f"{END}\n")).otherwise("")
        learnt = run["role"] == "assistant"
        texts = F.transform(
            run["texts"],
            lambda text, k: F.array(
                F.struct(F.when(k > 0, F.lit(NEXT)).otherwise(head).alias("text"), F.lit(False).alias("loss")),
                F.struct(text.alias("text"), learnt.alias("loss")),
            ),
        )
        end = F.array(F.struct(tail.alias("text"), F.lit(False).alias("loss")))
        return F.concat(F.flatten(texts), end)

    return F.flatten(F.transform(runs, of))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv, n_turns, segments, formatted`` per conversation.

    Turns are ordered by turn number (NULL first), then role and text, so that equal numbers
    and repeated rows have one order; a repeated row is a turn of its own.  Adjacent turns of
    one role share a header and end mark, with a mark between their texts.  ``segments`` is
    the formatted text in pieces ``(text, loss)``; the texts of ``assistant`` are under the
    mask.  NULL roles and texts count as empty.  A NULL conversation is one of its own.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.floor(F.col(turn_col) / BLOCK).alias("block"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(role_col, F.lit("")).alias("role"),
            F.coalesce(text_col, F.lit("")).alias("text"),
        ).alias("row"),
    )
    blocks = rows.groupBy("conv", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    escaped = F.transform(
        "rows",
        lambda row: F.struct(
            F.replace(escape(row["role"]), F.lit("\n"), F.lit(BREAK)).alias("role"),
            escape(row["text"]).alias("text"),
        ),
    )
    n = F.size("rows").cast("long").alias("n")
    blocks = blocks.select("conv", "block", n, let(escaped, _merged).alias("runs"))
    joined = blocks.groupBy("conv").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("block", "runs"))).alias("blocks"),
    )

    def first_role(i: Column) -> Column:
        return F.try_element_at(F.try_element_at(F.col("blocks"), i)["runs"], F.lit(1))["role"]

    def last_role(i: Column) -> Column:
        return F.try_element_at(F.try_element_at(F.col("blocks"), i)["runs"], F.lit(-1))["role"]

    def of(block: Column, i: Column) -> Column:
        # i counts from 0, elements from 1; beyond the end there is NULL, not an error.
        opens = (i == 0) | (first_role(i + 1) != last_role(F.greatest(i, F.lit(1))))
        closes = (i == F.size("blocks") - 1) | (last_role(i + 1) != first_role(i + 2))
        return _segments(block["runs"], opens, closes)

    segments = F.flatten(F.transform("blocks", of)).alias("segments")
    return joined.select(F.col("conv").alias(conv_col), "n_turns", segments).withColumn(
        "formatted", F.array_join(F.col("segments.text"), "")
    )


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` as they were before formatting, in order."""
    runs = F.split(F.substr(formatted, F.lit(len(START) + 1)), r"<\|im_start\|>", -1)

    def of(run: Column) -> Column:
        role = F.substring_index(run, "\n", 1)
        texts = F.substr(run, F.length(role) + 2, F.length(run) - F.length(role) - F.lit(len(END) + 2))
        name = unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))
        return F.transform(
            F.split(texts, r"<\|im_next\|>", -1),
            lambda text: F.struct(name.alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(runs, of))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
