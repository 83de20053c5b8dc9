"""Compare two text methods: metrics per text, aggregates per method, winners, reports.

Everything after the per-text metrics comes from one aggregate row, so the number of
methods (two) is the size of whatever is compared, and no row is shuffled by method.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import patterns as P
from waybill.functions import quality as Q
from waybill.operators.documents import MARKDOWN, PLAIN
from waybill.operators.status import has_text


class Methods(NamedTuple):
    """Labels of the two methods, as they stand in the ``method`` column."""

    plain: str = PLAIN
    markdown: str = MARKDOWN


def method_metrics(
    texts: DataFrame,
    keep: Sequence[str] = ("file",),
    text: str = "text",
    method: str = "method",
    methods: Methods = Methods(),
) -> DataFrame:
    """One row per text with its quality metrics; the text itself is dropped."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = texts.select(*keep, F.col(method).alias("method"), body.alias("_text"))
    body, is_markdown = F.col("_text"), F.col("method") == methods.markdown
    df = df.select(
        *keep,
        "method",
        has_text(body).alias("success"),
        Q.load_number(body).alias("load_number"),
        Q.count_dates(body).alias("dates_found"),
        Q.count_time_windows(body).alias("time_windows_found"),
        Q.count_addresses(body).alias("addresses_found"),
        *[c.alias(name) for name, c in Q.markdown_counts(body, is_markdown).items()],
        F.length(body).alias("total_length"),
        Q.total_lines(body).alias("total_lines"),
        Q.blank_lines(body).alias("_blank"),
    )
    df = df.withColumns(
        {
            "load_found": F.col("load_number") != P.LOAD_NUMBER_MISSING,
            "empty_line_ratio": F.col("_blank") / F.col("total_lines"),
            "regex_parsing_difficulty": Q.regex_difficulty(F.col("markdown_elements"), is_markdown),
        }
    ).drop("_blank")
    return df.withColumns(
        {
            "semantic_structure_score": Q.semantic_score(
                F.col("markdown_headers"), F.col("markdown_lists"),
                F.col("empty_line_ratio"), is_markdown,
            ),
            "parsing_difficulty": Q.difficulty_level(F.col("regex_parsing_difficulty")),
        }
    )


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _mean(condition: Column, name: str) -> Column:
    return _or_zero(F.avg(F.when(condition, F.col(name))))


_PRECISION = ("dates_found", "time_windows_found", "addresses_found")
_STRUCTURE = ("semantic_structure_score", "regex_parsing_difficulty", "markdown_headers")


def _time_columns(methods: Methods) -> list[Column]:
    """Successes, total and mean elapsed of the successes, per method."""
    columns = []
    for side, label in zip(Methods._fields, methods):
        good = (F.col("method") == label) & F.col("success")
        columns += [
            F.count_if(good).alias(f"n_success_{side}"),
            _or_zero(F.sum(F.when(good, F.col("elapsed")))).alias(f"total_time_{side}"),
            _mean(good, "elapsed").alias(f"mean_time_{side}"),
        ]
    return columns


def _file_columns(methods: Methods) -> list[Column]:
    return [
        F.count_if(F.col("method") == label).alias(f"n_files_{side}")
        for side, label in zip(Methods._fields, methods)
    ]


def _quality_columns(methods: Methods) -> list[Column]:
    """Loads found, means and difficulty levels per method, over all files.

    ``run_order`` decides which file came first.
    """
    columns = []
    for side, label in zip(Methods._fields, methods):
        mine = F.col("method") == label
        level = F.when(mine, F.col("parsing_difficulty"))
        columns += [
            F.count_if(mine & F.col("load_found")).alias(f"n_loads_{side}"),
            *[_mean(mine, name).alias(f"mean_{name}_{side}") for name in (*_PRECISION, *_STRUCTURE)],
            *[F.count_if(level == name).alias(f"n_{name}_{side}") for name in P.DIFFICULTY_LEVELS],
            F.coalesce(
                F.min_by(level, F.when(mine, F.col("run_order"))), F.lit(P.NO_LEVEL)
            ).alias(f"first_level_{side}"),
        ]
    return columns


def _by_method(row: DataFrame, names: Sequence[str], methods: Methods) -> DataFrame:
    """The one aggregate row as one row per method."""
    sides = F.array(
        *[
            F.struct(
                F.lit(label).alias("method"),
                *[F.col(f"{name}_{side}").alias(name) for name in names],
            )
            for side, label in zip(Methods._fields, methods)
        ]
    )
    return row.select(F.inline(sides))


def time_stats(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """One row: times per method, the ratio of the means, and who is faster by how much."""
    row = df.agg(*_file_columns(methods), *_time_columns(methods))
    plain, markdown = F.col("mean_time_plain"), F.col("mean_time_markdown")
    both = (plain > 0) & (markdown > 0)
    row = row.withColumn("speed_ratio", F.when(both, F.try_divide(markdown, plain)))
    ratio = F.col("speed_ratio")
    return row.withColumns(
        {
            "faster_method": F.when(ratio > 1, methods.plain).when(both, methods.markdown),
            "times_faster": F.when(ratio > 1, ratio).when(both, F.try_divide(F.lit(1.0), ratio)),
        }
    )


def precision_stats(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """Per method: loads found, their rate over all files, and mean findings per file."""
    row = df.agg(*_file_columns(methods), *_quality_columns(methods))
    names = ("n_files", "n_loads", *[f"mean_{name}" for name in _PRECISION])
    rows = _by_method(row, names, methods)
    return rows.withColumn("load_rate", _or_zero(F.try_divide("n_loads", "n_files") * 100))


def structure_stats(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """Per method: mean structure score, regex difficulty and headers."""
    names = [f"mean_{name}" for name in _STRUCTURE]
    return _by_method(df.agg(*_quality_columns(methods)), names, methods)


def difficulty_histogram(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """Per method: files of each difficulty level, 0 included.

    ``first_level`` is the level of the first file, which the summary shows as typical;
    ``modal_level`` is the most frequent one, the easier one on a tie.
    """
    names = [f"n_{level}" for level in P.DIFFICULTY_LEVELS]
    rows = _by_method(df.agg(*_quality_columns(methods)), (*names, "first_level"), methods)
    most = F.greatest(*names)
    modal = F.when(most == 0, P.NO_LEVEL)
    for level in P.DIFFICULTY_LEVELS:
        modal = modal.when(F.col(f"n_{level}") == most, level)
    return rows.select(
        "method",
        *[F.col(f"n_{level}").alias(level) for level in P.DIFFICULTY_LEVELS],
        "first_level",
        modal.alias("modal_level"),
    )


def _fixed(value: Column, digits: int) -> Column:
    """Digits after the point, rounded as the exact binary value says."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def method_summary(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """Seven metrics as text, one column per method."""
    row = df.agg(*_file_columns(methods), *_time_columns(methods), *_quality_columns(methods))

    def texts(side: str) -> list[Column]:
        rate = _or_zero(F.try_divide(f"n_loads_{side}", f"n_files_{side}") * 100)
        return [
            _fixed(F.col(f"mean_time_{side}"), 3),
            F.concat(_fixed(rate, 1), F.lit("%")),
            _fixed(F.col(f"mean_dates_found_{side}"), 2),
            _fixed(F.col(f"mean_addresses_found_{side}"), 2),
            _fixed(F.col(f"mean_semantic_structure_score_{side}"), 2),
            F.col(f"first_level_{side}"),
            _fixed(F.col(f"mean_markdown_headers_{side}"), 2),
        ]

    rows = [
        F.struct(
            F.lit(metric).alias(P.SUMMARY_COLUMN),
            plain.alias(methods.plain),
            markdown.alias(methods.markdown),
        )
        for metric, plain, markdown in zip(
            P.SUMMARY_METRICS, *[texts(side) for side in Methods._fields]
        )
    ]
    return row.select(F.inline(F.array(*rows)))


def method_winners(df: DataFrame, methods: Methods = Methods()) -> DataFrame:
    """One row: the winner of each category and what the rule recommends."""
    row = df.agg(*_time_columns(methods), *_quality_columns(methods))
    time_p, time_m = F.col("mean_time_plain"), F.col("mean_time_markdown")
    found_p, found_m = F.col("mean_addresses_found_plain"), F.col("mean_addresses_found_markdown")
    score_p, score_m = (F.col(f"mean_semantic_structure_score_{s}") for s in Methods._fields)
    hard_p, hard_m = (F.col(f"mean_regex_parsing_difficulty_{s}") for s in Methods._fields)
    plain, markdown = F.lit(methods.plain), F.lit(methods.markdown)
    structured = score_m > P.SEMANTIC_THRESHOLD
    timed = (time_p > 0) & (time_m > 0)
    return row.select(
        F.when(time_p < time_m, plain).otherwise(markdown).alias("speed_winner"),
        F.try_divide(time_m, time_p).alias("speed_ratio"),
        F.when(F.abs(found_p - found_m) < P.TIE_TOLERANCE, P.TIE)
        .when(found_p >= found_m, plain)
        .otherwise(markdown)
        .alias("precision_winner"),
        F.when(score_m > score_p, markdown).otherwise(plain).alias("semantic_winner"),
        F.when(hard_p < hard_m, plain).otherwise(markdown).alias("regex_winner"),
        # The rule speaks only when both methods were timed: one method per use case if
        # the Markdown text is structured, otherwise either.
        F.when(timed & structured, markdown).alias("for_structure"),
        F.when(timed & structured, plain).alias("for_speed"),
        (timed & ~structured).alias("either"),
    )


def method_detail(
    df: DataFrame, methods: Methods = Methods(), prefixes: Sequence[str] | None = None
) -> DataFrame:
    """One row per file with both methods side by side; files with only one are left out.

    The records are paired by one aggregation over the file, which holds two small rows.
    """
    values = (
        "elapsed", "load_number", "dates_found", "addresses_found",
        "semantic_structure_score", "regex_parsing_difficulty",
    )
    sides = [
        F.max(F.when(F.col("method") == label, F.struct(*values))).alias(side)
        for side, label in zip(Methods._fields, methods)
    ]
    paired = df.groupBy(F.col("file").alias(P.DETAIL_FILE_COLUMN)).agg(*sides)
    paired = paired.filter(F.col("plain").isNotNull() & F.col("markdown").isNotNull())
    return paired.select(
        P.DETAIL_FILE_COLUMN,
        *[
            F.col(f"{side}.{value}").alias(f"{prefix}_{name}")
            for side, prefix in zip(Methods._fields, prefixes or methods)
            for value, name in zip(values, P.DETAIL_COLUMNS)
        ],
    )


def time_histogram(
    df: DataFrame, methods: Methods = Methods(), bins: int = P.HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins over each method's own range of successful times, 0 included.

    The last bin is closed; a method with one single time gets a range of width 1 around it.
    """
    times = df.filter(F.col("success") & F.col("method").isin(*methods)).select("method", "elapsed")
    ranges = times.groupBy("method").agg(
        F.min("elapsed").cast("double").alias("low"), F.max("elapsed").cast("double").alias("high")
    )
    single = F.col("low") == F.col("high")
    ranges = ranges.select(
        "method",
        F.when(single, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(single, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    ).withColumn("step", (F.col("high") - F.col("low")) / bins)
    # At most one row per method label: two.
    placed = times.join(F.broadcast(ranges), "method")
    edges_passed = [
        (F.col("elapsed") >= F.col("low") + F.lit(i) * F.col("step")).cast("int")
        for i in range(1, bins)
    ]
    number = edges_passed[0]
    for passed in edges_passed[1:]:
        number = number + passed
    counted = placed.select("method", "low", "step", number.alias("bin"))
    rows = counted.groupBy("method", "low", "step").agg(
        F.array(
            *[
                F.struct(F.lit(i).alias("bin"), F.count_if(F.col("bin") == i).alias("n"))
                for i in range(bins)
            ]
        ).alias("counts")
    )
    return rows.select("method", "low", "step", F.inline("counts")).select(
        "method",
        "bin",
        (F.col("low") + F.col("bin") * F.col("step")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("step")).alias("bin_end"),
        "n",
    )
