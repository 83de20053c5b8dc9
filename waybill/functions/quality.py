"""Quality metrics of one text: what can be found in it and how it is marked up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions import patterns as P
from waybill.functions.dialect import (
    SPACE_CLASS,
    Pattern,
    count_matches,
    extract,
    extract_all,
    java,
    replace,
)

# A run of letters and spaces, whole, with the rest of an address if one follows.  Every
# run is read once; a run without a comma is no address.
_CITY_RUN = Pattern(
    r"[A-Za-z\s]++(?:,\s+[A-Z]{2}\s+\d{5}(?:-\d{4})?)?", ignore_case=False
)
# The end of an address from its comma on, with the last character of a city before it:
# there are as many of these as addresses.
_STATE_ZIP = Pattern(
    r",(?<=[A-Za-z\s],)\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)", ignore_case=False
)
# The same matches, led by a class of few characters and without groups: a group or a list of words
# at the start would be begun at every character.
_WEEKDAY_DATE = Pattern(
    r"[FMSTW][AEHORU][DEINTU](?<=Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+\d{2}/\d{2}/\d{4}"
)
# A line's mark behind its own spaces: as many as there are items, since an item's blank lines
# before its mark hold no other mark.
_LIST_LINE = Pattern(rf"^[{SPACE_CLASS}&&[^\n]]*+[-*+]\s", ignore_case=False, multiline=True)
_ELEMENT = Pattern("[" + "".join(f"\\{mark}" for mark in P.MARKDOWN_ELEMENTS) + "]", ignore_case=False)


def load_number(text: Column) -> Column:
    """The first pattern, in order of priority, that occurs anywhere in the text."""
    # Each match takes the rest of the text with it, so there is one or none.
    first = [p._replace(text=rf"{p.text}.*+", dot_all=True) for p in P.LOAD_NUMBER_BY_PRIORITY]
    return F.coalesce(*[F.get(extract_all(text, p), 0) for p in first], F.lit(P.LOAD_NUMBER_MISSING))


def _found(text: Column, pattern: Pattern, replacement: str, search: Pattern | None = None) -> Column:
    """Every match, rewritten from its groups, from one pass over the text.

    ``search``, if given, finds the same matches sooner.
    """
    return F.transform(
        extract_all(text, search or pattern, 0), lambda match: replace(match, pattern, replacement)
    )


def dates(text: Column) -> Column:
    """``Mon 01/02/2024`` for each weekday and date, in text order."""
    return _found(text, P.WEEKDAY_DATE, "$1 $2", _WEEKDAY_DATE)


def time_windows(text: Column) -> Column:
    """``08:00 - 17:00`` for each window, in text order."""
    return _found(text, P.TIME_WINDOW, "$1 - $2")


def addresses(text: Column) -> Column:
    """``City, ST 12345`` for each address, in text order."""
    outer_space = Pattern(r"^\s+|\s+(?=,)", ignore_case=False)
    found = F.filter(
        F.regexp_extract_all(text, F.lit(java(_CITY_RUN)), 0), lambda run: F.contains(run, F.lit(","))
    )

    def tidy(match: Column) -> Column:
        return replace(replace(match, P.CITY_STATE_ZIP, "$1, $2 $3"), outer_space, "")

    return F.when(F.rlike(text, F.lit(java(_STATE_ZIP))), F.transform(found, tidy)).otherwise(
        F.array().cast("array<string>")
    )


def count_dates(text: Column) -> Column:
    found = count_matches(text, _WEEKDAY_DATE)
    return F.when(F.contains(text, F.lit("/")), found).otherwise(0)


def count_time_windows(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(":")), count_matches(text, P.TIME_WINDOW)).otherwise(0)


def count_addresses(text: Column) -> Column:
    return count_matches(text, _STATE_ZIP)


def markdown_elements(text: Column) -> Column:
    """How many Markdown marks the text holds."""
    return count_matches(text, _ELEMENT)


def markdown_counts(text: Column, is_markdown: Column) -> dict[str, Column]:
    """Marks, headers and list items; zero for text that is not Markdown."""
    headers = is_markdown & F.contains(text, F.lit("#"))
    return {
        "markdown_elements": F.when(is_markdown, markdown_elements(text)).otherwise(0),
        "markdown_headers": F.when(headers, count_matches(text, P.MARKDOWN_HEADER)).otherwise(0),
        "markdown_lists": F.when(is_markdown, count_matches(text, _LIST_LINE)).otherwise(0),
    }


def total_lines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def blank_lines(text: Column) -> Column:
    """Lines of nothing but white space; an empty text is one such line."""
    # Java sees no line start at the very end, where a splitter still sees an empty line.
    empty_last = (text == "") | text.endswith("\n")
    return F.regexp_count(text, F.lit(f"(?md)^[{SPACE_CLASS}]*?$")) + F.when(empty_last, 1).otherwise(0)


def empty_line_ratio(text: Column) -> Column:
    return blank_lines(text) / total_lines(text)


def semantic_score(
    headers: Column, lists: Column, blank_ratio: Column, is_markdown: Column
) -> Column:
    spacing = F.least(blank_ratio * P.BLANK_LINE_WEIGHT, F.lit(float(P.BLANK_LINE_LIMIT)))
    score = headers * P.HEADER_WEIGHT + lists * P.LIST_WEIGHT + spacing
    return F.when(is_markdown, score).otherwise(0.0)


def regex_difficulty(elements: Column, is_markdown: Column) -> Column:
    value = F.least(elements * P.ELEMENT_WEIGHT, F.lit(float(P.DIFFICULTY_LIMIT)))
    return F.when(is_markdown, value).otherwise(0.0)


def difficulty_level(difficulty: Column) -> Column:
    low, middle, high = P.DIFFICULTY_LEVELS
    middle_bound, high_bound = P.DIFFICULTY_BOUNDS
    return (
        F.when(difficulty > high_bound, high)
        .when(difficulty > middle_bound, middle)
        .otherwise(low)
    )
