"""Text and column normalisation."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.dialect import SPACE_CLASS, WHITESPACE, Pattern, replace, strip
from waybill.functions.patterns import LINE_BREAK_CLASS, NORMALIZE_RULES


# The same rules: a label that is right already is left as it is, and a line is joined where its
# break is found, instead of testing every character before one.
_SAME_BUT_FASTER = {
    r"PickUp\b": Pattern(
        r"[Pp](?!(?<=P)ickup)[Ii\u0130\u0131][Cc][Kk\u212a][Uu][Pp](?!\w)", ignore_case=False
    ),
    r"(?<=\w)\n(?=[A-Z0-9])": Pattern(r"\n(?=[A-Z0-9])(?<=\w\n)", ignore_case=False),
}

# Of more than one line break none is joined, and all become one in the end.
_DONE_AT_THE_END = r"\n{3,}"

# Texts, at least one of which a rule needs; looking for them is far cheaper than the
# pattern.  Where case is ignored they are all the spellings of a short part.
_NEEDS = {
    r"\*{2,}": ("**",),
    r"Del\.\s*Date": ("l.", "L."),
    r"Miami Lake,s": (",s", ",S", ",\u017f"),
    r"[ \t\u00A0]+": ("  ", "\t", "\u00a0"),
    r"\r\n?": ("\r",),
}
# Any of these texts in one pass, led by a class of few characters: looking for each of them in
# every text takes longer than most of the rules.
_ANY_NEED = r"[*.,\t\r \u00a0](?: (?<=  )|(?<! )(?:(?<=[\t\r\u00a0])|(?<=\*)\*|(?<=[lL]\.)|(?<=,)[sS\u017f]))"

# Line breaks at the end, which go, or several, of which the last stays.
_BREAKS = r"\n(?:\n*+\z|\n*(\n))"
# A run of white space holding a line break, and such a break that is no lone "\n"; single
# characters below 256 are looked up in one table, so the two others are looked for apart.
_LINE_ENDS = f"[{SPACE_CLASS}]+(?<=[{LINE_BREAK_CLASS}])[{SPACE_CLASS}]*"
_UNEVEN_BREAK = (
    rf"[\n\x0b\x0c\r\x1c\x1d\x1e\x85](?:(?<!\n)|(?<=[{SPACE_CLASS}]\n)|(?=[{SPACE_CLASS}]))"
)
_RARE_BREAKS = ("\u2028", "\u2029")


def normalize_text(df: DataFrame, text: str, into: str = "text") -> DataFrame:
    """``into``: document text with marks, labels, spaces and line breaks made uniform.

    After the ordered rules every line is stripped and blank lines go: a run of white
    space holding a line break is one ``\\n``, and the ends are trimmed.
    """
    df = df.withColumn(into, F.coalesce(F.col(text), F.lit("")))
    current = F.col(into)
    needy = f"_{into}_needy"
    df = df.withColumn(needy, F.rlike(current, F.lit(_ANY_NEED)))
    for pattern, replacement in NORMALIZE_RULES:
        if pattern.text == _DONE_AT_THE_END:
            continue
        changed = replace(current, _SAME_BUT_FASTER.get(pattern.text, pattern), replacement)
        needs = _NEEDS.get(pattern.text)
        if needs:
            possible = reduce(or_, [F.contains(current, F.lit(need)) for need in needs])
            changed = F.when(F.col(needy) & possible, changed).otherwise(current)
        df = df.withColumn(into, changed)
    df = df.withColumn(into, F.regexp_replace(current, _BREAKS, "$1")).drop(needy)
    rare = [F.contains(current, F.lit(each)) for each in _RARE_BREAKS]
    uneven = reduce(or_, rare, F.rlike(current, F.lit(_UNEVEN_BREAK)))
    df = df.withColumn(into, F.when(uneven, F.regexp_replace(current, _LINE_ENDS, "\n")).otherwise(current))
    # Trimming reads the whole text, a test of its ends does not.
    ends = [at(current, F.lit(each)) for each in WHITESPACE for at in (F.startswith, F.endswith)]
    done = F.when(reduce(or_, ends), strip(current)).otherwise(current)
    # One value exploded is that value.  A filter or semi-join on a field read from it stays
    # above the generator, where it would else be pushed down with a copy of all rules for
    # every use of the text.
    return df.withColumn(into, F.explode(F.array(done)))


def normalize_strings(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Trim every string column, and lower it unless ``case_sensitive``; others stay."""

    def clean(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return column
        return F.trim(column if case_sensitive else F.lower(column)).alias(field.name)

    return df.select(*[clean(field) for field in df.schema.fields])
