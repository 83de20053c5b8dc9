"""Run patterns written in Python's ``re`` syntax inside Spark's (Java) regex functions.

The two dialects differ in what ``\\s``, ``\\w``, ``\\d``, ``\\b``, ``$`` and case
folding mean outside ASCII.  The classes are spelled out here, so a pattern gives the
same groups on both sides while the work stays in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and \s treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for Java: single Latin characters, which it looks up in one table, and the
# rest behind one range.  All stand for themselves: Spark compares a pattern with that of the row
# before, and does so for every row.
_LATIN_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
_FAR_SPACE = "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = f"{_LATIN_SPACE}[\u1680-\u3000&&[{_FAR_SPACE}]]"
WORD_CLASS = r"\p{L}\p{N}_"

# Separates captured groups.  It is a control character outside every class that the
# captured groups are built from, so a captured value can never contain it.
GROUP_SEPARATOR = "\u0001"

_ESCAPES = {
    r"\s": f"[{SPACE_CLASS}]",
    r"\w": f"[{WORD_CLASS}]",
    r"\d": r"\p{Nd}",
    r"\Z": r"\z",
    r"\b": f"(?:(?<=[{WORD_CLASS}])(?![{WORD_CLASS}])|(?<![{WORD_CLASS}])(?=[{WORD_CLASS}]))",
}

# Letters outside ASCII that equal an ASCII letter when case is ignored.
_CASE_PARTNERS = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}
_CLASS = r"\[(?:\\.|[^\]])*\]"


class Pattern(NamedTuple):
    """A pattern in Python ``re`` syntax with its flags."""

    text: str
    ignore_case: bool = True
    dot_all: bool = False
    multiline: bool = False

    @property
    def groups(self) -> int:
        return re.compile(self.text).groups


def _partners(text: str) -> str:
    letters = re.sub(r"\\.", "", text)
    ranges = "A-Z" in letters or "a-z" in letters
    return "".join(p for letter, p in _CASE_PARTNERS.items() if ranges or letter in letters.lower())


def _class(text: str, ignore_case: bool) -> str:
    """A class of characters.

    Latin members stand one by one, as Java looks these up in one table but tries ranges and others in
    turn; those beyond come last, behind one range.
    """
    partners = _partners(text) if ignore_case else ""
    members = re.findall(r"\\.|[^\\]-[^\\]|[\s\S]", text[1:-1])
    known = all((m[0] != "\\" or m in (r"\s", r"\d") or not m[1].isalnum()) and m[-1] < "\u0100" for m in members)
    if text.startswith("[^") or "[" in members or "&&" in text or not known:
        return text[:-1] + partners + "]"
    latin: dict[str, None] = {}
    far, digits = partners, ""
    for member in members:
        if member == r"\s":
            latin |= dict.fromkeys(_LATIN_SPACE)
            far += _FAR_SPACE
        elif member == r"\d":
            latin |= dict.fromkeys("0123456789")
            digits = _ESCAPES[member]
        elif len(member) == 3:
            latin |= dict.fromkeys(map(chr, range(ord(member[0]), ord(member[2]) + 1)))
        else:
            latin[member[-1]] = None
    one_by_one = "".join("\\" + c if c in r"\[]^-&" else c for c in latin)
    return f"[{one_by_one}{far and f'[\u0130-\u3000&&[{far}]]'}{digits}]"


def _translated(token: re.Match, ignore_case: bool) -> str:
    """One token of a pattern.

    If case is ignored, ``I``, ``K`` and ``S`` have partners outside ASCII.  Naming them lets Java
    compare letters with its ASCII rule, which is much cheaper than its Unicode one.
    """
    text = token.group()
    if text.startswith("\\"):
        return _ESCAPES.get(text, text)
    if text.startswith("["):
        return re.sub(r"\\.", lambda m: _ESCAPES.get(m.group(), m.group()), _class(text, ignore_case))
    return f"[{text}{_CASE_PARTNERS[text.lower()]}]" if ignore_case else text


def _translate(pattern: Pattern) -> tuple[str, str]:
    """Flags and body of a pattern for Java."""
    flags = "d"
    if pattern.ignore_case:
        flags += "i"
    body = re.sub(
        rf"\\.|{_CLASS}|[iks]", lambda m: _translated(m, pattern.ignore_case), pattern.text, flags=re.IGNORECASE
    )
    if pattern.dot_all:
        flags += "s"
    if pattern.multiline:
        flags += "m"
    return flags, body


def java(pattern: Pattern) -> str:
    """The pattern for Spark's regex functions, flags included."""
    flags, body = _translate(pattern)
    return f"(?{flags}){body}"


def embedded(pattern: Pattern) -> str:
    """The pattern as a part of a larger one."""
    flags, body = _translate(pattern)
    return f"(?{flags}:{body})"


def strip(col: Column) -> Column:
    """Trim every kind of white space, as Python's ``str.strip`` does."""
    return F.btrim(col, F.lit(WHITESPACE))


def extract(col: Column, pattern: Pattern, group: int = 1) -> Column:
    """Group of the first match, or ``''``."""
    return F.regexp_extract(col, java(pattern), group)


def extract_all(col: Column, pattern: Pattern, group: int = 1) -> Column:
    """Group of every match, in text order."""
    return F.regexp_extract_all(col, F.lit(java(pattern)), group)


def count_matches(col: Column, pattern: Pattern) -> Column:
    return F.regexp_count(col, F.lit(java(pattern)))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), 0)


def first_text(values: Column) -> Column:
    """The first that is not empty of some texts, or ``''``."""
    return F.coalesce(F.get(F.filter(values, lambda value: value != ""), 0), F.lit(""))


def replace(col: Column, pattern: Pattern, replacement: str) -> Column:
    return F.regexp_replace(col, java(pattern), replacement)


def capture(col: Column, *patterns: Pattern) -> Column:
    """First match of each pattern in one pass over the text, as one array of groups.

    Every pattern becomes an optional lookahead from the start of the text; groups of a
    pattern that does not occur are ``''``.  One call decodes the text once, where one
    ``regexp_extract`` per group would decode and search it again each time.
    """
    parts = []
    for pattern in patterns:
        parts.append(f"(?:(?=(?s:.*?){embedded(pattern)})|)")
    total = sum(pattern.groups for pattern in patterns)
    replacement = GROUP_SEPARATOR.join(f"${i}" for i in range(1, total + 1))
    whole = r"\A" + "".join(parts) + r"(?s:.*)\z"
    return F.split(F.regexp_replace(col, whole, replacement), GROUP_SEPARATOR, -1)
