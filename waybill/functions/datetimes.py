"""Date and time text to ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions.dialect import Pattern, capture, java, let

# month/day/four-digit year, then a 24-hour clock, or a 12-hour clock with AM
# or PM in any case; seconds are optional, and any white space may part date, time and AM/PM.
DATE_TIME = Pattern(
    r"^(1[0-2]|0[1-9]|[1-9])/(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])/(?!0000)([0-9]{4})\s+"
    r"((?:1[0-2]|0[1-9]|[1-9])(?=[0-9:\s]*[AaPp][Mm]\Z)|(?:2[0-3]|[01][0-9]|[0-9])(?=[0-9:]*\Z))"
    r":([0-5][0-9]|[0-9])(?::([0-5][0-9]|[0-9]))?(?:\s+([AaPp][Mm]))?\Z",
    ignore_case=False,
)

# The same for digits alone: a day without spaces, and the 24-hour clock.
DAY = Pattern(
    r"\A(?:1[0-2]|0[1-9]|[1-9])/(?:3[01]|[12][0-9]|0[1-9]|[1-9])/(?!0000)[0-9]{4}\Z", ignore_case=False
)
TIME = Pattern(
    r"\A(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9])(?::([0-5][0-9]|[0-9]))?\Z", ignore_case=False
)


def date_time_parts(date: Column, time: Column) -> Column:
    """Month, day, year, hour, minute, second and AM or PM, each ``''`` where unreadable."""
    return capture(F.concat(date, F.lit(" "), time), DATE_TIME)


def iso_from_parts(parts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``, or ``''`` for text that is no date or no calendar day."""
    month, day, year, hour, minute, second, half = (F.get(parts, i) for i in range(7))
    month_start = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    valid = F.trim(day).cast("int") <= F.day(F.last_day(month_start))

    from_noon = F.when(F.lower(half) == "pm", 12).otherwise(0)
    hour = F.when(half == "", hour).otherwise((hour.cast("int") % 12 + from_noon).cast("string"))

    def two(digits: Column) -> Column:
        return F.lpad(digits, 2, "0")

    iso = F.concat(
        year, F.lit("-"), two(month), F.lit("-"), two(F.trim(day)),
        F.lit("T"), two(hour), F.lit(":"), two(minute), F.lit(":"), two(second),
    )
    # Digits that were not found are not cast: a failing cast costs more than the parsing.
    return F.when(day == "", "").when(valid, iso).otherwise("")


def combine_datetime(date: Column, time: Column) -> Column:
    """Date text and time text as one ISO text; blank or NULL parts give ``''``."""
    parts = date_time_parts(F.coalesce(date, F.lit("")), F.coalesce(time, F.lit("")))
    return let(parts, iso_from_parts)


def iso_day(date: Column) -> Column:
    """``yyyy-MM-dd`` of a date text of digits and slashes, or ``''``."""
    year = F.substring(date, -4, 4)
    month = F.lpad(F.substring_index(date, "/", 1), 2, "0")
    day = F.lpad(F.substring_index(F.substring_index(date, "/", 2), "/", -1), 2, "0")
    # The cast knows the calendar.
    known = F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date").cast("string")
    return F.coalesce(F.when(F.rlike(date, F.lit(java(DAY))), known), F.lit(""))


def iso_time(time: Column) -> Column:
    """``HH:mm:ss`` of a time text of digits and colons, or ``''``."""
    # Zeros in front of each part, of which all but the last two digits go.
    padded = F.regexp_replace(time, java(TIME), "0$1:0$2:00$3")
    return F.when(F.rlike(time, F.lit(java(TIME))), F.regexp_replace(padded, "0+([0-9]{2})", "$1")).otherwise("")
