"""Patterns give the same groups in Spark as in the dialect they are written in."""

import random
import re

import pytest
from pyspark.sql import functions as F

from waybill.functions import patterns as P
from waybill.functions import quality as Q
from waybill.functions.dialect import WHITESPACE, Pattern, extract, extract_all, strip
from waybill.functions.fields import emails

# Words the patterns look for, values, and characters on which dialects differ.
PIECES = [
    "Customer", "customer:", "Address #1:", "City:", "CITY", "Zip Code:", "zip", "Pickup", "PickUp",
    "Pick Date:", "Pickup Time:", "Delivery Date:", "delivery time", "Time:", "Phone", "Fax:", "Tel:",
    "Trip #", "Total To Pay: $", "Total Carrier Pay", "Send Invoice to:", "Carrier", "MC #:",
    "Trailer VIN Number", "Contact:", "Load", "Load Number", "[Load Number - 7]", "Wed 01/02/2024",
    "sun 31/12/2023", "from 08:00 - 17:00", "Miami, FL 40417", "Port A,\u00a0GA 12345-6789", "#", "1",
    "12/3/2024", "8:00 - 17:30", "8:00 AM - 5:00 PM", "1,234.50", "305-555-0001", "(305) 555 0001",
    "a.b-c@example.com", "ñandú@ejemplo.es", "x@y", "ſan Joſe, FL 40417", "K9 İstanbul, ıı 12345",
    "٣٤٥", "²", "é", "\u0301", "_", "-", ".", ",", "\n", "\r\n", "\t", "\u00a0", "\u2028", "\x1c", "\x85", "  ",
]


def texts(seed: int, count: int = 150) -> list[str]:
    rng = random.Random(seed)
    out = ["", " ", "\n"]
    for _ in range(count):
        parts = [rng.choice(PIECES) for _ in range(rng.randint(1, 40))]
        out.append("".join(p + rng.choice(["", " ", " ", "\n"]) for p in parts))
    return out


def flags(pattern: Pattern) -> int:
    return (
        (re.I if pattern.ignore_case else 0)
        | (re.S if pattern.dot_all else 0)
        | (re.M if pattern.multiline else 0)
    )


NAMED = {
    name: value
    for name, value in vars(P).items()
    if isinstance(value, Pattern) and name not in ("STOP_CUTOFF", "CARRIER")
}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_pattern_agrees(spark, seed):
    sample = texts(seed)
    df = spark.createDataFrame(list(enumerate(sample)), "id int, text string")
    columns = [
        extract(F.col("text"), pattern, group).alias(f"{name}_{group}")
        for name, pattern in NAMED.items()
        for group in range(pattern.groups + 1)
    ]
    for row in df.select("id", *columns).collect():
        for name, pattern in NAMED.items():
            match = re.search(pattern.text, sample[row.id], flags(pattern))
            for group in range(pattern.groups + 1):
                expected = (match.group(group) or "") if match else ""
                assert row[f"{name}_{group}"] == expected, (name, group, sample[row.id])


def test_all_matches_and_counts_agree(spark):
    sample = texts(3)
    df = spark.createDataFrame(list(enumerate(sample)), "id int, text string")
    text = F.col("text")
    rows = df.select(
        "id",
        extract_all(text, P.WEEKDAY_DATE, 2).alias("day_values"),
        Q.dates(text).alias("dates"),
        Q.count_dates(text).alias("n_dates"),
        Q.time_windows(text).alias("windows"),
        Q.count_time_windows(text).alias("n_windows"),
        Q.addresses(text).alias("addresses"),
        Q.count_addresses(text).alias("n_addresses"),
        emails(text).alias("emails"),
        Q.load_number(text).alias("load_number"),
        Q.total_lines(text).alias("lines"),
        Q.blank_lines(text).alias("blank"),
        Q.markdown_elements(text).alias("marks"),
    ).collect()
    for row in rows:
        value = sample[row.id]
        days = re.findall(P.WEEKDAY_DATE.text, value, re.I)
        assert row.dates == [f"{d} {v}" for d, v in days] and row.n_dates == len(days)
        assert row.day_values == [v for _, v in days]
        windows = re.findall(P.TIME_WINDOW.text, value, re.I)
        assert row.windows == [f"{a} - {b}" for a, b in windows] and row.n_windows == len(windows)
        places = re.findall(P.CITY_STATE_ZIP.text, value)
        assert row.addresses == [f"{c.strip()}, {s} {z}" for c, s, z in places], value
        assert row.n_addresses == len(places)
        assert row.emails == "; ".join(sorted(set(re.findall(P.EMAIL.text, value)))), value
        found = [re.search(p.text, value, re.I) for p in P.LOAD_NUMBER_BY_PRIORITY]
        expected = next((m.group(1) for m in found if m), P.LOAD_NUMBER_MISSING)
        assert row.load_number == expected
        lines = value.split("\n")
        assert (row.lines, row.blank) == (len(lines), sum(not line.strip() for line in lines))
        assert row.marks == sum(value.count(mark) for mark in P.MARKDOWN_ELEMENTS)


def test_strip_is_every_white_space(spark):
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    value = WHITESPACE + "a b" + WHITESPACE
    assert spark.range(1).select(strip(F.lit(value)).alias("v")).first().v == "a b"
