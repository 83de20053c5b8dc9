import html
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from waybill.functions import patterns as P
from waybill.functions import quality as Q
from waybill.functions.html import html_to_markdown, html_to_plain
from waybill.functions.quality import markdown_counts
from waybill.operators import compare as C

PLAIN = "Load 12\nWed 01/02/2024 from 08:00 - 17:00\nMiami, FL 40417\n\n"
MARKED = "# Load 12\n\n- a\n- b\n\n**x**"


@pytest.fixture
def metrics(spark):
    rows = [
        (0, "plain", PLAIN, 1.0), (0, "markdown", MARKED, 2.0),
        (1, "plain", PLAIN * 2, 3.0), (1, "markdown", "", 9.0),
        (2, "plain", "none", 2.0), (2, "markdown", "*" * 700, 4.0),
        (3, "plain", "only here", 2.0),
    ]
    df = spark.createDataFrame(rows, "file int, method string, text string, elapsed double")
    out = C.method_metrics(df, keep=("file", "elapsed"))
    return out.withColumn("run_order", F.col("file"))


def test_metrics(metrics):
    rows = {(r.file, r.method): r for r in metrics.collect()}
    plain, marked, failed = rows[0, "plain"], rows[0, "markdown"], rows[1, "markdown"]
    assert (plain.load_number, plain.dates_found, plain.time_windows_found, plain.addresses_found) == ("12", 1, 1, 1)
    assert plain.markdown_elements == 0 and plain.semantic_structure_score == 0
    assert (marked.markdown_elements, marked.markdown_headers, marked.markdown_lists) == (5, 1, 2)
    assert marked.semantic_structure_score == 1 * 5 + 2 * 2 + min(2 / 6 * 50, 20)
    # A failed Markdown text is one blank line: it scores, but is no success.
    assert not failed.success and failed.semantic_structure_score == 20
    assert failed.load_number == P.LOAD_NUMBER_MISSING and failed.empty_line_ratio == 1.0
    assert rows[2, "markdown"].regex_parsing_difficulty == 700 * 0.05
    assert rows[2, "markdown"].parsing_difficulty == "ALTA"


def test_time_stats(metrics):
    row = C.time_stats(metrics).first()
    assert (row.n_files_plain, row.n_files_markdown, row.n_success_markdown) == (4, 3, 2)
    assert (row.mean_time_plain, row.mean_time_markdown) == (2.0, 3.0)
    assert (row.speed_ratio, row.faster_method) == (1.5, "plain")
    empty = C.time_stats(metrics.filter("file < 0")).first()
    assert empty.mean_time_plain == 0 and empty.speed_ratio is None


def test_precision_counts_all_files(metrics):
    rows = {r.method: r for r in C.precision_stats(metrics).collect()}
    assert (rows["plain"].n_loads, rows["plain"].load_rate) == (2, 50.0)
    assert rows["plain"].mean_addresses_found == 3 / 4
    assert rows["markdown"].n_loads == 1


def test_histogram_and_typical_level(metrics):
    rows = {r.method: r for r in C.difficulty_histogram(metrics).collect()}
    assert (rows["markdown"].BAJA, rows["markdown"].MEDIA, rows["markdown"].ALTA) == (2, 0, 1)
    later = C.difficulty_histogram(metrics.withColumn("run_order", -F.col("file"))).collect()
    markdown = next(r for r in later if r.method == "markdown")
    assert (markdown.first_level, markdown.modal_level) == ("ALTA", "BAJA")


def test_summary_is_text(metrics):
    rows = [tuple(r) for r in C.method_summary(metrics).collect()]
    assert [r[0] for r in rows] == list(P.SUMMARY_METRICS)
    assert rows[0][1:] == ("2.000", "3.000") and rows[1][1:] == ("50.0%", f"{100 / 3:.1f}%")


def test_rounding_follows_the_exact_value(spark):
    values = [0.125, 2.675, 1234.5, 0.5, 1.005, 99.995, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in df.select(C._fixed(F.col("v"), 2).alias("t")).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_winners(metrics):
    row = C.method_winners(metrics).first()
    assert (row.speed_winner, row.precision_winner, row.semantic_winner) == ("plain", "plain", "markdown")
    assert row.regex_winner == "plain" and row.speed_ratio == 1.5
    same = metrics.withColumn("addresses_found", F.lit(1))
    assert C.method_winners(same).first().precision_winner == P.TIE


def test_detail_pairs_by_file(metrics):
    methods = C.Methods("plain", "markdown")
    df = C.method_detail(metrics, methods, prefixes=("a", "b"))
    assert df.columns[:3] == ["archivo", "a_tiempo", "a_load"] and len(df.columns) == 13
    assert sorted(r.archivo for r in df.collect()) == [0, 1, 2]


@pytest.mark.parametrize("times", [[1.0, 2.0, 3.0, 11.0], [5.0, 5.0], [0.1 * i for i in range(37)]])
def test_time_histogram(spark, times):
    df = spark.createDataFrame([("plain", True, t) for t in times] + [("plain", False, 99.0)],
                               "method string, success boolean, elapsed double")
    rows = sorted(C.time_histogram(df).collect(), key=lambda r: r.bin)
    low, high = (min(times), max(times)) if min(times) < max(times) else (times[0] - 0.5, times[0] + 0.5)
    edges = [low + i * (high - low) / 10 for i in range(11)]
    expected = [
        sum(edges[i] <= t and (t < edges[i + 1] or i == 9) for t in times) for i in range(10)
    ]
    assert [r.n for r in rows] == expected and sum(expected) == len(times)
    assert all(math.isclose(r.bin_start, edges[r.bin]) for r in rows)


def test_rendering(spark):
    page = (
        "<head><title>t</title><style>p{}</style></head><body><!-- no --><h2>A &amp; B</h2>"
        "<ul><li>one</li><li>two</li></ul><p>x <b>bold</b>\n y<br>z</p><script>1</script></body>"
    )
    df = spark.createDataFrame([(page,)], "h string")
    row = df.select(html_to_plain(F.col("h")).alias("p"), html_to_markdown(F.col("h")).alias("m")).first()
    assert row.p == "A & B\none\ntwo\nx bold y\nz"
    assert row.m == "## A & B\n\n- one\n\n- two\n\nx **bold** y\nz"


def test_entities_are_read_once(spark):
    cases = {
        "a &amp;lt; b &lt;i&gt;": "a &lt; b <i>", "&#8217;&#x2019;&mdash;&eacute;&Eacute;&apos;": "’’—éÉ'",
        "&#128;&#x80;&#0;&#xD800;&#99999999;": "€€���", "AT&T &unknown; &; &#; &amp": "AT&T &unknown; &; &#; &amp",
        "a&nbsp;b&#160;c": "a b c", "&#x1F600;": "😀",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, h string")
    got = df.orderBy("i").select(html_to_plain(F.col("h")).alias("t")).collect()
    assert [r.t for r in got] == list(cases.values())
    for given, expected in cases.items():
        if "nbsp" not in given and "&amp" != given[-4:]:
            assert html.unescape(given) == expected


def test_hidden_parts_and_lists_take_linear_time(spark):
    slow = {
        "comments": "<!-- x " * 15_000, "one closed": "<!-- x " * 15_000 + "--> left", "scripts": "<script> " * 12_000,
        "tags": "<a " * 40_000, "closers": "</script " * 12_000, "breaks": "\n" * 100_000, "spaces": " " * 100_000,
        "entities": "&amp;" * 20_000,
    }
    for name, text in {"first": "x", **slow}.items():
        df = spark.createDataFrame([(text,)], "h string")
        start = time.perf_counter()
        counts = markdown_counts(F.col("h"), F.lit(True))["markdown_lists"]
        row = df.select(html_to_markdown(F.col("h")).alias("m"), counts.alias("n")).first()
        assert name == "first" or time.perf_counter() - start < 4, name
        assert row.n == 0 and (name != "one closed" or row.m == "left")


def test_list_items_are_counted_as_one_by_one(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("-*+ \n\t\x85ax", k=rng.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    got = df.select(markdown_counts(F.col("t"), F.lit(True))["markdown_lists"].alias("n")).collect()
    assert [r.n for r in got] == [len(re.findall(P.MARKDOWN_LIST.text, t, re.M)) for t in texts]


def _texts(n: int, parts: list[str]) -> list[str]:
    """Random texts of such parts."""
    draw = random.Random(7)
    return ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(n)]


def test_faster_metrics_agree_with_their_patterns(spark):
    """the forms that are searched count what the patterns count."""
    parts = ["- ", "-", "*", "+\t", "\n", "\n\n", " ", "\t", "\r\n", " ", "#", "[", "`", "x", "Load ", "LOAD\n", "12",
             "[Load Number - 7]", "load number: 9", "Sat ", "ſun  ", "FRı", "tue\n", "Man ", "Mon", "01/02/2024", "1/2/2024"]
    rows = [(t,) for t in _texts(1500, parts)]
    text = F.col("text")
    marks = Q.markdown_counts(text, F.lit(True))
    got = spark.createDataFrame(rows, "text string").select(
        "text", Q.load_number(text).alias("load"), Q.count_dates(text).alias("n"), Q.dates(text).alias("dates"),
        marks["markdown_elements"].alias("elements"), marks["markdown_lists"].alias("lists"),
    )
    for row in got.collect():
        t = row["text"]
        loads = [m for p in P.LOAD_NUMBER_BY_PRIORITY if (m := re.search(p.text, t, re.IGNORECASE))]
        dates = re.findall(P.WEEKDAY_DATE.text, t, re.IGNORECASE)
        assert row["load"] == (loads[0][1] if loads else P.LOAD_NUMBER_MISSING), repr(t)
        assert (row["n"], row["dates"]) == (len(dates), [" ".join(d) for d in dates]), repr(t)
        assert row["elements"] == sum(t.count(mark) for mark in P.MARKDOWN_ELEMENTS), repr(t)
        assert row["lists"] == len(re.findall(P.MARKDOWN_LIST.text, t, re.MULTILINE)), repr(t)


def test_metrics_search_each_text_a_few_times(spark):
    """no copy of the text per mark, and no rule on its white space."""
    docs = spark.createDataFrame([("a", PLAIN, "- x")], "file string, method string, text string")
    metrics = C.method_metrics(docs).select("load_number", "markdown_elements", "markdown_lists")
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan and "regexp_replace" not in plan
