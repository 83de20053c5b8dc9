"""Queries: text quality and the comparison of two text methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import quality as Q
from waybill.functions.html import markdown_sql, plain_sql
from waybill.functions.patterns import LOAD_NUMBER_MISSING, SUMMARY_COLUMN, SUMMARY_METRICS
from waybill.operators import compare as C
from waybill.operators.documents import MARKDOWN, PLAIN, render_methods
from waybill.plans.catalog import query, table, texts
from waybill.plans.load_docs import for_duckdb, load_docs, numbered_stops_sql
from waybill.sources.files import shared_folder
from waybill.sources.sinks import write_csv

FAILED_EVERY = 5


# ---- what a text holds, known from the rows behind the documents ----


def _docs_sql(columns: str) -> str:
    """One row per order, with its stops aggregated as ``list`` columns."""
    return for_duckdb(
        "SELECT o_orderkey AS order_key, "
        + columns
        + " FROM {orders} LEFT JOIN (SELECT order_key, count(*) AS n, "
        "string_agg(strftime(ship, '%a %m/%d/%Y'), '; ' ORDER BY line_no) AS dates, "
        "string_agg(from_time || ' - ' || to_time, '; ' ORDER BY line_no) AS windows, "
        "string_agg(p_city || ', ' || p_state || ' ' || p_zip, '; ' ORDER BY line_no) AS places, "
        "min(supp) AS carrier FROM ("
        + numbered_stops_sql()
        + ") s GROUP BY order_key) x ON x.order_key = o_orderkey"
    )


@query(
    for_duckdb(
        f"SELECT o_orderkey AS order_key, CASE o_orderkey % 8 WHEN 3 THEN '{LOAD_NUMBER_MISSING}' "
        "ELSE CAST(o_orderkey AS VARCHAR) END AS load_number FROM {orders}"
    )
)
def load_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_docs(spark, sf_dir)
    return docs.select("order_key", Q.load_number(F.col("text")).alias("load_number"))


@query(_docs_sql("coalesce(n, 0) AS n_dates, coalesce(dates, '') AS dates"))
def dates_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return load_docs(spark, sf_dir).select(
        "order_key",
        Q.count_dates(text).alias("n_dates"),
        F.array_join(Q.dates(text), "; ").alias("dates"),
    )


@query(_docs_sql("coalesce(n, 0) AS n_windows, coalesce(windows, '') AS windows"))
def windows_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return load_docs(spark, sf_dir).select(
        "order_key",
        Q.count_time_windows(text).alias("n_windows"),
        F.array_join(Q.time_windows(text), "; ").alias("windows"),
    )


# The schedule's places, then the broker's (read as "s" behind the known typo), then the
# carrier's if the document has one.
_CARRIER_PLACE = (
    "'; SAN ' || translate(CAST(carrier % 1000 AS VARCHAR), '0123456789', 'ABCDEFGHIJ') || ', ' "
    "|| substr('FLGATXMENCSCVAAL', CAST(1 + 2 * (carrier % 8) AS INT), 2) || ' ' "
    "|| CAST(10000 + carrier * 41 % 90000 AS VARCHAR)"
)


@query(
    _docs_sql(
        "coalesce(n, 0) + 1 + CASE WHEN carrier IS NULL THEN 0 ELSE 1 END AS n_addresses, "
        "coalesce(places || '; ', '') || CASE o_orderkey % 8 WHEN 5 THEN 's' ELSE 'Miami Lakes' END "
        f"|| ', FL 40417' || coalesce({_CARRIER_PLACE}, '') AS addresses"
    )
)
def addresses_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return load_docs(spark, sf_dir).select(
        "order_key",
        Q.count_addresses(text).alias("n_addresses"),
        F.array_join(Q.addresses(text), "; ").alias("addresses"),
    )


@query(
    "SELECT method, n_files, n_loads, round(n_loads * 100.0 / n_files, 6) AS load_rate, "
    "round(n_stops / n_files, 6) AS mean_dates_found, "
    "round(n_stops / n_files, 6) AS mean_time_windows_found, "
    "round(n_addresses / n_files, 6) AS mean_addresses_found FROM ("
    "SELECT method, count(*) AS n_files, count(*) FILTER (WHERE ok AND order_key % 8 <> 3) AS n_loads, "
    "CAST(sum(CASE WHEN ok THEN n ELSE 0 END) AS DOUBLE) AS n_stops, "
    "CAST(sum(CASE WHEN ok THEN n_addresses ELSE 0 END) AS DOUBLE) AS n_addresses FROM ("
    f"SELECT *, method = '{PLAIN}' OR order_key % {FAILED_EVERY} <> 0 AS ok FROM ("
    + _docs_sql(
        "coalesce(n, 0) AS n, coalesce(n, 0) + 1 + CASE WHEN carrier IS NULL THEN 0 ELSE 1 END "
        "AS n_addresses"
    )
    + f") d CROSS JOIN (VALUES ('{PLAIN}'), ('{MARKDOWN}')) m(method)) e GROUP BY method) f"
)
def precision_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 5th document fails under the Markdown method and counts as an empty text."""
    docs = load_docs(spark, sf_dir)
    markdown = F.when(F.col("order_key") % FAILED_EVERY != 0, F.col("text")).otherwise("")
    both = docs.select(
        F.col("order_key").alias("file"),
        F.inline(
            F.array(
                F.struct(F.lit(PLAIN).alias("method"), F.col("text").alias("text")),
                F.struct(F.lit(MARKDOWN).alias("method"), markdown.alias("text")),
            )
        ),
    ).withColumn("run_order", F.col("file"))
    stats = C.precision_stats(C.method_metrics(both, keep=("file", "run_order")))
    return _rounded(stats)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: sums of doubles depend on the order of the rows."""
    return df.select(
        *[F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]
    )


# ---- the same metrics on rendered pages, repeated with RE2 patterns ----

_TEXTS_SQL = (
    f"SELECT page_id, '{PLAIN}' AS method, {plain_sql('html')} AS text FROM pages "
    f"UNION ALL SELECT page_id, '{MARKDOWN}', {markdown_sql('html')} FROM pages"
)
_BLANK_LINE = r"^[\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}]*$"


def _lines_sql(text: str) -> str:
    return (
        f"CAST(len(string_split({text}, chr(10))) AS INTEGER) AS total_lines, "
        f"CAST(len(list_filter(string_split({text}, chr(10)), lambda x: "
        f"regexp_matches(x, '{_BLANK_LINE}'))) AS INTEGER) AS blank_lines"
    )


def _if_markdown(value: str) -> str:
    return f"CASE WHEN method = '{MARKDOWN}' THEN {value} ELSE 0 END"


def _found(pattern: str) -> str:
    return _if_markdown(f"CAST(len(regexp_extract_all(text, '{pattern}')) AS INTEGER)")


_METRICS_SQL = (
    "SELECT *, CASE WHEN regex_parsing_difficulty > 30 THEN 'ALTA' "
    "WHEN regex_parsing_difficulty > 10 THEN 'MEDIA' ELSE 'BAJA' END AS parsing_difficulty FROM ("
    "SELECT *, "
    + _if_markdown(
        "markdown_headers * 5 + markdown_lists * 2 + least(empty_line_ratio * 50, 20.0::DOUBLE)"
    )
    + "::DOUBLE AS semantic_structure_score, "
    + _if_markdown("least(markdown_elements * 0.05::DOUBLE, 50.0::DOUBLE)")
    + "::DOUBLE AS regex_parsing_difficulty FROM ("
    "SELECT *, blank_lines / total_lines AS empty_line_ratio FROM ("
    "SELECT page_id, method, text <> '' AS success, CAST(length(text) AS INTEGER) AS total_length, "
    + _lines_sql("text")
    + f", {_found(r'[#*\[\]`]')} AS markdown_elements, {_found(r'(?m)^#+\s')} AS markdown_headers, "
    + _found(r"(?m)^\s*[-*+]\s")
    + f" AS markdown_lists FROM ({_TEXTS_SQL}) t) a) b) c"
)


def _page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = texts(spark, sf_dir, "pages")
    rendered = render_methods(pages, "html", [F.col("page_id").alias("file"), "url"])
    return C.method_metrics(rendered, keep=("file", "url")).withColumn("run_order", F.col("file"))


@query(
    "SELECT page_id AS file, method, markdown_elements, markdown_headers, markdown_lists "
    f"FROM ({_METRICS_SQL}) m"
)
def markdown_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_metrics(spark, sf_dir).select(
        "file", "method", "markdown_elements", "markdown_headers", "markdown_lists"
    )


@query(
    "SELECT doc_id, total_lines, blank_lines, round(blank_lines / total_lines, 6) "
    "AS empty_line_ratio, total_length FROM (SELECT doc_id, "
    "CAST(length(coalesce(text, '')) AS INTEGER) AS total_length, "
    f"{_lines_sql(chr(34) + 'text' + chr(34))} FROM documents) d"
)
def line_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return _rounded(
        texts(spark, sf_dir, "documents").select(
            "doc_id",
            Q.total_lines(text).alias("total_lines"),
            Q.blank_lines(text).alias("blank_lines"),
            Q.empty_line_ratio(text).alias("empty_line_ratio"),
            F.length(text).alias("total_length"),
        )
    )


@query(
    "SELECT page_id AS file, method, round(semantic_structure_score, 6) AS semantic_structure_score, "
    "round(regex_parsing_difficulty, 6) AS regex_parsing_difficulty, parsing_difficulty "
    f"FROM ({_METRICS_SQL}) m"
)
def semantic_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        _page_metrics(spark, sf_dir).select(
            "file", "method", "semantic_structure_score", "regex_parsing_difficulty",
            "parsing_difficulty",
        )
    )


@query(
    "SELECT method, round(avg(semantic_structure_score), 6) AS mean_semantic_structure_score, "
    "round(avg(regex_parsing_difficulty), 6) AS mean_regex_parsing_difficulty, "
    f"round(avg(markdown_headers), 6) AS mean_markdown_headers FROM ({_METRICS_SQL}) m GROUP BY method"
)
def structure_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(C.structure_stats(_page_metrics(spark, sf_dir)))


_LEVELS_SQL = (
    "SELECT method, count(*) FILTER (WHERE parsing_difficulty = 'BAJA') AS BAJA, "
    "count(*) FILTER (WHERE parsing_difficulty = 'MEDIA') AS MEDIA, "
    "count(*) FILTER (WHERE parsing_difficulty = 'ALTA') AS ALTA, "
    f"arg_min(parsing_difficulty, page_id) AS first_level FROM ({_METRICS_SQL}) m GROUP BY method"
)


@query(
    "SELECT *, CASE greatest(BAJA, MEDIA, ALTA) WHEN BAJA THEN 'BAJA' WHEN MEDIA THEN 'MEDIA' "
    f"ELSE 'ALTA' END AS modal_level FROM ({_LEVELS_SQL}) l"
)
def difficulty_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.difficulty_histogram(_page_metrics(spark, sf_dir))


# ---- with elapsed times: event 2n is page n as plain text, 2n + 1 as Markdown ----

_TIMED_SQL = (
    f"SELECT m.*, coalesce(e.value, 0.0) AS elapsed FROM ({_METRICS_SQL}) m LEFT JOIN events e "
    f"ON e.event_id = 2 * m.page_id + CASE WHEN m.method = '{MARKDOWN}' THEN 1 ELSE 0 END"
)


def _timed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.expr("event_id div 2").alias("file"), _event_method(), F.col("value").alias("elapsed")
    )
    return _page_metrics(spark, sf_dir).join(events, ["file", "method"], "left").fillna(
        0.0, ["elapsed"]
    )


def _event_method():
    return F.when(F.col("event_id") % 2 == 0, PLAIN).otherwise(MARKDOWN).alias("method")


def _side(method: str, value: str) -> str:
    return f"{value} FILTER (WHERE method = '{method}')"


_DETAIL = (
    ("elapsed", "tiempo"),
    (f"'{LOAD_NUMBER_MISSING}'", "load"),
    ("0", "fechas"),
    ("0", "direcciones"),
    ("semantic_structure_score", "estructura_semantica"),
    ("regex_parsing_difficulty", "regex_dificultad"),
)


@query(
    "SELECT page_id AS archivo, "
    + ", ".join(
        f"round({side}.{value}, 6) AS {label}_{name}" if "." not in value and value[0] not in "'0"
        else f"{value} AS {label}_{name}"
        for side, label in (("p", PLAIN), ("m", MARKDOWN))
        for value, name in _DETAIL
    )
    + f" FROM (SELECT * FROM ({_TIMED_SQL}) a WHERE method = '{PLAIN}') p "
    f"JOIN (SELECT * FROM ({_TIMED_SQL}) b WHERE method = '{MARKDOWN}') m USING (page_id)"
)
def method_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(C.method_detail(_timed_metrics(spark, sf_dir)))


_MEANS_SQL = (
    "SELECT method, coalesce(avg(elapsed) FILTER (WHERE success), 0) AS mean_time, "
    "avg(semantic_structure_score) AS score, avg(regex_parsing_difficulty) AS hard, "
    "avg(markdown_headers) AS headers, arg_min(parsing_difficulty, page_id) AS first_level "
    f"FROM ({_TIMED_SQL}) t GROUP BY method"
)


def _summary_sql() -> str:
    values = (
        "printf('%.3f', mean_time)", "'0.0%'", "'0.00'", "'0.00'", "printf('%.2f', score)",
        "first_level", "printf('%.2f', headers)",
    )
    rows = [
        f"SELECT '{metric}' AS \"Métrica\", {_side(PLAIN, f'max({value})')} AS plain, "
        f"{_side(MARKDOWN, f'max({value})')} AS markdown FROM means"
        for metric, value in zip(SUMMARY_METRICS, values)
    ]
    return f"WITH means AS ({_MEANS_SQL}) " + " UNION ALL ".join(rows)


@query(_summary_sql())
def method_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.method_summary(_timed_metrics(spark, sf_dir))


@query(
    f"WITH means AS ({_MEANS_SQL}) SELECT "
    "CASE WHEN p.mean_time < m.mean_time THEN 'plain' ELSE 'markdown' END AS speed_winner, "
    "round(m.mean_time / nullif(p.mean_time, 0), 6) AS speed_ratio, 'Empate' AS precision_winner, "
    "CASE WHEN m.score > p.score THEN 'markdown' ELSE 'plain' END AS semantic_winner, "
    "CASE WHEN p.hard < m.hard THEN 'plain' ELSE 'markdown' END AS regex_winner, "
    "CASE WHEN p.mean_time > 0 AND m.mean_time > 0 AND m.score > 20 THEN 'markdown' END AS for_structure, "
    "CASE WHEN p.mean_time > 0 AND m.mean_time > 0 AND m.score > 20 THEN 'plain' END AS for_speed, "
    "p.mean_time > 0 AND m.mean_time > 0 AND m.score <= 20 AS either "
    "FROM (SELECT * FROM means WHERE method = 'plain') p, "
    "(SELECT * FROM means WHERE method = 'markdown') m"
)
def method_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(C.method_winners(_timed_metrics(spark, sf_dir)))


# ---- the same on load confirmations: every 5th fails under the Markdown method ----

_LOADS_SQL = (
    f"SELECT *, order_key % {FAILED_EVERY} <> 0 AS ok, CAST(1 + order_key % 7 AS DOUBLE) AS plain_time, "
    "CAST(2 + order_key % 5 AS DOUBLE) AS markdown_time, CASE order_key % 8 WHEN 3 THEN "
    f"'{LOAD_NUMBER_MISSING}' ELSE CAST(order_key AS VARCHAR) END AS load FROM ("
    + _docs_sql(
        "coalesce(n, 0) AS n, coalesce(n, 0) + 1 + CASE WHEN carrier IS NULL THEN 0 ELSE 1 END AS n_addresses"
    )
    + ") d"
)


def _load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("order_key")
    docs = load_docs(spark, sf_dir).select(
        key.alias("file"),
        F.inline(
            F.array(
                F.struct(F.lit(PLAIN).alias("method"), "text", (1 + key % 7).cast("double").alias("elapsed")),
                F.struct(
                    F.lit(MARKDOWN).alias("method"),
                    F.when(key % FAILED_EVERY != 0, F.col("text")).alias("text"),
                    (2 + key % 5).cast("double").alias("elapsed"),
                ),
            )
        ),
    )
    return C.method_metrics(docs, keep=("file", "elapsed")).withColumn("run_order", F.col("file"))


@query(
    "SELECT order_key AS archivo, plain_time AS plain_tiempo, load AS plain_load, n AS plain_fechas, "
    "n_addresses AS plain_direcciones, markdown_time AS markdown_tiempo, "
    f"CASE WHEN ok THEN load ELSE '{LOAD_NUMBER_MISSING}' END AS markdown_load, "
    "CASE WHEN ok THEN n ELSE 0 END AS markdown_fechas, "
    f"CASE WHEN ok THEN n_addresses ELSE 0 END AS markdown_direcciones FROM ({_LOADS_SQL}) l"
)
def load_method_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = C.method_detail(_load_metrics(spark, sf_dir))
    return detail.select("archivo", *[c for c in detail.columns if c.endswith(("tiempo", "load", "fechas", "direcciones"))])


@query("SELECT archivo, plain_load, markdown_load, plain_fechas, markdown_fechas "
       "FROM (SELECT order_key AS archivo, load AS plain_load, n AS plain_fechas, "
       f"CASE WHEN ok THEN load ELSE '{LOAD_NUMBER_MISSING}' END AS markdown_load, "
       f"CASE WHEN ok THEN n ELSE 0 END AS markdown_fechas FROM ({_LOADS_SQL}) l) d")
def load_detail_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail report, read back from the CSV files it is written to."""
    path = shared_folder(spark, "detail-csv")
    write_csv(C.method_detail(_load_metrics(spark, sf_dir)), path)
    report = spark.read.option("header", True).csv(path)
    return report.select(
        F.col("archivo").cast("long").alias("archivo"), "plain_load", "markdown_load",
        *[F.col(c).cast("long").alias(c) for c in ("plain_fechas", "markdown_fechas")],
    )


_LOAD_MEANS_SQL = (
    f"SELECT method, avg(CASE method WHEN '{PLAIN}' THEN plain_time ELSE markdown_time END) "
    "FILTER (WHERE good) AS mean_time, 100.0 * count(*) FILTER (WHERE good AND order_key % 8 <> 3) / count(*) AS rate, "
    "avg(CASE WHEN good THEN n ELSE 0 END) AS dates, avg(CASE WHEN good THEN n_addresses ELSE 0 END) AS addresses "
    f"FROM (SELECT *, ok OR method = '{PLAIN}' AS good FROM ({_LOADS_SQL}) l "
    f"CROSS JOIN (VALUES ('{PLAIN}'), ('{MARKDOWN}')) m(method)) x GROUP BY method"
)
_LOAD_VALUES = (
    "printf('%.3f', mean_time)", "printf('%.1f', rate) || '%'", "printf('%.2f', dates)", "printf('%.2f', addresses)",
)


@query(
    f"WITH means AS ({_LOAD_MEANS_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{metric}' AS \"Métrica\", {_side(PLAIN, f'max({value})')} AS plain, "
        f"{_side(MARKDOWN, f'max({value})')} AS markdown FROM means"
        for metric, value in zip(SUMMARY_METRICS, _LOAD_VALUES)
    )
)
def load_method_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows on time, load numbers, dates and addresses."""
    summary = C.method_summary(_load_metrics(spark, sf_dir))
    return summary.filter(F.col(SUMMARY_COLUMN).isin(*SUMMARY_METRICS[: len(_LOAD_VALUES)]))


@query(
    f"WITH means AS ({_LOAD_MEANS_SQL}) SELECT "
    "CASE WHEN p.mean_time < m.mean_time THEN 'plain' ELSE 'markdown' END AS speed_winner, "
    "round(m.mean_time / p.mean_time, 6) AS speed_ratio, CASE WHEN abs(p.addresses - m.addresses) < 0.1 "
    "THEN 'Empate' WHEN p.addresses >= m.addresses THEN 'plain' ELSE 'markdown' END AS precision_winner "
    "FROM (SELECT * FROM means WHERE method = 'plain') p, (SELECT * FROM means WHERE method = 'markdown') m"
)
def load_method_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = _rounded(C.method_winners(_load_metrics(spark, sf_dir)))
    return winners.select("speed_winner", "speed_ratio", "precision_winner")


_EVENTS_SQL = (
    "SELECT CASE WHEN event_id % 2 = 0 THEN 'plain' ELSE 'markdown' END AS method, "
    "event_type <> 'error' AS success, value AS elapsed FROM events"
)


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _event_method(), (F.col("event_type") != "error").alias("success"),
        F.col("value").alias("elapsed"),
    )


def _time_columns_sql(method: str) -> str:
    good = f"FILTER (WHERE success AND method = '{method}')"
    return (
        f"count(*) FILTER (WHERE method = '{method}') AS n_files_{method}, "
        f"count(*) {good} AS n_success_{method}, coalesce(sum(elapsed) {good}, 0) "
        f"AS total_time_{method}, coalesce(avg(elapsed) {good}, 0) AS mean_time_{method}"
    )


@query(
    "SELECT * REPLACE (round(total_time_plain, 6) AS total_time_plain, "
    "round(total_time_markdown, 6) AS total_time_markdown, round(mean_time_plain, 6) "
    "AS mean_time_plain, round(mean_time_markdown, 6) AS mean_time_markdown, "
    "round(speed_ratio, 6) AS speed_ratio), "
    "CASE WHEN speed_ratio > 1 THEN 'plain' WHEN speed_ratio IS NOT NULL THEN 'markdown' END "
    "AS faster_method, round(greatest(speed_ratio, 1 / speed_ratio), 6) AS times_faster FROM ("
    "SELECT *, CASE WHEN mean_time_plain > 0 AND mean_time_markdown > 0 "
    "THEN mean_time_markdown / mean_time_plain END AS speed_ratio FROM ("
    f"SELECT {_time_columns_sql('plain')}, {_time_columns_sql('markdown')} FROM ({_EVENTS_SQL}) e) a) b"
)
def time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(C.time_stats(_event_times(spark, sf_dir)))


@query(
    f"WITH t AS (SELECT method, elapsed FROM ({_EVENTS_SQL}) e WHERE success), "
    "r AS (SELECT method, min(elapsed) AS low, (max(elapsed) - min(elapsed)) / 10 AS step "
    "FROM t GROUP BY method) "
    "SELECT r.method, CAST(i AS INTEGER) AS bin, round(low + i * step, 6) AS bin_start, "
    "round(low + (i + 1) * step, 6) AS bin_end, (SELECT count(*) FROM t WHERE t.method = r.method "
    "AND (i = 0 OR t.elapsed >= r.low + i * r.step) "
    "AND (i = 9 OR t.elapsed < r.low + (i + 1) * r.step)) AS n FROM r, range(10) AS g(i)"
)
def time_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(C.time_histogram(_event_times(spark, sf_dir)))
