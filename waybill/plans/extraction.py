"""Queries: normalisation and field extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.datetimes import combine_datetime as iso_datetime
from waybill.functions.fields import BROKER_FIELDS, CARRIER_FIELDS, STOP_ATTRIBUTES, emails
from waybill.functions.normalize import normalize_strings as clean_strings
from waybill.functions.normalize import normalize_text as clean_text
from waybill.operators.extract import (
    count_stops,
    extract_all_stops,
    extract_loads,
    extract_stops,
    typed_stops,
)
from waybill.operators.extract import typed_loads as as_typed
from waybill.operators.ingest import extract_new_texts
from waybill.plans.catalog import query, table, texts
from waybill.plans.load_docs import for_duckdb, load_docs, long_stops_sql, wide_rows_sql
from waybill.sources.files import shared_folder, stream_packed_texts
from waybill.sources.schema import EXTRACTION_FIELDS, PROCESSED_AT
from waybill.sources.sinks import write_loads as replace_loads
from waybill.sources.sinks import write_packed_texts

STORED = tuple(name for name in EXTRACTION_FIELDS if name != PROCESSED_AT)
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}]"
_BREAK = r"[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_NO_MARKERS = "3"


def _re2_chain(column: str, *rules: tuple[str, str]) -> str:
    for pattern, replacement in rules:
        replacement = replacement.replace("\n", "' || chr(10) || '")
        column = f"regexp_replace({column}, '{pattern}', '{replacement}', 'g')"
    return column


# The line-join rule looks behind, which RE2 cannot: its neighbours are captured instead,
# in two passes because matches may not share a character.
_JOIN = (r"([\p{L}\p{N}_])\n([A-Z0-9])", r"\1 \2")


@query(
    "SELECT doc_id, "
    + _re2_chain(
        "coalesce(text, '')",
        (r"\*{2,}", ""),
        (r"(?i)PickUp\b", "Pickup"),
        (r"(?i)Del\.\s*Date", "Delivery Date"),
        (r"(?i)Miami Lake,s", "Miami Lakes"),
        (r"[ \t\x{a0}]+", " "),
        (r"\r\n?", "\n"),
        (r"\n{3,}", "\n\n"),
        _JOIN,
        _JOIN,
        (f"{_SPACE}*{_BREAK}{_SPACE}*", "\n"),
        (f"^{_SPACE}+|{_SPACE}+$", ""),
    )
    + " AS text FROM documents"
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def _strings_sql(clean: str) -> str:
    columns = ", ".join(f"{clean.format(c)} AS {c}" for c in ("text", "lang", "source"))
    return f"SELECT doc_id, {columns}, n_chars FROM documents"


@query(_strings_sql("trim(lower({}))"))
def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(table(spark, sf_dir, "documents"))


@query(_strings_sql("trim({})"))
def normalize_strings_case_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(table(spark, sf_dir, "documents"), case_sensitive=True)


def _loads(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    docs = load_docs(spark, sf_dir)
    return extract_loads(docs, keep=("order_key", "source_file")).select("order_key", *fields)


def _rows_sql(*fields: str) -> str:
    return for_duckdb(wide_rows_sql(fields))


def _register_fields(name: str, *fields: str) -> None:
    query(_rows_sql(*fields), name)(lambda spark, sf_dir: _loads(spark, sf_dir, *fields))


_register_fields("extract_loads_wide", "source_file", *STORED)
_register_fields("extract_pay", "loadConfirmationNumber", "totalCarrierPay")
_register_fields("extract_broker", *BROKER_FIELDS)
_register_fields("extract_carrier", *CARRIER_FIELDS)
_register_fields("extract_pickups", *[f for f in STORED if f.startswith("pickup_")])
_register_fields("extract_deliveries", *[f for f in STORED if f.startswith("delivery_")])


def _typed_sql() -> str:
    columns = []
    for name in ("source_file", *STORED):
        value = f"nullif({name}, '')"
        if name == "totalCarrierPay":
            value = f"CAST({value} AS DOUBLE)"
        elif "_datetime_" in name:
            value = f"CAST({value} AS TIMESTAMP)"
        columns.append(f"{value} AS {name}")
    return f"SELECT order_key, {', '.join(columns)} FROM ({_rows_sql('source_file', *STORED)}) w"


@query(_typed_sql())
def typed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = as_typed(_loads(spark, sf_dir, "source_file", *STORED))
    return loads.withColumn("totalCarrierPay", F.col("totalCarrierPay").cast("double"))


@query(for_duckdb(long_stops_sql()))
def stops_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_stops(load_docs(spark, sf_dir), keep=("order_key",))


@query(for_duckdb(long_stops_sql(_NO_MARKERS)))
def stops_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_stops(load_docs(spark, sf_dir, style=_NO_MARKERS), keep=("order_key",))


@query(
    for_duckdb(
        "SELECT o_orderkey AS order_key, coalesce(n_pickup, 0) AS n_pickup, "
        "coalesce(n_delivery, 0) AS n_delivery, "
        "coalesce(n_pickup, 0) > 3 AS pickup_overflow, "
        "coalesce(n_delivery, 0) > 3 AS delivery_overflow FROM {orders} LEFT JOIN ("
        "SELECT order_key, count(*) FILTER (WHERE stop_type = 'pickup') AS n_pickup, "
        "count(*) FILTER (WHERE stop_type = 'delivery') AS n_delivery "
        f"FROM ({long_stops_sql()}) s GROUP BY order_key) c ON c.order_key = o_orderkey"
    )
)
def stops_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_stops(load_docs(spark, sf_dir), keep=("order_key",))


# A stop as one text: its attributes in order, blanks and times as the typed view has them.
_STOP_TEXT_SQL = " || '|' || ".join(
    f"coalesce(nullif({name}, ''), '-')" for name in STOP_ATTRIBUTES[:5]
) + "".join(
    f" || '|' || coalesce(replace(nullif({name}, ''), 'T', ' '), '-')" for name in STOP_ATTRIBUTES[5:]
)


@query(
    for_duckdb(
        "SELECT o_orderkey AS order_key, coalesce(pickups, '') AS pickups, "
        "coalesce(deliveries, '') AS deliveries, CAST(coalesce(n_pickup, 0) AS INT) AS n_pickup, "
        "CAST(coalesce(n_delivery, 0) AS INT) AS n_delivery, "
        "coalesce(n_pickup, 0) > 3 AS pickup_overflow, coalesce(n_delivery, 0) > 3 AS delivery_overflow "
        "FROM {orders} LEFT JOIN (SELECT order_key, "
        f"string_agg({_STOP_TEXT_SQL}, ';' ORDER BY stop_no) FILTER (WHERE stop_type = 'pickup') AS pickups, "
        f"string_agg({_STOP_TEXT_SQL}, ';' ORDER BY stop_no) FILTER (WHERE stop_type = 'delivery') AS deliveries, "
        "count(*) FILTER (WHERE stop_type = 'pickup') AS n_pickup, "
        "count(*) FILTER (WHERE stop_type = 'delivery') AS n_delivery "
        f"FROM ({long_stops_sql()}) s GROUP BY order_key) c ON c.order_key = o_orderkey"
    )
)
def stops_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stop of a document in its own row, none left out."""
    stops = typed_stops(extract_all_stops(load_docs(spark, sf_dir), keep=("order_key",)))

    def shown(name: str) -> Column:
        def text(stop: Column) -> Column:
            return F.concat_ws("|", *[F.coalesce(stop[n].cast("string"), F.lit("-")) for n in STOP_ATTRIBUTES])

        return F.array_join(F.transform(name, text), ";")

    return stops.withColumns({name: shown(name) for name in ("pickups", "deliveries")})


# Line number and order pick how date and time are written: 1 short, 2 with seconds, then
# month 13, 30 February, a two-digit year, hour 24, no time; 8 to 11 with AM or PM, midnight
# and noon among them, with and without seconds; then a trailing line break, a leading space,
# and hour 13 with PM.
_DATE_TIMES_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE style
    WHEN 3 THEN '13/' || d || '/' || y WHEN 4 THEN '2/30/' || y
    WHEN 5 THEN m || '/' || d || '/' || substr(y, 3, 2)
    WHEN 2 THEN lpad(m, 2, '0') || '/' || lpad(d, 2, '0') || '/' || y
    ELSE m || '/' || d || '/' || y END AS date_text,
  CASE style
    WHEN 2 THEN lpad(h, 2, '0') || ':' || lpad(mi, 2, '0') || ':' || lpad(s, 2, '0')
    WHEN 6 THEN '24:' || mi WHEN 7 THEN ''
    WHEN 8 THEN h12 || ':' || mi || ' ' || half
    WHEN 9 THEN lpad(h12, 2, '0') || ':' || lpad(mi, 2, '0') || ':' || lpad(s, 2, '0') || '  ' || lower(half)
    WHEN 10 THEN '12:' || mi || ' AM' WHEN 11 THEN '12:' || mi || ':' || s || ' pm'
    WHEN 12 THEN h || ':' || mi || chr(10) WHEN 13 THEN ' ' || h || ':' || mi
    WHEN 14 THEN '13:' || mi || ' PM'
    ELSE h || ':' || mi END AS time_text,
  CASE WHEN style IN (1, 2, 8, 9, 10, 11, 13) THEN
    CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T'
    || CASE style WHEN 10 THEN '00' WHEN 11 THEN '12' ELSE lpad(h, 2, '0') END || ':'
    || lpad(mi, 2, '0') || ':' || CASE WHEN style IN (2, 9, 11) THEN lpad(s, 2, '0') ELSE '00' END
  ELSE '' END AS iso
FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate,
    l_linenumber + 7 * (l_orderkey % 2) AS style,
    CAST(month(l_shipdate) AS STRING) AS m, CAST(day(l_shipdate) AS STRING) AS d,
    CAST(year(l_shipdate) AS STRING) AS y, CAST(l_partkey % 24 AS STRING) AS h,
    CAST((l_partkey + 11) % 12 + 1 AS STRING) AS h12,
    CASE WHEN l_partkey % 24 >= 12 THEN 'PM' ELSE 'AM' END AS half,
    CAST(l_suppkey % 60 AS STRING) AS mi, CAST(l_partkey % 60 AS STRING) AS s
  FROM {lineitem}
) t
"""


@query(for_duckdb(_DATE_TIMES_SQL))
def combine_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_DATE_TIMES_SQL, lineitem=texts(spark, sf_dir, "lineitem"))
    iso = iso_datetime(F.col("date_text"), F.col("time_text"))
    return lines.drop("iso").withColumn("iso", iso)


@query(
    r"SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all("
    r"coalesce(text, ''), '[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+'))), '; '), '') "
    r"AS emails FROM documents"
)
def emails_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents")
    return documents.select("doc_id", emails(F.coalesce("text", F.lit(""))).alias("emails"))


@query(
    "SELECT source_file, * EXCLUDE (order_key, source_file) "
    f"FROM ({_rows_sql('source_file', *STORED)}) w"
)
def write_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "loads")
    replace_loads(extract_loads(load_docs(spark, sf_dir)), path=path)
    return spark.read.parquet(path).drop(PROCESSED_AT)


_UNREADABLE_EVERY = 17


@query(
    for_duckdb(
        f"SELECT CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS run, o_orderstatus AS source, "
        f"CASE WHEN order_key % {_UNREADABLE_EVERY} = 0 THEN 'failed' ELSE 'ok' END AS status, "
        + ", ".join(
            f"CASE WHEN order_key % {_UNREADABLE_EVERY} = 0 THEN '' ELSE {name} END AS {name}"
            for name in STORED
        )
        + f" FROM ({wide_rows_sql()}) w JOIN {{orders}} o ON o.o_orderkey = w.order_key"
    )
)
def load_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed text files straight to the load table, in two runs of one stream: the second extracts
    only the files that came since; unreadable texts are set aside among good ones of their file."""
    names = ("packed", "extracted", "extract-progress")
    texts_at, out, checkpoint = (shared_folder(spark, name) for name in names)
    # A byte that starts no character.
    bad = F.when(F.col("order_key") % _UNREADABLE_EVERY == 0, F.unhex(F.lit("FF")).cast("string"))
    text = F.concat("text", F.coalesce(bad, F.lit("")))
    docs = load_docs(spark, sf_dir).select("source", text.alias("text"))
    for run, part in ((1, F.col("source") == "O"), (2, F.col("source") != "O")):
        write_packed_texts(docs.filter(part), texts_at, "source", mode="append")
        arrived = stream_packed_texts(spark, texts_at, partitions="source string")
        extract_new_texts(arrived.withColumn("run", F.lit(run)), out, checkpoint)
    return spark.read.parquet(out).select("run", "source", "status", *STORED)
