"""Load-confirmation texts rendered from orders and line items, and the rows behind them.

The given tables hold no such documents, so each order becomes one: its line items are
the stops.  ``o_orderkey % 8`` picks the label style (see ``STYLES``).  The rows a
document must give back come from SQL over the same tables, never from its text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.sources.files import spread
from waybill.sources.schema import TRUTH_FIELDS

STYLES = {
    0: "plain labels",
    1: "bold labels, 'PickUp', 'Del. Date'",
    2: "CRLF line ends, tabs and no-break spaces",
    3: "no stop markers",
    4: "carrier without a fax label: no carrier field can be read",
    5: "broker without fax, city with the known typo",
    6: "times with AM/PM: no window can be read",
    7: "last pickup without zip: the block runs on into the first delivery's zip",
}

# What a stop says, in SQL that Spark and DuckDB both read.
_LETTERS = "'0123456789', 'ABCDEFGHIJ'"
_STATES = "'FLGATXMENCSCVAAL'"
_HOUR = "CAST(6 + (line_no + o_orderkey) % 6 AS INT)"
_TO_HOUR = f"({_HOUR} + 8)"


def _hours(hour: str, rest: str) -> str:
    return f"lpad(CAST({hour} AS STRING), 2, '0') || '{rest}'"


STOP_VALUES = {
    "p_customer": f"'Shipper ' || translate(CAST(supp AS STRING), {_LETTERS})",
    "p_address": "CAST(100 + (supp * 7 + line_no) % 9000 AS STRING) || ' Dock Road'",
    "p_city": f"'Port ' || translate(CAST(supp % 1000 AS STRING), {_LETTERS})",
    "p_state": f"substr({_STATES}, CAST(1 + 2 * (supp % 8) AS INT), 2)",
    "p_zip": "CAST(10000 + (supp * 37 + line_no * 11) % 90000 AS STRING)",
    "d_customer": "'Customer ' || CAST(o_custkey AS STRING)",
    "d_address": "CAST(100 + (o_custkey * 3 + line_no) % 9000 AS STRING) || ' Market Street'",
    "d_city": f"'Town ' || translate(CAST(o_custkey % 1000 AS STRING), {_LETTERS})",
    "d_state": f"substr({_STATES}, CAST(1 + 2 * (o_custkey % 8) AS INT), 2)",
    "d_zip": "CAST(10000 + (o_custkey * 53 + line_no * 13) % 90000 AS STRING)",
    "us_date": "CAST(month(ship) AS STRING) || '/' || CAST(day(ship) AS STRING) || '/' "
               "|| CAST(year(ship) AS STRING)",
    "from_time": _hours(_HOUR, ":00"),
    "to_time": _hours(_TO_HOUR, ":30"),
}
_ISO = {
    "start_iso": "CAST(CAST(ship AS DATE) AS STRING) || 'T' || " + _hours(_HOUR, ":00:00"),
    "end_iso": "CAST(CAST(ship AS DATE) AS STRING) || 'T' || " + _hours(_TO_HOUR, ":30:00"),
}

# What broker, load and carrier sections say.
HEADER_VALUES = {
    "source_file": "'source=' || o_orderstatus || '/order%20' || CAST(o_orderkey AS STRING) "
                   "|| '.txt'",
    "b_name": "'USA Truck Brokers Inc.'",
    "b_phone": "'305-555-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')",
    "b_fax": "'305-556-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')",
    "b_address": "CAST(1000 + o_orderkey % 9000 AS STRING) || ' Quarry Bend Unit ' "
                 "|| CAST(100 + o_orderkey % 900 AS STRING)",
    "b_mail_1": "'desk' || CAST(o_orderkey % 5 AS STRING) || '@example.com'",
    "b_mail_2": "'bills' || CAST(o_orderkey % 3 AS STRING) || '@example.com'",
    "pay": "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING)",
    "c_name": "replace(s_name, '#', ' ')",
    "c_mc": "CAST(100000 + carrier_key AS STRING)",
    "c_address": "CAST(1 + carrier_key % 900 AS STRING) || ' Harbor st #' "
                 "|| CAST(carrier_key AS STRING)",
    "c_city": f"'SAN ' || translate(CAST(carrier_key % 1000 AS STRING), {_LETTERS})",
    "c_state": f"substr({_STATES}, CAST(1 + 2 * (carrier_key % 8) AS INT), 2)",
    "c_zip": "CAST(10000 + carrier_key * 41 % 90000 AS STRING)",
    "c_phone": "'786-555-' || lpad(CAST(carrier_key % 10000 AS STRING), 4, '0')",
    "c_fax": "'786-556-' || lpad(CAST(carrier_key % 10000 AS STRING), 4, '0')",
    "c_contact": f"'Ana ' || translate(CAST(carrier_key % 1000 AS STRING), {_LETTERS}) "
                 "|| ' (night desk'",
}

# Line numbers repeat within an order, so they are reduced to one row each.
LINES_SQL = (
    "SELECT l_orderkey, l_linenumber AS line_no, min(l_shipdate) AS ship, min(l_suppkey) AS supp "
    "FROM {lineitem} GROUP BY l_orderkey, l_linenumber"
)


def _values(values: dict[str, str]) -> str:
    return ",\n  ".join(f"{sql} AS {name}" for name, sql in values.items())


# One row per stop.
STOPS_SQL = (
    f"SELECT o_orderkey AS order_key, line_no, supp, ship,\n  {_values(STOP_VALUES | _ISO)}\n"
    f"FROM ({LINES_SQL}) line JOIN {{orders}} ON o_orderkey = l_orderkey"
)

# One row per order; its carrier is the supplier with the lowest key.
HEADERS_SQL = (
    "SELECT o_orderkey AS order_key, {style} AS style, carrier_key,\n  "
    f"{_values(HEADER_VALUES)}\nFROM {{orders}}\nLEFT JOIN "
    "(SELECT l_orderkey, min(l_suppkey) AS carrier_key FROM {lineitem} GROUP BY l_orderkey) c "
    "ON l_orderkey = o_orderkey\nLEFT JOIN {supplier} ON s_suppkey = carrier_key"
)

STYLE_OF_ORDER = "o_orderkey % 8"


def _headers_sql(style: str) -> str:
    return HEADERS_SQL.replace("{style}", style)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("orders", "lineitem", "supplier")
    }


def _pickup_text(stop: Column, number: Column, last: Column) -> Column:
    style = F.col("style")
    window = F.when(style == 6, F.lit("8:00 AM - 5:00 PM")).otherwise(
        F.concat(stop["from_time"], F.lit(" - "), stop["to_time"])
    )
    marked = F.concat(
        F.lit("Pickup # "), number.cast("string"), F.lit("\nCustomer: "), stop["p_customer"],
        F.lit("\nPickup Date: "), stop["us_date"],
        F.lit("\nAddress #1: "), stop["p_address"], F.lit(" Pickup Time: "), window,
        F.lit("\nCity: "), stop["p_city"], F.lit(", "), stop["p_state"],
        F.when((style == 7) & last, F.lit("")).otherwise(
            F.concat(F.lit("\nZip Code: "), stop["p_zip"])
        ),
    )
    unmarked = F.concat(
        F.lit("Pickup Customer: "), stop["p_customer"],
        F.lit("\nAddress #1: "), stop["p_address"], F.lit(" Pick Time: "), window,
        F.lit("\nCity: "), stop["p_city"], F.lit(", "), stop["p_state"],
        F.lit("\nZip Code: "), stop["p_zip"], F.lit("\nPick Date: "), stop["us_date"],
    )
    return F.when(style == 3, unmarked).otherwise(marked)


def _delivery_text(stop: Column, number: Column) -> Column:
    style = F.col("style")
    window = F.when(style == 6, F.lit("8:00 AM - 5:00 PM")).otherwise(
        F.concat(stop["from_time"], F.lit(" - "), stop["to_time"])
    )
    marked = F.concat(
        F.lit("Delivery # "), number.cast("string"), F.lit("\nCustomer: "), F.col("d_customer"),
        F.lit("\nDelivery Date: "), stop["us_date"],
        F.lit("\nAddress #1: "), stop["d_address"], F.lit(" Delivery Time: "), window,
        F.lit("\nCity: "), F.col("d_city"), F.lit(", "), F.col("d_state"),
        F.lit("\nZip Code: "), stop["d_zip"],
    )
    unmarked = F.concat(
        F.lit("Delivery Customer: "), F.col("d_customer"),
        F.lit("\nAddress #1: "), stop["d_address"], F.lit(" (Time: "), window,
        F.lit(")\nCity: "), F.col("d_city"), F.lit(", "), F.col("d_state"),
        F.lit("\nZip Code: "), stop["d_zip"], F.lit("\nDelivery Date: "), stop["us_date"],
    )
    return F.when(style == 3, unmarked).otherwise(marked)


def _schedule_text(stop: Column) -> Column:
    return F.concat(
        F.date_format(stop["ship"], "EEE MM/dd/yyyy"), F.lit(" from "), stop["from_time"],
        F.lit(" - "), stop["to_time"], F.lit(" "), stop["p_city"], F.lit(", "),
        stop["p_state"], F.lit(" "), stop["p_zip"],
    )


def _load_line() -> Column:
    key = F.col("order_key").cast("string")
    return (
        F.when(F.col("style") == 1, F.concat(F.lit("[Load Number - "), key, F.lit("]")))
        .when(F.col("style") == 6, F.concat(F.lit("Load Number: "), key))
        .when(F.col("style") == 3, F.lit("No number"))
        .otherwise(F.concat(F.lit("Load "), key))
    )


def _broker_text() -> Column:
    style = F.col("style")
    pay_label = F.when(F.col("order_key") % 2 == 0, "Total Carrier Pay: $").otherwise(
        "Total To Pay: $"
    )
    fax = F.when(style == 5, F.lit("")).otherwise(F.concat(F.lit("\nFax: "), F.col("b_fax")))
    city = F.when(style == 5, "Miami Lake,s").otherwise("Miami Lakes")
    return F.concat(
        F.lit("\n\n\nSend Invoice to:\n"), F.col("b_name"), F.lit("\n"), F.col("b_address"),
        F.lit("\n"), city, F.lit(", FL 40417\nTel: "), F.col("b_phone"), fax,
        F.lit("\nEmail: "), F.col("b_mail_1"), F.lit(", "), F.col("b_mail_2"), F.lit(" "),
        F.col("b_mail_1"), F.lit("\n"), pay_label,
        F.format_number(F.col("pay").cast("decimal(18,2)"), 2),
    )


def _carrier_text() -> Column:
    fax = F.when(F.col("style") == 4, F.lit("")).otherwise(
        F.concat(F.lit("\nFax: "), F.col("c_fax"))
    )
    text = F.concat(
        F.lit("\nTrailer VIN Number: V"), F.col("c_mc"), F.lit("\nCarrier "), F.col("c_name"),
        F.lit("\nMC #: "), F.col("c_mc"), F.lit("\nAddress: "), F.col("c_address"),
        F.lit("\nCity: "), F.col("c_city"), F.lit(", "), F.col("c_state"), F.lit(" "),
        F.col("c_zip"), F.lit("\nPhone: "), F.col("c_phone"), fax, F.lit("\nContact: "),
        F.col("c_contact"), F.lit("\nTruck VIN Number: T"), F.col("c_mc"),
    )
    return F.when(F.col("carrier_key").isNotNull(), text).otherwise("")


# Values of a stop that its order alone decides, and those that no document shows.
_OF_ORDER = ("d_customer", "d_city", "d_state")
_SHOWN = {
    **{name: sql for name, sql in STOP_VALUES.items() if name not in _OF_ORDER},
    # The same digits from one formatter.
    "us_date": "date_format(ship, 'M/d/y')",
}


def order_rows(
    spark: SparkSession, sf_dir: str, style: str = STYLE_OF_ORDER, values: dict[str, str] = STOP_VALUES | _ISO
) -> DataFrame:
    """One row per order: header values, what it says of all its deliveries, and its ``stops`` in
    order, each with ``values``.

    Line items are reduced before they are shuffled, so a hot order stays small, and every
    table is read once.
    """
    tables = _tables(spark, sf_dir)
    lines = spark.sql(LINES_SQL, lineitem=tables["lineitem"])
    # One entry per distinct line number of an order.
    lines = lines.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "ship", "supp"))).alias("lines")
    )
    docs = tables["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    docs = docs.withColumn("carrier_key", F.array_min("lines.supp")).join(
        tables["supplier"], F.col("s_suppkey") == F.col("carrier_key"), "left"
    )
    # A thin row becomes a long text.  Left to the joins' partitions, which are cut to as many as there
    # are cores or one more, the last of them would run alone.
    docs = spread(docs, tables["orders"], finer=8)
    # Inside the lambda a line's own values are fields of ``line``.
    fields = re.sub(r"\b(line_no|ship|supp)\b", r"line.\1", _values(values))
    stops = f"transform(coalesce(lines, array()), line -> struct(line.ship AS ship, {fields}))"
    return docs.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderstatus").alias("source"),
        F.expr(style).alias("style"),
        "carrier_key",
        *[F.expr(sql).alias(name) for name, sql in HEADER_VALUES.items()],
        *[F.expr(STOP_VALUES[name]).alias(name) for name in _OF_ORDER],
        F.expr(stops).alias("stops"),
    )


def load_docs(spark: SparkSession, sf_dir: str, style: str = STYLE_OF_ORDER) -> DataFrame:
    """One document per order: ``order_key, source, source_file, text``.

    Functions of arrays are interpreted for every stop, so they get as little to do as they can.
    """
    docs = order_rows(spark, sf_dir, style, _SHOWN)
    lines = F.concat(
        F.array(F.lit("Load Confirmation"), _load_line(), F.lit("Schedule")),
        F.transform("stops", _schedule_text),
        F.array(F.concat(F.lit("Trip # "), F.col("order_key").cast("string"))),
        F.transform("stops", lambda s, i: _pickup_text(s, i + 1, i + 1 == F.size("stops"))),
        F.transform("stops", lambda s, i: _delivery_text(s, i + 1)),
    )
    docs = docs.withColumn(
        "text",
        F.concat(
            F.array_join(lines, "\n"), _broker_text(), _carrier_text(),
            F.lit("\nPlease Sign and return\n"),
        ),
    )
    return docs.select("order_key", "source", "source_file", _styled(F.col("text")).alias("text"))


def _styled(text: Column) -> Column:
    """Label and spacing variants of styles 1 and 2."""
    bold = text
    for plain, variant in (
        ("Pickup", "PickUp"),
        ("Delivery Date", "Del. Date"),
        ("Customer:", "**Customer:**"),
        ("Address #1:", "**Address #1:**"),
        ("Trip #", "**Trip #**"),
    ):
        bold = F.replace(bold, F.lit(plain), F.lit(variant))
    spaced = F.replace(
        F.replace(text, F.lit(", "), F.lit(", \t ")), F.lit("\n"), F.lit("\r\n")
    )
    return F.when(F.col("style") == 1, bold).when(F.col("style") == 2, spaced).otherwise(text)


# ---- the rows behind the documents, in SQL that Spark and DuckDB both read ----


def numbered_stops_sql(style: str = STYLE_OF_ORDER) -> str:
    style = style.replace("o_orderkey", "s.order_key")
    return (
        f"SELECT s.*, {style} AS style, "
        "row_number() OVER (PARTITION BY order_key ORDER BY line_no) AS stop_no, "
        "count(*) OVER (PARTITION BY order_key) AS n_stops "
        f"FROM ({STOPS_SQL}) s"
    )


_STOP_SOURCES = ("customer", "address", "city", "state", "zip", "start_iso", "end_iso")
_STOP_TARGETS = (
    "customer", "address", "city", "state", "zipcode", "start_datetime", "end_datetime",
)


def long_stops_sql(style: str = STYLE_OF_ORDER) -> str:
    """One row per stop block a document shows, in the long form of ``extract_stops``.

    Without markers every delivery shows up as two blocks, the second one blank, because
    its date label starts with the same word.
    """
    pickup = """
SELECT n.order_key, 'pickup' AS stop_type, CAST(n.stop_no AS INT) AS stop_no,
  n.p_customer AS customer, n.p_address AS address, n.p_city AS city, n.p_state AS state,
  CASE WHEN n.style = 7 AND n.stop_no = n.n_stops THEN f.d_zip ELSE n.p_zip END AS zipcode,
  CASE WHEN n.style = 6 THEN '' ELSE n.start_iso END AS start_datetime,
  CASE WHEN n.style = 6 THEN '' ELSE n.end_iso END AS end_datetime
FROM numbered n JOIN numbered f ON f.order_key = n.order_key AND f.stop_no = 1
"""
    delivery = """
SELECT order_key, 'delivery' AS stop_type,
  CAST(CASE WHEN style = 3 THEN 2 * stop_no - 1 ELSE stop_no END AS INT) AS stop_no,
  d_customer AS customer, d_address AS address, d_city AS city, d_state AS state,
  d_zip AS zipcode,
  CASE WHEN style IN (3, 6) THEN '' ELSE start_iso END AS start_datetime,
  CASE WHEN style IN (3, 6) THEN '' ELSE end_iso END AS end_datetime
FROM numbered
"""
    blank = """
SELECT order_key, 'delivery' AS stop_type, CAST(2 * stop_no AS INT) AS stop_no,
  '' AS customer, '' AS address, '' AS city, '' AS state, '' AS zipcode,
  '' AS start_datetime, '' AS end_datetime
FROM numbered WHERE style = 3
"""
    return (
        f"WITH numbered AS ({numbered_stops_sql(style)})"
        f"{pickup} UNION ALL {delivery} UNION ALL {blank}"
    )


def wide_rows_sql(fields: tuple[str, ...] | None = None) -> str:
    """One row per order: ``order_key`` and the text every load-table field must hold."""
    slots = []
    for stop_type in ("pickup", "delivery"):
        for name in _STOP_TARGETS:
            for i in (1, 2, 3):
                slots.append(
                    f"coalesce(max(CASE WHEN stop_type = '{stop_type}' AND stop_no = {i} "
                    f"THEN {name} END), '') AS {stop_type}_{name}_{i}"
                )
    has_carrier = "h.carrier_key IS NOT NULL AND h.style <> 4"
    header = {
        "source_file": "h.source_file",
        "broker_name": "h.b_name",
        "broker_phone": "h.b_phone",
        "broker_fax": "CASE WHEN h.style = 5 THEN '' ELSE h.b_fax END",
        "broker_address": "h.b_address",
        "broker_city": "'Miami Lakes'",
        "broker_state": "'FL'",
        "broker_zipcode": "'40417'",
        "broker_email": "h.b_mail_2 || '; ' || h.b_mail_1",
        "loadConfirmationNumber": "CAST(h.order_key AS STRING)",
        "totalCarrierPay": "h.pay",
        **{
            f"carrier_{name}": f"CASE WHEN {has_carrier} THEN h.c_{short} ELSE '' END"
            for name, short in (
                ("name", "name"), ("mc", "mc"), ("address", "address"), ("city", "city"),
                ("state", "state"), ("zipcode", "zip"), ("phone", "phone"), ("fax", "fax"),
                ("contact", "contact"),
            )
        },
    }
    stop_names = [
        f"{t}_{name}_{i}"
        for t in ("pickup", "delivery") for name in _STOP_TARGETS for i in (1, 2, 3)
    ]
    columns = header | {name: f"coalesce(w.{name}, '')" for name in stop_names}
    chosen = fields or tuple(columns)
    select = ",\n  ".join(f"{columns[name]} AS {name}" for name in chosen)
    return (
        f"SELECT h.order_key,\n  {select}\nFROM ({_headers_sql(STYLE_OF_ORDER)}) h LEFT JOIN (\n"
        f"SELECT order_key, {', '.join(slots)}\nFROM ({long_stops_sql()}) l GROUP BY order_key\n"
        ") w ON w.order_key = h.order_key"
    )


def for_duckdb(sql: str) -> str:
    return sql.format(lineitem="lineitem", orders="orders", supplier="supplier")


def truth_rows(spark: SparkSession, sf_dir: str, wanted: Column | None = None) -> DataFrame:
    """Golden records for every order, or those ``wanted`` by ``order_key``, with known alterations
    (see ``truth_sql``).

    Read off the order's own values, in the same plan that renders the documents.
    """
    rows = order_rows(spark, sf_dir)
    if wanted is not None:
        rows = rows.filter(wanted)
    style, key = F.col("style"), F.col("order_key")
    stops = F.col("stops")
    values = {
        "source_file": F.col("source_file"),
        "broker_city": F.lit("Miami Lakes"),
        "broker_state": F.lit("FL"),
        "broker_zipcode": F.lit("40417"),
        "broker_email": F.concat_ws("; ", "b_mail_2", "b_mail_1"),
        "broker_fax": F.when(style != 5, F.col("b_fax")).otherwise(F.when(key % 2 != 0, "")),
        "loadConfirmationNumber": F.concat(
            key.cast("string"), F.when(key % 11 == 0, "-0").otherwise("")
        ),
        "totalCarrierPay": F.concat("pay", F.when(key % 7 == 0, "9").otherwise("")),
    }
    for name in ("name", "phone", "address"):
        values[f"broker_{name}"] = F.col(f"b_{name}")
    carrier = F.col("carrier_key").isNotNull() & (style != 4)
    for name in ("name", "mc", "address", "city", "state", "zip", "phone", "fax", "contact"):
        value = F.col(f"c_{name}")
        if name == "name":
            value = F.when(key % 5 == 0, F.upper(value)).otherwise(value)
        field = "zipcode" if name == "zip" else name
        values[f"carrier_{field}"] = F.when(carrier, value).otherwise("")
    for name, target in zip(_STOP_SOURCES, _STOP_TARGETS):
        timed = name.endswith("_iso")
        pickup = F.get(stops, F.lit(0))[name if timed else f"p_{name}"]
        if name == "zip":
            alone = (style == 7) & (F.size(stops) == 1)
            pickup = F.when(alone, F.get(stops, F.lit(0))["d_zip"]).otherwise(pickup)
        values[f"pickup_{target}_1"] = F.when((style != 6) | F.lit(not timed), pickup)
        for slot in (1, 2):
            delivery = F.get(stops, F.lit(slot - 1))[name if timed else f"d_{name}"]
            # Without markers the second block is a date label alone.
            shown = ~style.isin(3, 6) if timed else (style != 3) | F.lit(slot == 1)
            values[f"delivery_{target}_{slot}"] = F.when(shown, delivery)
    return rows.select(
        *[
            (values[name] if name == "broker_fax" else F.coalesce(values[name], F.lit(""))).alias(name)
            for name in TRUTH_FIELDS
        ]
    )


def truth_sql() -> str:
    """Golden records: every 5th carrier name in capitals, every 7th pay wrong, every
    11th for a load that does not exist, and blanks alternately '' and NULL."""
    altered = {
        "carrier_name": "CASE WHEN order_key % 5 = 0 THEN upper(carrier_name) ELSE carrier_name END",
        "totalCarrierPay": "CASE WHEN order_key % 7 = 0 THEN totalCarrierPay || '9' "
                           "ELSE totalCarrierPay END",
        "loadConfirmationNumber": "CASE WHEN order_key % 11 = 0 "
                                  "THEN loadConfirmationNumber || '-0' "
                                  "ELSE loadConfirmationNumber END",
        "broker_fax": "CASE WHEN order_key % 2 = 0 THEN nullif(broker_fax, '') ELSE broker_fax END",
    }
    columns = ",\n  ".join(f"{altered.get(name, name)} AS {name}" for name in TRUTH_FIELDS)
    return f"SELECT {columns}\nFROM ({wide_rows_sql(TRUTH_FIELDS)}) t"
