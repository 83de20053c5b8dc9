"""Hand-written documents, one quirk each."""

import contextlib
import random
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_dialect import texts
from waybill.functions import patterns as P
from waybill.functions.datetimes import combine_datetime, iso_day, iso_time
from waybill.functions.dialect import Pattern
from waybill.functions.fields import (
    broker_address_groups,
    broker_scope,
    carrier_scope,
    carrier_steps,
    clean_block,
    customer,
    stop_address,
    stop_parsed,
    stop_place,
)
from waybill.functions.normalize import normalize_text
from waybill.operators.extract import (
    count_stops,
    extract_loads,
    extract_stops,
    get_extractor,
    typed_loads,
)
from waybill.plans.load_docs import load_docs, order_rows

CARRIER = (
    "Trailer VIN Number 9\nCarrier ACME & SONS LLC\nMC #: 123456\nAddress: 1 Main st #2\n"
    "City: SAN JOSE, CA 95101\nPhone: 408-555-0001\nFax:{fax}\nContact: Jo Poe (boss\nTruck VIN Number 3"
)


def docs(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "source_file int, text string")


def loads(spark, *values):
    return sorted(extract_loads(docs(spark, *values)).collect(), key=lambda r: r.source_file)


def normalized(spark, *values):
    df = normalize_text(docs(spark, *values), "text")
    return [r.text for r in df.orderBy("source_file").collect()]


def test_empty_and_null_text_give_blanks(spark):
    for row in loads(spark, "", None, "nothing here"):
        values = row.asDict()
        values.pop("source_file")
        stamp = values.pop("processed_at")
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", stamp)
        assert set(values.values()) == {""} and len(values) == 61


def test_normalize_rules(spark):
    cases = {
        "**Bold** *one*": "Bold *one*",
        "PICKUP pickup PickUp PickUps": "Pickup Pickup Pickup PickUps",
        "del.  date 1": "Delivery Date 1",
        "miami lake,s": "Miami Lakes",
        "a \t\u00a0 b": "a b",
        "a,\r\nb\rc": "a,\nb\nc",
        "a\nB\n1\nc": "a B 1\nc",
        "a.\n\n\n\nb": "a.\nb",
        "a\n\nB": "a\nB",
        " \x1c a\u2028 \x85b \n": "a\nb",
        "é\nÉ": "é\nÉ",
        "é\nE": "é E",
    }
    assert normalized(spark, *cases) == list(cases.values())


def test_normalize_agrees_with_line_splitting(spark):
    sample = texts(5, 200)
    rules = [(p.text, r, re.I if p.ignore_case else 0) for p, r in P.NORMALIZE_RULES]
    expected = []
    for value in sample:
        for pattern, replacement, flag in rules:
            value = re.sub(pattern, replacement, value, flags=flag)
        lines = [line.strip() for line in value.splitlines()]
        expected.append("\n".join(line for line in lines if line).strip())
    assert normalized(spark, *sample) == expected


def test_normalize_leaves_out_passes_that_change_nothing(spark):
    cases = {
        "Pickup P\u0130CKUP pic\u212aup pickup_ Pick\nup": "Pickup Pickup Pickup pickup_ Pick\nup",
        "a\n\n\n\n\nB\n\n": "a\nB",
        "l**.  Date, \x1f": "l. Date,",
        "a \nb\x0b\u2029c\n \u2028\n": "a\nb\nc",
        "**\n": "",
    }
    assert normalized(spark, *cases) == list(cases.values())
    plan = normalize_text(docs(spark, "a"), "text")._jdf.queryExecution().optimizedPlan().toString()
    # All guards stand behind one pass, and runs of breaks are replaced once.
    assert plan.count("Contains(text#") > 9 and "{3,}" not in plan
    assert len(re.findall(r"CASE WHEN \(_text_needy#\d+ AND", plan)) == 5


def test_broker_scope_ends_before_carrier(spark):
    text = (
        "Fax: 111-111-1111\nSend Invoice to:\nUSA Truck Brokers Inc\n12 NW 3 Ave, #4\n"
        "Miami Lake,s, FL 40417\nTel (305) 555-0001\nzoe@b.com, al@b.com zoe@b.com\n"
        "Carrier Fax: 222-222-2222"
    )
    row = loads(spark, text)[0]
    assert row.broker_name == "USA Truck Brokers Inc"
    assert row.broker_phone == "(305) 555-0001" and row.broker_fax == ""
    assert row.broker_email == "al@b.com; zoe@b.com"
    assert (row.broker_city, row.broker_state, row.broker_zipcode) == ("Miami Lakes", "FL", "40417")


def test_carrier_is_all_or_nothing(spark):
    whole, no_label = loads(spark, CARRIER.format(fax=" 408-555-0002"), CARRIER.replace("Fax:{fax}\n", ""))
    assert whole.carrier_name == "ACME & SONS LLC" and whole.carrier_contact == "Jo Poe (boss"
    assert whole.carrier_address == "1 Main st #2" and whole.carrier_city == "SAN JOSE"
    assert whole.carrier_fax == "408-555-0002"
    assert {no_label[c] for c in no_label.asDict() if c.startswith("carrier_")} == {""}
    assert loads(spark, CARRIER.format(fax=""))[0].carrier_fax == ""


def test_carrier_binds_a_later_city_if_all_labels_follow(spark):
    later = CARRIER.format(fax=" 1") + (
        "\nCity: LATER, TX 77001 Phone: 1-2 Fax: 3-4 Contact: Ann Total"
    )
    row = loads(spark, later)[0]
    assert row.carrier_address == "1 Main st #2 City" and row.carrier_city == "LATER"
    assert row.carrier_contact == "Ann"


def carriers(spark, *values):
    df = docs(spark, *values).withColumn("scope", carrier_scope(F.col("text")))
    return carrier_steps(df, "scope", "g").select("source_file", "g").collect()


def test_carrier_steps_never_change_the_result(spark):
    labels = [
        "Trailer VIN Number ", "Carrier A ", "MC # 1 ", "Address: 2 ", "City: B, TX 12345 ", "Phone: 3 ",
        "Fax: 4 ", "Contact: C ", "Truck VIN Number ",
    ]
    noise = [
        *labels, "City: ", "Phone: ", "Fax: ", "Contact: 5 ", "Carrier  MC # 5 ", "Total ", "x ", "\n", "1 ", ": ",
    ]
    rng = random.Random(7)
    whole = "".join(labels)
    sample = [whole, whole.replace("A MC", " MC"), whole.replace("C Truck", "C 5 Truck")]
    for _ in range(300):
        words = [label for label in labels if rng.random() > 0.03]
        for _ in range(rng.randint(0, 12)):
            words.insert(rng.randint(0, len(words)), rng.choice(noise))
        sample.append("".join(words))
    hits = 0
    for row in carriers(spark, *sample):
        match = re.search(P.CARRIER.text, sample[row.source_file], re.I | re.S)
        hits += bool(match)
        # The table strips every value.
        got = [value.strip() for value in row.g]
        assert got == ([value.strip() for value in match.groups()] if match else [""] * 9), sample[row.source_file]
    assert 50 < hits < 300


def test_carrier_takes_linear_time(spark):
    phrases = CARRIER.format(fax=" 1").replace("Truck VIN", "then ") + " City B, FL 40417" * 6000
    labels = "Trailer VIN Number Carrier A " + "MC # 1 Address: 2 City B, FL 40417 Phone 3 Fax 4 " * 2000
    carriers(spark, "")
    for text in (phrases, labels + "x", labels + "Contact B Total"):
        assert len(text) > 90_000
        start = time.perf_counter()
        carriers(spark, text)
        assert time.perf_counter() - start < 3


def test_customer_never_changes_and_takes_linear_time(spark):
    rng = random.Random(12)
    parts = [
        "Customer", "Customer", " ", ": ", "\n", "A CO", "# ", "Address", "City", "Pick-Up", "Delivery", "x", "/", "  ",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)]
    for stop_type, pattern in (("pickup", P.PICKUP_CUSTOMER), ("delivery", P.DELIVERY_CUSTOMER)):
        rows = docs(spark, *texts).select("source_file", customer(F.col("text"), stop_type).alias("c")).collect()
        for row in rows:
            match = re.search(pattern.text, texts[row.source_file], re.I)
            assert row.c == (match.group(1) if match else ""), texts[row.source_file]
        start = time.perf_counter()
        slow = docs(spark, "Customer " * 12_000 + "#", "Customer: " * 10_000 + "# City")
        assert [r.c for r in slow.select(customer(F.col("text"), stop_type).alias("c")).collect()] == ["", ""]
        assert time.perf_counter() - start < 5


def read_groups(spark, column, values):
    """What ``column`` reads from each text, stripped as the table does."""
    rows = docs(spark, *values).select("source_file", column.alias("g")).collect()
    out = {}
    for row in rows:
        groups = [row.g] if isinstance(row.g, str) else row.g
        out[row.source_file] = [value.strip() for value in groups]
    return [out[i] for i in range(len(values))]


# For each field read in steps: its column, its pattern, and parts that make and break it.
STEPS = {
    "city": (
        lambda: stop_place(F.col("text")), P.STOP_CITY,
        ["City", "city", " ", "  ", ":", " :", ", ", ",", "FL", "abc", "é", "\n", "1", "KK", ", GA", "x, NC "],
    ),
    "pickup address": (
        lambda: F.array(stop_address(F.col("text"), "pickup")), P.PICKUP_ADDRESS,
        ["Address #1", "Address#1", " ", ":", " :", "\n", "12 abc", "Pick Time", "Pickup  Time", "(", ";", "#1", "Pick", "  ", "-"],
    ),
    "delivery address": (
        lambda: F.array(stop_address(F.col("text"), "delivery")), P.DELIVERY_ADDRESS,
        ["Address #1", "Address#1", " ", ":", " :", "\n", "12 abc", "(", ";", "#1", "  ", "-"],
    ),
    "broker address": (
        lambda: broker_address_groups(F.col("text")), P.BROKER_ADDRESS,
        [
            "12", "1234567", " ", "  ", "a", "abc", ",", ", ", "\n", "#5", ".", ";", ", FL 33016", ",GA12345", " Miami, FL 33016",
            "é", ", fl  331234", "x", "1 ", ",, ", "5th ",
        ],
    ),
    "contact": (
        None, Pattern(P.CARRIER_STEPS[-1], dot_all=True),
        ["Contact", "contact", " ", ":", " :", "Jo", "Total", "Please Sign", "1", "(b", "\n", "  ", "Truck VIN Number", ","],
    ),
}


@pytest.mark.parametrize("name", [name for name in STEPS if name != "contact"])
def test_steps_never_change_the_result(spark, name):
    column, pattern, parts = STEPS[name]
    rng = random.Random(21)
    values = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)] + texts(5, 200)
    hits = 0
    for value, got in zip(values, read_groups(spark, column(), values)):
        match = re.search(pattern.text, value, re.I)
        hits += bool(match)
        want = list(match.groups()) if match else [""] * pattern.groups
        if name == "delivery address":
            want = [re.sub(P.DELIVERY_ADDRESS_TAIL[0].text, "", want[0], flags=re.I)]
        # The table strips every value and makes one space of a broker's white space.
        want, got = ([re.sub(r"\s+", " ", group.strip()) for group in groups] for groups in (want, got))
        assert got == want, value
    assert hits > 100


def test_contact_steps_never_change_the_result(spark):
    _, pattern, parts = STEPS["contact"]
    rng = random.Random(22)
    ends = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    head = "Trailer VIN Number 9 Carrier A MC # 1 Address: 2; City B, FL 40417 Phone 3 Fax 4"
    values = [f"{head};{end}" for end in ends]
    hits = 0
    for row in carriers(spark, *values):
        match = re.search(P.CARRIER.text, values[row.source_file], re.I | re.S)
        hits += bool(match)
        got = [value.strip() for value in row.g]
        assert got == ([value.strip() for value in match.groups()] if match else [""] * 9), values[row.source_file]
    assert hits > 100


SLOW = {
    "city": ["City abc " * 11_200, "City: " * 17_000, "City" + " " * 100_000, "City abc " * 11_200 + ", F1", "City abc, " * 10_000],
    "pickup address": [
        "Address #1 abc " * 6_700 + ";", "Address #1: " * 8_400, "Address #1" + " " * 100_000 + ";", "Address #1 Pick " * 6_300 + "("
    ],
    "delivery address": ["Address #1: " * 8_400, "Address #1" + ": " * 50_000, "Address " * 12_500],
    "broker address": [
        "12 abc def " * 9_100 + "; X, FL 33016", "12 abc def " * 9_100 + ", F1", "12 " + "abc def " * 12_500 + "#", "1 " * 50_000,
        "12 " + "abc def " * 12_500 + "#1 X, FL 33016", "12 abc, FL " * 9_100, "12 " + " " * 100_000 + "é",
    ],
}


@pytest.mark.parametrize("name", list(SLOW))
def test_steps_take_linear_time(spark, name):
    column = STEPS[name][0]
    read_groups(spark, column(), [""])
    for value in SLOW[name]:
        assert len(value) >= 99_000
        start = time.perf_counter()
        read_groups(spark, column(), [value])
        assert time.perf_counter() - start < 3, value[:30]


def test_contact_and_carrier_city_take_linear_time(spark):
    head = "Trailer VIN Number 9 Carrier A MC # 1 Address: 2; City B, FL 40417 Phone 3 Fax 4 "
    carriers(spark, "")
    for text in (
        head + "Contact " * 12_500 + "1", head + "Contact: " * 11_200 + "1", head + "Total " * 16_700 + "1",
        head + "Contact " * 12_500, head.replace("City", "City abc " * 11_200 + "; City") + "Contact B",
        head.replace("City", "City abc " * 11_200 + "; City"), head + "Contact" + " " * 100_000 + "1",
    ):
        start = time.perf_counter()
        carriers(spark, text)
        assert time.perf_counter() - start < 3, text[80:120]


STOPS = (
    "Pickup # 1\nCustomer: ONE CO\nPickup Date: 1/2/2024\nAddress #1: 1 A ST Pickup Time: 8:00 - 17:00\n"
    "City: REX, GA\nZip Code: 30273\n"
    "Pickup # 2\nCustomer: TWO CO\nPickup Date: 1/3/2024\nAddress #1: 2 B ST Pickup Time: 8:00 AM - 5:00 PM\n"
    "City: ROME, GA\n"
    "Delivery # 1\nCustomer: THREE CO\nDelivery Date: 2/30/2024\nAddress #1: 3 C ST Delivery Time: 9:00 - 10:00\n"
    "City: OCALA, FL\nZip Code: 34470\nSpecial Instructions City: NO, NO"
)


def test_stops(spark):
    row = loads(spark, STOPS)[0]
    assert row.pickup_customer_1 == "ONE CO" and row.pickup_address_1 == "1 A ST"
    assert row.pickup_start_datetime_1 == "2024-01-02T08:00:00"
    assert row.pickup_end_datetime_1 == "2024-01-02T17:00:00"
    # The last pickup runs on into the delivery: it has no zip of its own and, with AM/PM
    # between its times, no window, so it takes both from there.
    assert row.pickup_zipcode_2 == "34470"
    assert row.pickup_start_datetime_2 == "2024-01-03T09:00:00"
    # No calendar day.
    assert row.delivery_start_datetime_1 == "" and row.delivery_address_1 == "3 C ST"
    assert row.delivery_city_1 == "OCALA" and row.pickup_customer_3 == ""


def test_times_with_am_pm_are_no_window(spark):
    row = loads(spark, "Delivery # 1 Delivery Date: 1/2/2024 Delivery Time: 8:00 AM - 5:00 PM")[0]
    assert row.delivery_start_datetime_1 == "" and row.delivery_end_datetime_1 == ""


def test_more_stops_than_slots(spark):
    text = "\n".join(f"Pickup # {i} Customer: C{i} Phone" for i in range(1, 6))
    row = loads(spark, text)[0]
    assert (row.pickup_customer_1, row.pickup_customer_3) == ("C1", "C3")
    long = extract_stops(docs(spark, text)).orderBy("stop_no").collect()
    assert [r.customer for r in long] == ["C1", "C2", "C3", "C4", "C5"]
    counts = count_stops(docs(spark, text)).first()
    assert (counts.n_pickup, counts.pickup_overflow, counts.n_delivery) == (5, True, 0)


def test_stops_without_markers(spark):
    text = "Pickup Customer: A CO\nZip 11111. Delivery Customer: B CO Delivery Date: 1/1/2024 Total"
    long = extract_stops(docs(spark, text)).orderBy("stop_type", "stop_no").collect()
    assert [(r.stop_type, r.stop_no, r.customer) for r in long] == [
        ("delivery", 1, "B CO"), ("delivery", 2, ""), ("pickup", 1, "A CO"),
    ]


def test_combine_datetime_reads_each_text_once(spark):
    df = spark.createDataFrame([("1/2/2024", "8:00")], "d string, t string")
    iso = combine_datetime(F.col("d"), F.col("t")).alias("iso")
    plan = df.select(iso)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("regexp_replace(") == 1


def test_combine_datetime(spark):
    cases = {
        ("1/2/2024", "8:05"): "2024-01-02T08:05:00",
        ("01/02/2024", "08:05:09"): "2024-01-02T08:05:09",
        ("2/29/2024", "0:0"): "2024-02-29T00:00:00",
        ("2/29/2023", "0:0"): "",
        ("2/30/2024", "1:00"): "",
        ("13/1/2024", "1:00"): "",
        ("1/2/24", "1:00"): "",
        ("1/2/0000", "1:00"): "",
        ("1/2/2024", "24:00"): "",
        ("1/2/2024", "1:60"): "",
        ("1/2/2024", "1:00:60"): "",
        ("11/19/2021", "8:00 AM"): "2021-11-19T08:00:00",
        ("11/19/2021", "08:00:15 PM"): "2021-11-19T20:00:15",
        ("11/19/2021", "12:05 am"): "2021-11-19T00:05:00",
        ("11/19/2021", "12:05:09 Pm"): "2021-11-19T12:05:09",
        ("11/19/2021", "1:05\t\n pm"): "2021-11-19T13:05:00",
        ("11/19/2021", "13:05 PM"): "",
        ("11/19/2021", "0:05 AM"): "",
        ("11/19/2021", "8:00AM"): "",
        ("11/19/2021", "8:00 AM "): "",
        ("11/19/2021", "8:00\n"): "",
        ("11/19/2021", " 8:00"): "2021-11-19T08:00:00",
        ("11/ 9/2021", "8:00"): "2021-11-09T08:00:00",
        ("1/2/2024", ""): "",
        ("", "1:00"): "",
        (None, "1:00"): "",
        ("1/2/2024", None): "",
    }
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(cases)], "d string, t string, i int")
    got = df.select("i", combine_datetime(F.col("d"), F.col("t")).alias("iso")).orderBy("i").collect()
    assert [r.iso for r in got] == list(cases.values())
    for (d, t), iso in cases.items():
        assert by_formats(d, t) == iso


def by_formats(d, t):
    """What the standard library reads with the four formats."""
    for form in ("%m/%d/%Y %I:%M %p", "%m/%d/%Y %H:%M", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S"):
        with contextlib.suppress(ValueError):
            return datetime.strptime(f"{d} {t}", form).isoformat() if d and t else ""
    return ""


def test_typed_view(spark):
    row = typed_loads(extract_loads(docs(spark, STOPS + "\nTotal To Pay: $1,234.50"))).first()
    assert str(row.totalCarrierPay) == "1234.50"
    assert row.pickup_start_datetime_1.isoformat() == "2024-01-02T08:00:00"
    assert row.delivery_start_datetime_1 is None and row.broker_name is None


def test_extractor_registry():
    assert get_extractor("load_confirmation") is extract_loads


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plan_normalises_once_and_prunes_unread_fields(spark):
    wide = extract_loads(docs(spark, STOPS))
    assert plan(wide).count("Miami Lake") == 1 or plan(wide).count("M[i") == 1
    one = plan(wide.select("totalCarrierPay"))
    assert "Trailer" not in one and "Cu[s" not in one
    physical = wide._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in physical and "Exchange" not in physical


def test_plan_of_a_filter_does_not_copy_the_rules(spark):
    wide = extract_loads(docs(spark, STOPS + "\nTrip # 5", "Trip # 6"))
    five = wide.filter("loadConfirmationNumber = '5' AND pickup_city_1 = 'REX'")
    assert plan(five).count("Generate explode") == 1 and plan(five).count("PickUp") <= 2
    assert [r.loadConfirmationNumber for r in five.collect()] == ["5"]


def test_stop_parts_agree_with_their_patterns(spark):
    """F5 to F10: sections are cut off, windows read and broker sections ended as the patterns say."""
    parts = ["Send Invoice", "ſend invoice", "Special Instructions", "ſpecıal instructions", "Total", "TOTAL", "Please Sign",
             "pleaſe sign", "Sen", "P", "T", " ", "\n", "a", "Pickup Time: ", "TIME", ":", "8:00", " - ", "17:30", "-", "Send Invoice to:",
             "Total Carrier Pay", "Carrier", "Carriers", "Delivery Time: 9 AM", "xDelivery Time", "Address #1 ", "12 Oak"]
    draw = random.Random(11)
    rows = [("".join(draw.choices(parts, k=draw.randint(0, 10))),) for _ in range(1500)]
    text = F.col("text")
    got = spark.createDataFrame(rows, "text string").select(
        "text",
        clean_block(text, F.lit(True)).alias("cut"),
        broker_scope(text).alias("scope"),
        *[stop_parsed(text, t)["window"].alias(t) for t in ("pickup", "delivery")],
        stop_address(text, "delivery").alias("address"),
    )
    find = lambda p, t: re.search(p.text, t, re.IGNORECASE | (re.DOTALL if p.dot_all else 0))
    for row in got.collect():
        t = row["text"]
        cut = find(P.STOP_CUTOFF, t)
        assert row["cut"] == (t[: cut.start()] if cut else t).strip(), repr(t)
        scope = find(P.BROKER_SCOPE, t)
        assert row["scope"] == (scope[1] if scope else ""), repr(t)
        for name, pattern in (("pickup", P.PICKUP_WINDOW), ("delivery", P.DELIVERY_WINDOW)):
            window = find(pattern, t)
            assert row[name] == (list(window.groups()) if window else ["", ""]), repr(t)
        address = find(P.DELIVERY_ADDRESS, t)
        tail = re.sub(P.DELIVERY_ADDRESS_TAIL[0].text, "", address[1], flags=re.IGNORECASE) if address else ""
        assert row["address"] == tail, repr(t)


def test_stop_is_read_by_plain_searches(spark):
    """F5 to F10: a window costs a search for its match, not a lookahead from the start of the block."""
    block = spark.createDataFrame([("x",)], "text string").select(stop_parsed(F.col("text"), "pickup")["window"].alias("w"))
    assert "regexp_replace" not in block._jdf.queryExecution().optimizedPlan().toString()


def test_documents_compute_only_what_they_show(spark, tmp_path):
    """F2 to F29: no time in ISO form, and no customer's place for every stop, in the lambdas that render."""
    spark.createDataFrame([(1, 2, "O", 3.0), (1, 2, "O", 4.0), (None, 2, "O", 5.0)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame([(1, 2, 7, "0999-01-31"), (1, 1, 6, "12345-12-01"), (1, 3, 6, None), (2, 1, 6, "2024-01-01")],
                                  "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate string")
    lines.withColumn("l_shipdate", F.try_to_timestamp("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(6, "S#6")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    docs = load_docs(spark, str(tmp_path))
    shown = order_rows(spark, str(tmp_path)).select("order_key", F.inline("stops"))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "start_iso" not in plan and plan.count("Town ") == 1
    texts_of = [r["text"] for r in docs.filter("order_key = 1").collect()]
    assert len(texts_of) == 2 and docs.count() == 3
    stops = shown.select("order_key", "us_date", "d_city", "d_state", "d_zip").filter("order_key = 1").collect()
    for stop in stops:
        if stop["us_date"] is not None:
            assert all(f"Date: {stop['us_date']}\n" in text for text in texts_of)
            assert all(f"City: {stop['d_city']}, {stop['d_state']}\nZip Code: {stop['d_zip']}" in text.replace("**", "") for text in texts_of)


def test_every_step_is_small_enough_to_be_compiled(spark):
    """F2 to F9, F11 to F16: the JVM interprets methods of more than 8,000 bytes."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    texts_of = docs(spark, STOPS, CARRIER.format(fax=" 1"))
    for df in (extract_loads(texts_of), extract_stops(texts_of)):
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())]
        assert sizes and max(sizes) < 8000
    # The carrier and the broker's address are read without interpreted lambdas.
    assert "lambdafunction" not in plan(extract_loads(texts_of).select("carrier_name"))
    assert "lambdafunction" not in plan(extract_loads(texts_of).select("broker_address"))


def test_day_and_times_of_a_stop_agree_with_combine_datetime(spark):
    draw = random.Random(3)
    days = ["1/2/2024", "02/29/2023", "2/29/2024", "13/1/2024", "1/0/2024", "1/31/0000", "1/31/0001", "/", "", "1/2/24", "11/31/1999", "1//2024"]
    times = ["8:00", "08:5", "24:00", "0:0:0", "23:59:59", "7:60", ":", "", "8:00:7", "08:00:", "::", "1:2:3:4", "008:00"]
    rows = [(day, time) for day in days for time in times]
    days += ["".join(draw.choices("0123/", k=draw.randint(1, 10))) for _ in range(300)]
    times += ["".join(draw.choices("0125:", k=draw.randint(1, 8))) for _ in range(300)]
    rows += [(draw.choice(days), draw.choice(times)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "d string, t string")
    at = F.concat(iso_day(F.col("d")), F.lit("T"), iso_time(F.col("t")))
    got = df.select("d", "t", F.when(F.length(at) == 19, at).otherwise("").alias("at"), combine_datetime(F.col("d"), F.col("t")).alias("want"))
    found = got.collect()
    assert [r for r in found if r["at"] != r["want"]] == [] and sum(r["at"] != "" for r in found) >= 15
