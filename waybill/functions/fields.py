"""Field rules: which pattern fills which column of the load table.

Most patterns are searched directly.  Where a value may run on over the labels of others, the
pattern as written would read the same run once per label; those are read in steps that take
linear time and give the same groups (tests compare them with the patterns).  Two ideas
serve them all: a label whose value fails makes the labels inside its run fail too, so the run is
passed over, and the last place of a step is the first in the reversed text.  Column names
are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import patterns as P
from waybill.functions.datetimes import iso_day, iso_time
from waybill.functions.dialect import (
    GROUP_SEPARATOR,
    SPACE_CLASS,
    Pattern,
    extract,
    extract_all,
    java,
    let,
    replace,
    strip,
)

# Behind a value nothing more is looked for: what is left of the text goes with it.  (Up to a character
# that no document should hold; what may be found behind that is not read.)
_REST = r"[^\x00]*"

BROKER_FIELDS = (
    "broker_name", "broker_phone", "broker_fax", "broker_address",
    "broker_city", "broker_state", "broker_zipcode", "broker_email",
)
LOAD_FIELDS = ("loadConfirmationNumber", "totalCarrierPay")
CARRIER_FIELDS = (
    "carrier_name", "carrier_mc", "carrier_address", "carrier_city",
    "carrier_state", "carrier_zipcode", "carrier_phone", "carrier_fax", "carrier_contact",
)
STOP_ATTRIBUTES = (
    "customer", "address", "city", "state", "zipcode", "start_datetime", "end_datetime",
)
STOP_TYPES = ("pickup", "delivery")


# Where a broker address ends: after a letter or space, a comma, a state and five digits.
_BROKER_TAIL = r",\s*+[A-Z]{2}\s*+\d{5}"
_BROKER_RUN = r"[A-Za-z0-9#.,\s]"
# From a number to the first such end in its run; a run without one is passed over.  After the
# number's spaces there are a character of the street and one of the city at least; only if
# that fails may the last of the spaces be them.
_BROKER_REGION = Pattern(
    rf"(\d{{1,6}}\s++(?:{_BROKER_RUN}{{2}}(?:(?!(?<=[A-Za-z\s]){_BROKER_TAIL}){_BROKER_RUN})*+(?<=[A-Za-z\s])"
    rf"|(?<=\s\s)[A-Za-z]|(?<=\s\s\s)){_BROKER_TAIL}){_REST}|\d{{1,6}}\s{_BROKER_RUN}*+"
)
_BROKER_PLACE = Pattern(rf"(?<![A-Za-z\s])[A-Za-z\s]*+(?={_BROKER_TAIL}\Z)")
_BROKER_END = Pattern(rf"(?<=[A-Za-z\s]){_BROKER_TAIL}\Z")
_BROKER_NUMBER = Pattern(r"\A\d{1,6}")
_BROKER_LETTERS = Pattern(r"\A\s*+(.*)", dot_all=True)
_BROKER_COMMA = Pattern(r"\A(\d{1,6}\s+\S.*?)\s*+,\Z", dot_all=True)
_BROKER_STATE = Pattern(r",\s*+([A-Z]{2})")


# What fails behind the first of these labels fails behind the later ones as well.
_CARRIER_TAIL = Pattern(rf"{P.CARRIER_START}.*", dot_all=True)

# For each step of the carrier but the contact, the shortest text that still is the step; the city's
# is found in reversed text.
_CARRIER_SHORTEST = (
    r"Carrier\s+?[A-Z0-9 &\.\-]",
    r"MC\s*#[:\s]*?\d",
    r"Address[:\s]*?[0-9A-Za-z\s#.,\-]",
    None,
    r"Phone[:\s]*?[\d\-\s\(\)]",
    r"Fax",
)
_CARRIER_CITY = 3

# The contact and what ends it.
_CONTACT_RUN = r"[A-Za-z\s\-\.,()]"
_CONTACT_ENDS = ("Truck VIN Number", "Trailer VIN Number", "Total", "Please Sign")
_CONTACT_END = f"(?:{'|'.join(_CONTACT_ENDS)}|\\Z)"
_CONTACT_VALUE = rf"[:\s]*+({_CONTACT_RUN}(?:(?!{_CONTACT_END}){_CONTACT_RUN})*+)(?={_CONTACT_END})"
# The first contact.  A blank one ends the search; behind any other failure the run is passed over
# up to a label whose value starts behind colons of its own.
_CONTACT = Pattern(
    rf"Contact(?:{_CONTACT_VALUE}{_REST}"
    rf"|[:\s]*+(?<=\s)(?={_CONTACT_END}).*+"
    rf"|[:\s]*+(?:(?!Contact\s*+:){_CONTACT_RUN})*+)",
    dot_all=True,
)
# The last one, in reversed text: from an end back to the label nearest to it.
_ENDS_REVERSED = f"(?:{'|'.join(end[::-1] for end in _CONTACT_ENDS)})"
_CONTACT_REVERSED = Pattern(
    rf"({_ENDS_REVERSED}{_CONTACT_RUN}(?:(?!tcatnoC){_CONTACT_RUN})*+[:\s]*+tcatnoC)|({_ENDS_REVERSED}{_CONTACT_RUN}*+)"
)

# All steps in one search, for a text in which each label's first place serves.  What is read is what a
# search that may go back finds first: a value that may run on over the next label ends before it, and
# must if there is no later one of that label.  Nothing is tried twice, so it takes linear time; a text in
# which it fails is read in steps.
_CARRIER_AT_ONCE = Pattern(
    rf"\A{P.CARRIER_START}"
    r"(?>.*?Carrier\s)\s*+((?:(?!MC\s*+#)[A-Z0-9 &\.\-])++)"
    r"(?>.*?MC\s*+#)(?!.*?MC\s*+#)[:\s]*+(\d++)"
    r"(?>.*?Address)[:\s]*+((?:(?!City)[0-9A-Za-z\s#.,\-])++)"
    r"(?>.*?City)(?!.*?City)[:\s]*+([A-Za-z\s]++),\s*+([A-Z]{2})\s*+(\d{5})"
    r"(?>.*?Phone)[:\s]*+([\d\-\s\(\)]++)"
    r"(?>.*?Fax)[:\s]*+([\d\-\s\(\)]*+)"
    rf"(?>.*?Contact){_CONTACT_VALUE}.*\Z",
    dot_all=True,
)
# Without these labels in this order there is no carrier.
_CARRIER_LABELS = Pattern(
    rf"\A{P.CARRIER_START}(?>.*?Carrier\s)(?>.*?MC\s*+#)(?>.*?Address)(?>.*?City)(?>.*?Phone)(?>.*?Fax)(?>.*?Contact)",
    dot_all=True,
)


def _city(tail: str) -> Pattern:
    """A city label with ``tail`` behind the comma; or one without, passed over like a contact."""
    return Pattern(
        rf"(City[:\s]*+(?:[A-Za-z\s]++|(?<=\s)),{tail}){_REST}|City[:\s]*+(?:(?!City\s*+:)[A-Za-z\s])*+"
    )


_STOP_PLACE = _city(r"\s*+[A-Z]{2}")
_CARRIER_PLACE = _city(r"\s*+[A-Z]{2}\s*+\d{5}")
_CARRIER_PLACE_REVERSED = Pattern(
    r"\d{5}\s*+[A-Z]{2}\s*+,[A-Za-z\s](?:(?!ytiC)[A-Za-z\s])*+[:\s]*+ytiC"
)
_CITY_VALUES = Pattern(r"City[:\s]*+([A-Za-z\s]*+),\s*+([A-Z]{2})\s*+(\d{5})?")

# A pickup's address up to a line end or time label; a blank one ends the search.
_ADDRESS_RUN = r"[0-9A-Za-z\.,#\-\s]"
_ADDRESS_END = r"(?:\n|Pick(?:up)?\s*+Time|\Z)"
_PICKUP_ADDRESS = Pattern(
    rf"Address\s*+#1(?:[:\s]*+({_ADDRESS_RUN}(?:(?!{_ADDRESS_END}){_ADDRESS_RUN})*+){_ADDRESS_END}{_REST}"
    rf"|[:\s]*\s{_ADDRESS_END}.*+"
    rf"|[:\s]*+(?:(?!Address\s*+#1\s*+:){_ADDRESS_RUN})*+)",
    dot_all=True,
)

# The same, led by one class: a list of words would be begun at every character.
_CUTOFF = P.STOP_CUTOFF._replace(
    text=r"[PST](?:(?<=S)(?:end Invoice|pecial Instructions)|(?<=T)otal|(?<=P)lease Sign).*"
)

# The end of the broker's section is looked for only where it may begin; what lies between is one run.
_BROKER_END_LABEL = P.BROKER_SCOPE.text[P.BROKER_SCOPE.text.index("(?=") + 3 : -1]
_BROKER_SCOPE = P.BROKER_SCOPE._replace(
    text=rf"Send Invoice to:([^CT\n]*+(?:(?!{_BROKER_END_LABEL})[CT\n][^CT\n]*+)*+)"
)

_ADDRESS_TAIL = P.DELIVERY_ADDRESS_TAIL[0]._replace(text=r"(?=D)" + P.DELIVERY_ADDRESS_TAIL[0].text)

# An e-mail run that fails at its first character fails at every later one, so a run without an address
# is passed over as a whole.
_EMAIL = P.EMAIL._replace(text=rf"([\w\.-]++{P.EMAIL.text[P.EMAIL.text.index('@'):]})|[\w\.-]++")


def emails(text: Column) -> Column:
    """Distinct e-mail addresses in code-point order, as one text."""
    found = F.array_remove(extract_all(text, _EMAIL), "")
    return F.array_join(F.sort_array(F.array_distinct(found)), P.EMAIL_SEPARATOR)


def broker_scope(text: Column) -> Column:
    return extract(text, _BROKER_SCOPE)


def broker_address_groups(scope: Column) -> Column:
    """Address, city, state and zip code of the broker; ``''`` without a match."""
    return let(_broker_region(scope), lambda region: let(_broker_cut(region), _broker_groups))


def broker_address_steps(df: DataFrame, scope: str, out: str) -> DataFrame:
    """Adds ``out``, what ``broker_address_groups`` reads in ``scope``; its steps are columns."""
    region, cut = f"_{out}_region", f"_{out}_cut"
    df = df.withColumn(region, _broker_region(F.col(scope)))
    return df.withColumn(cut, _broker_cut(F.col(region))).withColumn(out, _broker_groups(F.col(cut)))


def _broker_region(scope: Column) -> Column:
    return _first(scope, _BROKER_REGION)


def _broker_cut(region: Column) -> Column:
    """The region, its tail and the run of letters and spaces before that."""
    return F.struct(
        region.alias("region"),
        extract(region, _BROKER_PLACE, 0).alias("run"),
        extract(region, _BROKER_END, 0).alias("tail"),
    )


def _broker_groups(s: Column) -> Column:
    body = F.length(s["region"]) - F.length(s["tail"])
    before = F.substring(s["region"], F.lit(1), body - F.length(s["run"]))
    number = extract(s["region"], _BROKER_NUMBER, 0)
    # If only letters follow the number, the street is the first of them.
    letters = extract(s["run"], _BROKER_LETTERS)
    only = F.when(
        F.length(letters) >= 2,
        F.array(F.concat(number, F.lit(" "), F.substring(letters, 1, 1)), _from(letters, 1)),
    ).otherwise(F.array(number, letters))
    # Else the city's letters are all behind the street, and one comma may part them.
    usual = F.array(F.regexp_replace(before, java(_BROKER_COMMA), "$1"), s["run"])
    state = extract(s["tail"], _BROKER_STATE)
    groups = F.concat(F.when(before == number, only).otherwise(usual), F.array(state, F.substring(s["tail"], -5, 5)))
    return F.when(s["region"] == "", F.array(*[F.lit("")] * 4)).otherwise(groups)


def _from(text: Column, start: int | Column) -> Column:
    """What follows the first ``start`` characters."""
    return F.substring(text, start + 1 if isinstance(start, Column) else F.lit(start + 1), F.length(text))


def broker_columns(scope: Column, address_groups: Column) -> dict[str, Column]:
    address, city, state, zipcode = (F.get(address_groups, i) for i in range(4))
    typo, repaired = P.BROKER_CITY_TYPO
    return {
        "broker_name": extract(scope, P.BROKER_NAME),
        "broker_phone": extract(scope, P.BROKER_PHONE),
        "broker_fax": extract(scope, P.BROKER_FAX),
        "broker_address": F.regexp_replace(strip(address), f"[{SPACE_CLASS}]+", " "),
        "broker_city": strip(replace(city, typo, repaired)),
        "broker_state": state,
        "broker_zipcode": zipcode,
        "broker_email": emails(scope),
    }


def load_columns(text: Column) -> dict[str, Column]:
    pay = extract(text, P.TOTAL_CARRIER_PAY)
    return {
        "loadConfirmationNumber": extract(text, P.LOAD_CONFIRMATION),
        "totalCarrierPay": F.replace(pay, F.lit(","), F.lit("")),
    }


def carrier_scope(text: Column) -> Column:
    return extract(text, _CARRIER_TAIL, 0)


def _last(text: Column, step: str) -> Column:
    """The text before the last place where ``step`` is found; ``''`` if there is none."""
    return extract(text, Pattern(rf"\A(.*){step}", dot_all=True))


def _before_last_contact(df: DataFrame, scope: str, out: str) -> DataFrame:
    """``out``: the text before the last contact that something ends; ``''`` if there is none."""
    # The end of the text ends a contact as this word does.
    end = "Total"
    reversed_text = F.reverse(F.regexp_replace(F.concat(F.col(scope), F.lit(end)), "[\u0001\u0002]", "\u0003"))
    # A found label is followed by both marks, a run without one stands between them.
    marked = F.regexp_replace(reversed_text, java(_CONTACT_REVERSED), "$1\u0001$2\u0002")
    df = df.withColumn(f"{out}_marked", marked)
    behind = F.regexp_replace(F.substring_index(f"{out}_marked", "\u0001\u0002", 1), "[\u0001\u0002]", "")
    left = F.substring(F.col(scope), F.lit(1), F.length(scope) + len(end) - F.length(behind))
    return df.withColumn(out, F.when(F.contains(F.col(f"{out}_marked"), F.lit("\u0001\u0002")), left).otherwise(""))


def _before_last_city(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``out``: the text before the last city with state and zip code; ``''`` if there is none."""
    behind = Pattern(rf"\A.*?{_CARRIER_PLACE_REVERSED.text}", dot_all=True)
    df = df.withColumn(f"{out}_behind", extract(F.reverse(text), behind, 0))
    left = F.substring(text, F.lit(1), F.length(text) - F.length(f"{out}_behind"))
    return df.withColumn(out, F.when(F.col(f"{out}_behind") == "", "").otherwise(left))


def first_place(text: Column, pattern: Pattern) -> Column:
    """The first city label with all its values, as text; ``''`` if there is none."""
    return _first(text, pattern)


def carrier_steps(df: DataFrame, scope: str, out: str) -> DataFrame:
    """Adds ``out``, the nine groups of the carrier pattern in ``scope``; ``''`` without a match.

    The pattern as one would try every end of a value with every later label.  Most texts are read by
    one search that goes straight on; others in steps, in linear time: backwards, each step ends the text at the last place where all later
    steps can still follow; then forwards, each step takes its first place in the text so
    ended, and its values run as far as they may.
    """
    marked = f"_{out}_at_once"
    separated = GROUP_SEPARATOR + GROUP_SEPARATOR.join(f"${i}" for i in range(1, _CARRIER_AT_ONCE.groups + 1))
    df = df.withColumn(marked, replace(F.col(scope), _CARRIER_AT_ONCE, separated))
    # The scope begins with its label or is empty.
    at_once = F.startswith(F.col(marked), F.lit(GROUP_SEPARATOR))
    none = at_once | ~F.rlike(F.col(scope), F.lit(java(_CARRIER_LABELS)))
    df = _carrier_in_steps(df.withColumn(f"_{out}_left", F.when(none, "").otherwise(F.col(scope))), f"_{out}_left", f"_{out}_slow")
    found = F.split(F.substring(F.col(marked), F.lit(2), F.length(marked)), GROUP_SEPARATOR, -1)
    return df.withColumn(out, F.when(at_once, found).otherwise(F.col(f"_{out}_slow")))


def _carrier_in_steps(df: DataFrame, scope: str, out: str) -> DataFrame:
    limits = [f"_{out}_limit_{i}" for i in range(len(_CARRIER_SHORTEST))]
    df = _before_last_contact(df, scope, limits[-1])
    for i in range(len(_CARRIER_SHORTEST) - 1, 0, -1):
        limit = F.col(limits[i])
        if i == _CARRIER_CITY:
            df = _before_last_city(df, limit, limits[i - 1])
        else:
            df = df.withColumn(limits[i - 1], _last(limit, _CARRIER_SHORTEST[i]))
    reached = F.lit(len(P.CARRIER_START))
    groups = []
    for i, step in enumerate(P.CARRIER_STEPS[:-1]):
        part = f"_{out}_part_{i}"
        df = df.withColumn(part, F.substring(F.col(limits[i]), reached + 1, F.length(limits[i])))
        match = f"_{out}_match_{i}"
        if i == _CARRIER_CITY:
            # A text that matches does so wherever it stands, so this is its first place.
            df = df.withColumn(match, first_place(F.col(part), _CARRIER_PLACE))
            ends = F.when(F.col(match) == "", 0).otherwise(F.instr(F.col(part), F.col(match)) + F.length(match) - 1)
            df = df.withColumn(f"_{out}_at_{i}", reached + ends)
            found = _CITY_VALUES
        else:
            found = Pattern(rf"\A.*?{step}", dot_all=True)
            df = df.withColumn(match, extract(F.col(part), found, 0))
            df = df.withColumn(f"_{out}_at_{i}", reached + F.length(match))
        reached = F.col(f"_{out}_at_{i}")
        groups += [extract(F.col(match), found, g) for g in range(1, Pattern(step).groups + 1)]
    rest = F.substring(F.col(scope), reached + 1, F.length(scope))
    groups.append(_first(rest, _CONTACT))
    # Limits are empty if any step is missing, but for the first, which its own match tells.
    whole = F.col(f"_{out}_match_0") != ""
    return df.withColumn(out, F.when(whole, F.array(*groups)).otherwise(F.array(*[F.lit("")] * len(groups))))


def carrier_columns(groups: Column) -> dict[str, Column]:
    return {name: strip(F.get(groups, i)) for i, name in enumerate(CARRIER_FIELDS)}


def stop_parts(text: Column, stop_type: str) -> Column:
    """The text cut at its numbered stop markers; one part means there is no marker."""
    return F.split(text, java(P.stop_marker(stop_type.title())), -1)


def stop_blocks(text: Column, parts: Column, stop_type: str) -> Column:
    """Raw text of every stop in text order, marked or not."""
    unmarked = extract_all(text, P.stop_without_marker(stop_type.title()))
    return F.when(F.size(parts) > 1, F.slice(parts, F.lit(2), F.size(parts))).otherwise(unmarked)


# The times of a window that was found: no label holds a digit or a dash, and no time begins with a colon.
_WINDOW_START = Pattern(r"\A[^0-9\-]*+([0-9][0-9:]*+)", ignore_case=False)
_WINDOW_END = Pattern(r"-\s*+([0-9:]++)\Z", ignore_case=False)


def clean_block(block: Column, marked: Column) -> Column:
    """A block without the sections after the last stop (marked blocks only)."""
    block = F.coalesce(block, F.lit(""))
    return strip(F.when(marked, replace(block, _CUTOFF, "")).otherwise(block))


def _window(pattern: Pattern) -> Pattern:
    """A window whose label is led by one class, as the cut-off."""
    label, values = pattern.text.removeprefix("(?:").split(")[", 1)
    first, rest = label.rsplit("|", 1)
    return pattern._replace(
        text=rf"[{first[0]}{rest[0]}](?:(?<={first[0]}){first[1:]}|(?<={rest[0]}){rest[1:]})[{values}"
    )


_STOP_PATTERNS = {
    "pickup": (P.PICKUP_CUSTOMER, P.PICKUP_DATE, _window(P.PICKUP_WINDOW)),
    "delivery": (P.DELIVERY_CUSTOMER, P.DELIVERY_DATE, _window(P.DELIVERY_WINDOW)),
}


# After a label whose value no later label ends, the value is passed over as a whole: the labels
# inside it would fail in the same way.  Only a label whose own value starts behind it is left.
# What ends a value begins with white space or the first letter of a label.
_CUSTOMERS = {
    t: customer._replace(
        text=rf"Customer(?:{customer.text.removeprefix('Customer').replace('(?=', r'(?=[\sPDACZ]|\Z)(?=')}{_REST}"
        r"|[:\s]*(?:(?!Customer[ ]*+[:\s])[A-Z0-9 &\.\-])*+)"
    )
    for t, (customer, _, _) in _STOP_PATTERNS.items()
}


def customer(block: Column, stop_type: str) -> Column:
    """The first customer that a label ends, in linear time."""
    return _first(block, _CUSTOMERS[stop_type])


def _first(block: Column, pattern: Pattern) -> Column:
    """The first value found that is not empty, or ``''``."""
    return F.coalesce(F.get(F.array_remove(extract_all(block, pattern), ""), 0), F.lit(""))


def stop_place(block: Column) -> Column:
    """City and state of a block, in linear time."""
    return place_groups(first_place(block, _STOP_PLACE))


def place_groups(place: Column) -> Column:
    return F.array(extract(place, _CITY_VALUES), F.substring(place, -2, 2))


def stop_address(block: Column, stop_type: str) -> Column:
    """The address of a block, in linear time."""
    if stop_type == "pickup":
        return _first(block, _PICKUP_ADDRESS)
    return replace(extract(block, P.DELIVERY_ADDRESS), _ADDRESS_TAIL, P.DELIVERY_ADDRESS_TAIL[1])


def stop_parsed(block: Column, stop_type: str) -> dict[str, Column]:
    """Date text, window and place of one block; the last two as arrays of their groups."""
    _, date, window = _STOP_PATTERNS[stop_type]
    found = stop_found(block, stop_type)
    return {
        "date": found["date"],
        "window": let(found["window"], lambda w: F.array(extract(w, window), extract(w, window, 2))),
        "place": place_groups(found["place"]),
    }


def stop_found(block: Column, stop_type: str) -> dict[str, Column]:
    """What is searched for in a whole block: the date's text, the window and the place with their labels."""
    _, date, window = _STOP_PATTERNS[stop_type]
    return {
        "date": extract(block, date),
        "window": extract(block, window, 0),
        "place": first_place(block, _STOP_PLACE),
    }


def stop_times(found: dict[str, Column]) -> dict[str, Column]:
    """Day and both times of a stop in ISO form, ``''`` where there are none; both need a full window."""
    window = found["window"]
    return {
        "day": iso_day(found["date"]),
        "from": iso_time(extract(window, _WINDOW_START)),
        "to": iso_time(extract(window, _WINDOW_END)),
    }


def stop_columns(block: Column, place: Column, day: Column, times: tuple[Column, Column], stop_type: str) -> dict[str, Column]:
    def at(time: Column) -> Column:
        return F.when((day == "") | (time == ""), "").otherwise(F.concat(day, F.lit("T"), time))

    return {
        "customer": strip(customer(block, stop_type)),
        "address": strip(stop_address(block, stop_type)),
        "city": strip(extract(place, _CITY_VALUES)),
        "state": F.substring(place, -2, 2),
        "zipcode": extract(block, P.STOP_ZIP),
        "start_datetime": at(times[0]),
        "end_datetime": at(times[1]),
    }
