"""The load table's columns.  Names and order are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

from waybill.functions.fields import (
    BROKER_FIELDS,
    CARRIER_FIELDS,
    LOAD_FIELDS,
    STOP_ATTRIBUTES,
    STOP_TYPES,
)
from waybill.functions.patterns import STOPS_KEPT

SOURCE_FILE = "source_file"
PROCESSED_AT = "processed_at"

_HEADER = (*BROKER_FIELDS, *LOAD_FIELDS, *CARRIER_FIELDS)
_SLOTS = range(1, STOPS_KEPT + 1)

# Written order: attributes first, then stop numbers.
EXTRACTION_FIELDS = (
    *_HEADER,
    *[f"{t}_{name}_{i}" for t in STOP_TYPES for name in STOP_ATTRIBUTES for i in _SLOTS],
    PROCESSED_AT,
)

# Declared order: stop numbers first, then attributes.
TABLE_FIELDS = (
    SOURCE_FILE,
    PROCESSED_AT,
    *_HEADER,
    *[f"{t}_{name}_{i}" for t in STOP_TYPES for i in _SLOTS for name in STOP_ATTRIBUTES],
)

# The fields a golden record states: one pickup and two deliveries.
TRUTH_FIELDS = (
    SOURCE_FILE,
    *_HEADER,
    *[f"pickup_{name}_1" for name in STOP_ATTRIBUTES],
    *[f"delivery_{name}_{i}" for name in STOP_ATTRIBUTES for i in (1, 2)],
)

_COMMENTS = {
    SOURCE_FILE: "address of the document, percent-encoded",
    PROCESSED_AT: "when the row was made, UTC",
    "loadConfirmationNumber": "trip number the document shows",
    "totalCarrierPay": "amount agreed with the carrier, without separators",
    "carrier_mc": "motor carrier number",
}


def load_schema() -> T.StructType:
    """63 string columns with their comments."""
    return T.StructType(
        [
            T.StructField(
                name,
                T.StringType(),
                metadata={"comment": _COMMENTS[name]} if name in _COMMENTS else {},
            )
            for name in TABLE_FIELDS
        ]
    )

