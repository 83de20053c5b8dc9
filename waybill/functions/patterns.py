"""The patterns, labels and formats that decide what is extracted.

Results only agree if these are exactly so; they are stated in Python ``re`` syntax and
translated by :mod:`waybill.functions.dialect`.  ``fields`` reads the broker's address, the
carrier, a stop's city and a pickup's address in steps of linear time that give what the patterns
here say.
"""

from waybill.functions.dialect import Pattern

# ---- text normalisation, in the order in which the rules run (pattern, replacement) ----
NORMALIZE_RULES = (
    (Pattern(r"\*{2,}", ignore_case=False), ""),
    (Pattern(r"PickUp\b"), "Pickup"),
    (Pattern(r"Del\.\s*Date"), "Delivery Date"),
    (Pattern(r"Miami Lake,s"), "Miami Lakes"),
    (Pattern(r"[ \t\u00A0]+", ignore_case=False), " "),
    (Pattern(r"\r\n?", ignore_case=False), "\n"),
    (Pattern(r"\n{3,}", ignore_case=False), "\n\n"),
    (Pattern(r"(?<=\w)\n(?=[A-Z0-9])", ignore_case=False), " "),
)

# Characters at which Python's str.splitlines() ends a line.
LINE_BREAK_CLASS = r"\n-\r\x1c-\x1e\x85\u2028\u2029"

# ---- broker ----
BROKER_SCOPE = Pattern(r"Send Invoice to:(.*?)(?=Total Carrier Pay|Carrier\b|$)", dot_all=True)
BROKER_NAME = Pattern(r"(USA Truck Brokers Inc\.?)")
BROKER_PHONE = Pattern(r"Tel[:\s]*(\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4})")
BROKER_FAX = Pattern(r"Fax[:\s]*(\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4})")
BROKER_ADDRESS = Pattern(
    r"(\d{1,6}\s+[A-Za-z0-9#.,\s]+?)\s*(?:\n|,)?\s*([A-Za-z\s]+),\s*([A-Z]{2})\s*(\d{5})"
)
BROKER_CITY_TYPO = (Pattern(r"\bLake,s\b"), "Lakes")
EMAIL = Pattern(r"[\w\.-]+@[\w\.-]+\.\w+", ignore_case=False)
EMAIL_SEPARATOR = "; "

# ---- load ----
LOAD_CONFIRMATION = Pattern(r"Trip\s*#[:\s]*([A-Z0-9\-]+)")
TOTAL_CARRIER_PAY = Pattern(r"Total\s*(?:To\s*Pay|Carrier\s*Pay)[:\s\$]*([\d,]+\.\d{2})")

# ---- carrier: one pattern, nine groups, all or nothing ----
CARRIER_START = "Trailer VIN Number"
CARRIER_STEPS = (
    r"Carrier\s+([A-Z0-9 &\.\-]+)",
    r"MC\s*#[:\s]*(\d+)",
    r"Address[:\s]*([0-9A-Za-z\s#.,\-]+)",
    r"City[:\s]*([A-Za-z\s]+),\s*([A-Z]{2})\s*(\d{5})",
    r"Phone[:\s]*([\d\-\s\(\)]+)",
    r"Fax[:\s]*([\d\-\s\(\)]*)",
    r"Contact[:\s]*([A-Za-z\s\-\.,()]+?)"
    r"(?=\s*(?:Truck VIN Number|Trailer VIN Number|Total|Please Sign|$))",
)
CARRIER = Pattern(".*?".join((CARRIER_START, *CARRIER_STEPS)), dot_all=True)

# ---- stops ----
STOP_CUTOFF = Pattern(
    r"(?:Send Invoice|Special Instructions|Total|Please Sign).*", dot_all=True
)
STOP_CITY = Pattern(r"City[:\s]*([A-Za-z\s]+),\s*([A-Z]{2})")
STOP_ZIP = Pattern(r"Zip(?:\s*Code)?[:\s]*([0-9]{5})")

PICKUP_CUSTOMER = Pattern(
    r"Customer[:\s]*([A-Z0-9 &\.\-]+?)(?=\s*(?:Pick.?Up|Address|City|Zip|Phone|$))"
)
PICKUP_ADDRESS = Pattern(
    r"Address\s*#1[:\s]*([0-9A-Za-z\.,#\-\s]+?)(?:\n|Pick(?:up)?\s*Time|$)"
)
PICKUP_DATE = Pattern(r"Pick(?:up)?\s*Date[:\s]*([0-9/]+)")
PICKUP_WINDOW = Pattern(r"(?:Pick(?:up)?\s*Time|Time)[:\s]*([0-9:]+)\s*-\s*([0-9:]+)")

DELIVERY_CUSTOMER = Pattern(
    r"Customer[:\s]*([A-Z0-9 &\.\-]+?)(?=\s*(?:Delivery|Address|City|Zip|Phone|$))"
)
DELIVERY_ADDRESS = Pattern(r"Address\s*#1[:\s]*([0-9A-Za-z\.,#\-\s]+)")
DELIVERY_ADDRESS_TAIL = (Pattern(r"\bDelivery\s*Time[:\s]*[0-9: -ETapm]*"), "")
DELIVERY_DATE = Pattern(r"Delivery\s*Date[:\s]*([0-9/]+)")
DELIVERY_WINDOW = Pattern(r"(?:Delivery\s*Time|Time)[:\s]*([0-9:]+)\s*-\s*([0-9:]+)")

STOPS_KEPT = 3


def stop_marker(word: str) -> Pattern:
    return Pattern(rf"{word}\s*#\s*\d+")


def stop_without_marker(word: str) -> Pattern:
    return Pattern(
        rf"{word}\b(.*?)(?=(?:Pickup|Delivery|Send Invoice|Total|$))", dot_all=True
    )


# ---- text quality ----
LOAD_NUMBER_BY_PRIORITY = (
    Pattern(r"Load\s+(\d+)"),
    Pattern(r"\[Load\s+Number\s+-\s+(\d+)\]"),
    Pattern(r"Load\s+Number[:\s-]+(\d+)"),
)
LOAD_NUMBER_MISSING = "NO_ENCONTRADO"
WEEKDAY_DATE = Pattern(r"(Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+(\d{2}/\d{2}/\d{4})")
TIME_WINDOW = Pattern(r"from\s+(\d{2}:\d{2})\s+-\s+(\d{2}:\d{2})")
CITY_STATE_ZIP = Pattern(
    r"([A-Za-z\s]+),\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)", ignore_case=False
)
MARKDOWN_ELEMENTS = "#*[]`"
MARKDOWN_HEADER = Pattern(r"^#+\s", ignore_case=False, multiline=True)
MARKDOWN_LIST = Pattern(r"^\s*[-*+]\s", ignore_case=False, multiline=True)

HEADER_WEIGHT = 5
LIST_WEIGHT = 2
BLANK_LINE_WEIGHT = 50
BLANK_LINE_LIMIT = 20
ELEMENT_WEIGHT = 0.05
DIFFICULTY_LIMIT = 50
DIFFICULTY_LEVELS = ("BAJA", "MEDIA", "ALTA")
DIFFICULTY_BOUNDS = (10, 30)

# ---- method comparison ----
SAMPLE_SIZE = 15
SAMPLE_SEED = 42
PREVIEW_CHARS = 2000
PREVIEW_SHORT_CHARS = 500
HISTOGRAM_BINS = 10
TIE = "Empate"
TIE_TOLERANCE = 0.1
NO_LEVEL = "N/A"
SEMANTIC_THRESHOLD = 20
SUMMARY_COLUMN = "Métrica"
SUMMARY_METRICS = (
    "Tiempo promedio (s)",
    "Load Numbers encontrados (%)",
    "Fechas promedio",
    "Direcciones promedio",
    "Estructura semántica (score)",
    "Dificultad parsing regex",
    "Encabezados Markdown promedio",
)
DETAIL_FILE_COLUMN = "archivo"
DETAIL_COLUMNS = (
    "tiempo",
    "load",
    "fechas",
    "direcciones",
    "estructura_semantica",
    "regex_dificultad",
)

# ---- validation ----
MATCH = "✅ Match"
MISMATCH = "❌ Mismatch"
MISSING_RECORD = "❌ Missing record"
