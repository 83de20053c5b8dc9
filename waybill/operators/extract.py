"""Text to the load table: one wide row per document, or one long row per stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import fields as R
from waybill.functions.dialect import let
from waybill.functions.normalize import normalize_text
from waybill.functions.patterns import STOPS_KEPT
from waybill.sources.schema import EXTRACTION_FIELDS, PROCESSED_AT

Extractor = Callable[..., DataFrame]
_EXTRACTORS: dict[str, Extractor] = {}


def register_extractor(name: str) -> Callable[[Extractor], Extractor]:
    """Make a document layout's extractor available by name."""

    def add(extractor: Extractor) -> Extractor:
        _EXTRACTORS[name] = extractor
        return extractor

    return add


def get_extractor(name: str) -> Extractor:
    if name not in _EXTRACTORS:
        raise KeyError(f"no extractor {name!r}; known: {sorted(_EXTRACTORS)}")
    return _EXTRACTORS[name]


# Steps are columns of their own: Catalyst then computes a value that several later columns
# read only once, and drops the ones nobody reads.


def _in_small_methods(df: DataFrame, columns: dict[str, Column], through: Sequence[str]) -> DataFrame:
    """``df`` with new ``columns``, a step that Spark compiles as many small methods.

    Steps of plain functions become one method together, and the JVM interprets a method beyond 8,000
    bytes instead of compiling it.  A step that holds a lambda stays out of that: here ``through``, columns
    that later steps read, pass one as they are.
    """
    return df.withColumns({name: let(F.col(name), lambda value: value) for name in through} | columns)


def _normalized(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    return normalize_text(df.select(*keep, F.col(text).alias("_text")), "_text", "_text")


def _with_stop_blocks(df: DataFrame) -> DataFrame:
    text = F.col("_text")
    df = df.withColumns({f"_{t}_parts": R.stop_parts(text, t) for t in R.STOP_TYPES})
    return df.withColumns(
        {f"_{t}_blocks": R.stop_blocks(text, F.col(f"_{t}_parts"), t) for t in R.STOP_TYPES}
    )


def _with_times(df: DataFrame, blocks: Sequence[tuple[str, str]]) -> DataFrame:
    """What each block says of its place, day and times."""
    found = {
        f"{block}_{part}": column
        for block, t in blocks
        for part, column in R.stop_found(F.col(block), t).items()
    }
    df = _in_small_methods(df, found, [block for block, _ in blocks])
    times = {
        f"{block}_{part}": column
        for block, _ in blocks
        for part, column in R.stop_times({c: F.col(f"{block}_{c}") for c in ("date", "window")}).items()
    }
    return _in_small_methods(df, times, [f"{block}_place" for block, _ in blocks])


def _is_marked(stop_type: str) -> Column:
    return F.size(f"_{stop_type}_parts") > 1


def processed_at() -> Column:
    """Start of the query in UTC, as ISO text."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")


@register_extractor("load_confirmation")
def extract_loads(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("source_file",)
) -> DataFrame:
    """The wide load table: ``keep`` and the 62 string fields, blank where absent.

    One map-only stage.  Selecting a few fields from the result leaves only the patterns
    of those fields in the plan.
    """
    df = _normalized(df, text, keep).withColumn("_carrier_scope", R.carrier_scope(F.col("_text")))
    df = R.carrier_steps(df, "_carrier_scope", "_carrier")
    df = _with_stop_blocks(_in_small_methods(df, {"_broker": R.broker_scope(F.col("_text"))}, ["_text"]))
    slots = [(t, i) for t in R.STOP_TYPES for i in range(1, STOPS_KEPT + 1)]
    df = df.withColumns(
        {f"_{t}_{i}": R.clean_block(F.get(f"_{t}_blocks", i - 1), _is_marked(t)) for t, i in slots}
    )
    df = R.broker_address_steps(df, "_broker", "_address")
    df = _with_times(df, [(f"_{t}_{i}", t) for t, i in slots])

    columns = {
        **R.broker_columns(F.col("_broker"), F.col("_address")),
        **R.load_columns(F.col("_text")),
        **R.carrier_columns(F.col("_carrier")),
    }
    for t, i in slots:
        block = f"_{t}_{i}"
        place, day, *times = (F.col(f"{block}_{part}") for part in ("place", "day", "from", "to"))
        stop = R.stop_columns(F.col(block), place, day, times, t)
        columns |= {f"{t}_{name}_{i}": column for name, column in stop.items()}
    # Short values, by which this step, too, is compiled as small methods.
    for name in ("broker_state", *[f"{t}_state_1" for t in R.STOP_TYPES]):
        columns[name] = let(columns[name], lambda value: value)
    columns[PROCESSED_AT] = processed_at()
    return df.select(
        *keep,
        *[F.coalesce(columns[name], F.lit("")).alias(name) for name in EXTRACTION_FIELDS],
    )


def extract_stops(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("source_file",)
) -> DataFrame:
    """Every stop, none dropped: ``keep, stop_type, stop_no`` and its attributes."""
    df = _with_stop_blocks(_normalized(df, text, keep))
    per_type = [
        F.struct(
            F.lit(t).alias("stop_type"),
            _is_marked(t).alias("marked"),
            F.col(f"_{t}_blocks").alias("blocks"),
        )
        for t in R.STOP_TYPES
    ]
    df = df.select(*keep, F.inline(F.array(*per_type)))
    df = df.select(
        *keep, "stop_type", "marked", F.posexplode("blocks").alias("position", "block")
    )
    df = df.select(
        *keep,
        "stop_type",
        (F.col("position") + 1).alias("stop_no"),
        R.clean_block(F.col("block"), F.col("marked")).alias("_block"),
    )
    # The two types read different labels, so the right one is chosen per row.
    found = {t: R.stop_found(F.col("_block"), t) for t in R.STOP_TYPES}
    df = df.withColumns(
        {f"_{part}": _by_type(lambda t: found[t][part]) for part in ("date", "window", "place")}
    )
    times = R.stop_times({c: F.col(f"_{c}") for c in ("date", "window")})
    df = df.withColumns({f"_{part}": column for part, column in times.items()})
    stops = {
        t: R.stop_columns(F.col("_block"), F.col("_place"), F.col("_day"), (F.col("_from"), F.col("_to")), t)
        for t in R.STOP_TYPES
    }
    return df.select(
        *keep,
        "stop_type",
        "stop_no",
        *[_by_type(lambda t: stops[t][name]).alias(name) for name in R.STOP_ATTRIBUTES],
    )


def _by_type(value: Callable[[str], Column]) -> Column:
    first, second = R.STOP_TYPES
    return F.when(F.col("stop_type") == first, value(first)).otherwise(value(second))


def count_stops(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("source_file",)
) -> DataFrame:
    """Stops found per document, and whether the wide table leaves any out."""
    df = _with_stop_blocks(_normalized(df, text, keep))
    df = df.select(
        *keep, *[F.size(f"_{t}_blocks").alias(f"n_{t}") for t in R.STOP_TYPES]
    )
    return df.withColumns(
        {f"{t}_overflow": F.col(f"n_{t}") > STOPS_KEPT for t in R.STOP_TYPES}
    )


def _all_stops(stop_type: str) -> Column:
    """Every stop of ``_{stop_type}_blocks``, in order, as structs of its attributes."""
    marked = _is_marked(stop_type)
    blocks = F.transform(f"_{stop_type}_blocks", lambda b: R.clean_block(b, marked))
    # Each step's values are read several times by the next, so they are elements by then.
    steps = F.transform(
        blocks,
        lambda b: F.struct(
            b.alias("block"), *[c.alias(part) for part, c in R.stop_found(b, stop_type).items()]
        ),
    )
    steps = F.transform(
        steps,
        lambda s: F.struct(
            s["block"].alias("block"),
            s["place"].alias("place"),
            *[c.alias(part) for part, c in R.stop_times({c: s[c] for c in ("date", "window")}).items()],
        ),
    )

    def attributes(s: Column) -> Column:
        columns = R.stop_columns(s["block"], s["place"], s["day"], (s["from"], s["to"]), stop_type)
        return F.struct(*[columns[name].alias(name) for name in R.STOP_ATTRIBUTES])

    return F.transform(steps, attributes)


def extract_all_stops(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("source_file",)
) -> DataFrame:
    """Every stop beside its document: ``keep``, arrays ``pickups`` and ``deliveries``, how many
    there are, and whether the wide table leaves any out.  One map-only stage."""
    df = _with_stop_blocks(_normalized(df, text, keep))
    stops = {"pickup": "pickups", "delivery": "deliveries"}
    return df.select(
        *keep,
        *[_all_stops(t).alias(name) for t, name in stops.items()],
        *[F.size(f"_{t}_blocks").alias(f"n_{t}") for t in R.STOP_TYPES],
        *[(F.size(f"_{t}_blocks") > STOPS_KEPT).alias(f"{t}_overflow") for t in R.STOP_TYPES],
    )


def typed_stops(stops: DataFrame) -> DataFrame:
    """The arrays of ``extract_all_stops`` with times typed and blanks as NULL."""

    def typed(stop: Column) -> Column:
        return F.struct(
            *[
                (F.nullif(stop[n], F.lit("")).try_cast("timestamp_ntz") if n.endswith("_datetime")
                 else F.nullif(stop[n], F.lit(""))).alias(n)
                for n in R.STOP_ATTRIBUTES
            ]
        )

    return stops.withColumns({name: F.transform(name, typed) for name in ("pickups", "deliveries")})


def typed_loads(loads: DataFrame) -> DataFrame:
    """The load table with money and times typed and blanks as NULL."""

    def typed(name: str) -> Column:
        if not isinstance(loads.schema[name].dataType, T.StringType):
            return F.col(name)
        value = F.nullif(F.col(name), F.lit(""))
        if name == "totalCarrierPay":
            value = value.try_cast("decimal(12,2)")
        elif "_datetime_" in name:
            value = value.try_cast("timestamp_ntz")
        elif name == PROCESSED_AT:
            value = value.try_cast("timestamp")
        return value.alias(name)

    return loads.select(*[typed(name) for name in loads.columns])
