"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

__all__ = [
    "OCCUPANCY_STATUS",
    "VEHICLE_STOP_STATUS",
    "blank_to_null",
    "differs",
    "enum_name",
    "epoch_to_ts",
    "micros",
    "millis_to_ts",
    "mode_label",
    "repair_json_backslashes",
    "round_half_up",
    "severity_label",
    "to_bool",
    "to_double",
    "to_ntz",
    "to_ts",
    "typed",
]

# GTFS-realtime enum numbers and their names (public spec).
VEHICLE_STOP_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
OCCUPANCY_STATUS = {
    0: "EMPTY",
    1: "MANY_SEATS_AVAILABLE",
    2: "FEW_SEATS_AVAILABLE",
    3: "STANDING_ROOM_ONLY",
    4: "CRUSHED_STANDING_ROOM_ONLY",
    5: "FULL",
    6: "NOT_ACCEPTING_PASSENGERS",
    7: "NO_DATA_AVAILABLE",
    8: "NOT_BOARDABLE",
}

# Dashboard labels for route_type and for the stop gap.
MODE_LABELS = {0: "Streetcar", 1: "Subway", 3: "Bus"}
MODE_OTHER = "Other"
SEVERITY_LABELS = {0: "Same stop", 1: "One stop apart"}

# Placeholder for an already-valid escaped backslash while lone ones are fixed.


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(c) -> Column:
    """Epoch seconds (bigint) -> timestamp."""
    return F.timestamp_seconds(_c(c))


def to_ts(c) -> Column:
    """Any timestamp-like column (incl. timestamp_ntz read from Parquet) as a
    session-zone ``timestamp``; sessions run in UTC."""
    return _c(c).cast("timestamp")


def to_ntz(c) -> Column:
    """Timestamp -> ``timestamp_ntz`` for output tables compared as naive UTC."""
    return _c(c).cast("timestamp_ntz")


def micros(c) -> Column:
    """Epoch microseconds of a timestamp (C6 building block)."""
    return F.unix_micros(to_ts(c))


def blank_to_null(c) -> Column:
    """``x or None`` for text: empty string -> NULL."""
    return F.nullif(_c(c), F.lit(""))


def millis_to_ts(c) -> Column:
    """Epoch milliseconds given as text or number -> timestamp; falsy -> NULL.

    Blank, NULL and zero are falsy; anything not an integer is NULL too.
    """
    t = F.trim(_c(c).cast("string"))
    ms = t.try_cast("bigint")
    return F.when(t.isNull() | (t == "") | (ms == 0), F.lit(None).cast("timestamp")).otherwise(
        F.timestamp_millis(ms)
    )


def to_double(c) -> Column:
    """Float-if-present: blank/unparsable text -> NULL, else double."""
    return blank_to_null(F.trim(_c(c).cast("string"))).try_cast("double")


def to_bool(c) -> Column:
    """Typed truthiness (C28, finding F9): 'true'/'1'/'t'/'yes' -> true,
    NULL/blank/'false'/'0'/... -> false.  Unlike Python ``bool("false")``."""
    t = F.lower(F.trim(_c(c).cast("string")))
    return F.coalesce(t.isin("true", "1", "t", "yes", "y"), F.lit(False))


def typed(c, dtype: DataType | str) -> Column:
    """Blank -> NULL, then a lenient cast to the target type."""
    col = _c(c)
    if isinstance(dtype, StringType) or dtype == "string":
        return blank_to_null(col.cast("string"))
    return blank_to_null(F.trim(col.cast("string"))).try_cast(dtype)


def differs(a, b, dtype: DataType | str = "string") -> Column:
    """Null-safe inequality after normalising both sides to ``dtype``.

    ``""`` equals NULL and ``0`` equals ``"0"``; ``43.65`` equals ``"43.650000"``
    when compared as double (finding F7).
    """
    return ~typed(a, dtype).eqNullSafe(typed(b, dtype))


def enum_name(c, mapping: Mapping[int, str]) -> Column:
    """Enum number -> name; a value that is already a name passes through."""
    col = _c(c)
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])
    as_int = col.cast("string").try_cast("int")
    return F.when(as_int.isNotNull(), m[as_int]).otherwise(col.cast("string"))


def repair_json_backslashes(c) -> Column:
    """Escape every backslash that does not start a valid JSON escape.

    Valid ``\\\\`` pairs are consumed first (finding F6), so an already escaped
    backslash followed by a letter stays valid instead of becoming three.
    """
    # In a run of backslashes the pairs come first; an odd last one is lone
    # unless it starts an escape, \\u with its four digits included.
    return F.regexp_replace(_c(c), r"""(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})""", r"$1\\\\")


def round_half_up(c, scale: int) -> Column:
    """SQL ``ROUND(numeric, n)``: half away from zero on the decimal value (C14)."""
    return F.round(_c(c).cast("decimal(38,12)"), scale).cast("double")


def mode_label(route_type) -> Column:
    """route_type 0/1/3 -> Streetcar/Subway/Bus, anything else (NULL too) -> Other."""
    rt = _c(route_type)
    expr = F.lit(MODE_OTHER)
    for code, label in sorted(MODE_LABELS.items(), reverse=True):
        expr = F.when(rt == code, F.lit(label)).otherwise(expr)
    return expr


def severity_label(gap) -> Column:
    """gap 0 -> 'Same stop', 1 -> 'One stop apart', else the number as text."""
    g = _c(gap)
    return (
        F.when(g == 0, F.lit(SEVERITY_LABELS[0]))
        .when(g == 1, F.lit(SEVERITY_LABELS[1]))
        .otherwise(g.cast("string"))
    )
