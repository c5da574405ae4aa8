"""Fixed schemas of the data model (bronze positions, dimensions, facts, marts)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# The 16 bronze position columns, in their declared order.
POSITION_SCHEMA = _s(
    ("feed_timestamp", LongType(), True),
    ("ingest_timestamp", LongType(), True),
    ("entity_id", StringType(), True),
    ("vehicle_id", StringType(), True),
    ("trip_id", StringType(), True),
    ("route_id", StringType(), True),
    ("direction_id", IntegerType(), True),
    ("latitude", FloatType(), True),
    ("longitude", FloatType(), True),
    ("bearing", FloatType(), True),
    ("speed", FloatType(), True),
    ("current_stop_sequence", IntegerType(), True),
    ("stop_id", StringType(), True),
    ("current_status", StringType(), True),
    ("vehicle_timestamp", LongType(), True),
    ("occupancy_status", StringType(), True),
)
POSITION_COLUMNS = [f.name for f in POSITION_SCHEMA.fields]

# Feed snapshot as a struct (input of flatten_feed).  Enum fields may arrive
# either as names or as numbers, so they are read as strings.
FEED_SCHEMA = _s(
    ("header", _s(("timestamp", LongType(), True)), True),
    (
        "entity",
        ArrayType(
            _s(
                ("id", StringType(), True),
                (
                    "vehicle",
                    _s(
                        ("vehicle", _s(("id", StringType(), True)), True),
                        (
                            "trip",
                            _s(
                                ("trip_id", StringType(), True),
                                ("route_id", StringType(), True),
                                ("direction_id", IntegerType(), True),
                            ),
                            True,
                        ),
                        (
                            "position",
                            _s(
                                ("latitude", FloatType(), True),
                                ("longitude", FloatType(), True),
                                ("bearing", FloatType(), True),
                                ("speed", FloatType(), True),
                            ),
                            True,
                        ),
                        ("current_stop_sequence", IntegerType(), True),
                        ("stop_id", StringType(), True),
                        ("current_status", StringType(), True),
                        ("timestamp", LongType(), True),
                        ("occupancy_status", StringType(), True),
                    ),
                    True,
                ),
            )
        ),
        True,
    ),
)

BUNCHING_EVENT_SCHEMA = _s(
    ("route_id", StringType(), True),
    ("route_short_name", StringType(), True),
    ("feed_timestamp", LongType(), True),
    ("vehicle_id_a", StringType(), True),
    ("vehicle_id_b", StringType(), True),
    ("stop_sequence_gap", IntegerType(), True),
    ("detected_at", TimestampType(), True),
)

# Tracked columns of the SCD2 dimensions and the trip table.
ROUTE_TRACKED = ["route_short_name", "route_long_name", "route_type", "route_color", "route_text_color"]
STOP_TRACKED = ["stop_code", "stop_name", "stop_lat", "stop_lon", "wheelchair_boarding"]
TRIP_COLUMNS = ["trip_id", "route_id", "service_id", "trip_headsign", "direction_id", "shape_id"]

ROUTE_TYPES = {
    "route_short_name": StringType(),
    "route_long_name": StringType(),
    "route_type": IntegerType(),
    "route_color": StringType(),
    "route_text_color": StringType(),
}
STOP_TYPES = {
    "stop_code": StringType(),
    "stop_name": StringType(),
    "stop_lat": DoubleType(),
    "stop_lon": DoubleType(),
    "wheelchair_boarding": IntegerType(),
}
TRIP_TYPES = {
    "trip_id": StringType(),
    "route_id": StringType(),
    "service_id": StringType(),
    "trip_headsign": StringType(),
    "direction_id": IntegerType(),
    "shape_id": StringType(),
}

DIM_ROUTE_SCHEMA = _s(
    ("route_key", LongType(), False),
    ("route_id", StringType(), False),
    ("route_short_name", StringType(), True),
    ("route_long_name", StringType(), True),
    ("route_type", IntegerType(), True),
    ("route_color", StringType(), True),
    ("route_text_color", StringType(), True),
    ("valid_from", TimestampType(), False),
    ("valid_to", TimestampType(), True),
    ("is_current", BooleanType(), False),
)

DIM_STOP_SCHEMA = _s(
    ("stop_key", LongType(), False),
    ("stop_id", StringType(), False),
    ("stop_code", StringType(), True),
    ("stop_name", StringType(), True),
    ("stop_lat", DoubleType(), True),
    ("stop_lon", DoubleType(), True),
    ("wheelchair_boarding", IntegerType(), True),
    ("valid_from", TimestampType(), False),
    ("valid_to", TimestampType(), True),
    ("is_current", BooleanType(), False),
)

FACT_WEATHER_SCHEMA = _s(
    ("station_id", StringType(), False),
    ("station_name", StringType(), True),
    ("observed_at", TimestampType(), False),
    ("temperature_c", DoubleType(), True),
    ("condition", StringType(), True),
    ("humidity_pct", IntegerType(), True),
    ("wind_kmh", DoubleType(), True),
    ("pressure_kpa", DoubleType(), True),
    ("loaded_at", TimestampType(), True),
)

ROAD_RESTRICTION_SCHEMA = _s(
    ("restriction_id", StringType(), False),
    ("road", StringType(), True),
    ("road_class", StringType(), True),
    ("latitude", DoubleType(), True),
    ("longitude", DoubleType(), True),
    ("planned", BooleanType(), True),
    ("expired", BooleanType(), True),
    ("start_time", TimestampType(), True),
    ("end_time", TimestampType(), True),
    ("description", StringType(), True),
    ("loaded_at", TimestampType(), True),
)

# Raw restriction record inside the {"Closure": [...]} document.  Values are
# read as text so that typed parsing rules (blank -> NULL, etc.) apply.
CLOSURE_SCHEMA = _s(
    ("id", StringType(), True),
    ("road", StringType(), True),
    ("roadClass", StringType(), True),
    ("latitude", StringType(), True),
    ("longitude", StringType(), True),
    ("planned", StringType(), True),
    ("expired", StringType(), True),
    ("startTime", StringType(), True),
    ("endTime", StringType(), True),
    ("description", StringType(), True),
)
CLOSURE_DOC_SCHEMA = _s(("Closure", ArrayType(CLOSURE_SCHEMA), True))


def _en(t):
    return _s(("en", t, True))


def _value_en(t):
    return _s(("value", _en(t), True))


# GeoJSON weather document: properties.{identifier, name.en, currentConditions.*}
WEATHER_DOC_SCHEMA = _s(
    (
        "properties",
        _s(
            ("identifier", StringType(), True),
            ("name", _en(StringType()), True),
            (
                "currentConditions",
                _s(
                    ("timestamp", _en(StringType()), True),
                    ("temperature", _value_en(DoubleType()), True),
                    ("condition", _en(StringType()), True),
                    ("relativeHumidity", _value_en(IntegerType()), True),
                    ("wind", _s(("speed", _value_en(DoubleType()), True)), True),
                    ("pressure", _value_en(DoubleType()), True),
                ),
                True,
            ),
        ),
        True,
    ),
)
