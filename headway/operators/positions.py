"""Position rows: flatten a feed snapshot, parse JSON records, de-duplicate,
clean and enrich with the current route dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.columns import OCCUPANCY_STATUS, VEHICLE_STOP_STATUS, blank_to_null, enum_name
from headway.operators.joins import join_dimension
from headway.schemas import POSITION_COLUMNS, POSITION_SCHEMA

# Columns that must be present for a position to take part in bunching.
REQUIRED_FOR_BUNCHING = ("latitude", "longitude", "route_id", "current_stop_sequence")


def flatten_feed(
    feed: DataFrame,
    ingest_timestamp: Column | str | None = None,
    feed_col: str | None = None,
    blank_ids_as_null: bool = False,
) -> DataFrame:
    """One row per entity that carries a ``vehicle`` message.

    ``feed`` holds a ``FeedMessage``-shaped struct, either as top-level
    ``header``/``entity`` columns or inside ``feed_col``.  Entities without a
    vehicle are skipped; every optional field is NULL when absent; enums come
    out as names; ``feed_timestamp`` is copied from the header.
    ``ingest_timestamp`` defaults to a column of the same name when present.
    With ``blank_ids_as_null`` unset ids that decode to ``""`` become NULL
    (finding F8); off by default for parity.
    """
    src = feed.select(f"{feed_col}.*", *[c for c in feed.columns if c != feed_col]) if feed_col else feed
    if ingest_timestamp is None:
        ingest = F.col("ingest_timestamp") if "ingest_timestamp" in src.columns else F.lit(None)
    else:
        ingest = F.col(ingest_timestamp) if isinstance(ingest_timestamp, str) else ingest_timestamp
    rows = src.select(
        F.col("header.timestamp").alias("_feed_ts"),
        ingest.cast("long").alias("_ingest_ts"),
        F.explode_outer("entity").alias("e"),
    ).where(F.col("e.vehicle").isNotNull())
    v = "e.vehicle"
    ident = blank_to_null if blank_ids_as_null else (lambda c: c)
    out = rows.select(
        F.col("_feed_ts").cast("long").alias("feed_timestamp"),
        F.col("_ingest_ts").alias("ingest_timestamp"),
        F.col("e.id").alias("entity_id"),
        ident(F.col(f"{v}.vehicle.id")).alias("vehicle_id"),
        ident(F.col(f"{v}.trip.trip_id")).alias("trip_id"),
        ident(F.col(f"{v}.trip.route_id")).alias("route_id"),
        F.col(f"{v}.trip.direction_id").alias("direction_id"),
        F.col(f"{v}.position.latitude").alias("latitude"),
        F.col(f"{v}.position.longitude").alias("longitude"),
        F.col(f"{v}.position.bearing").alias("bearing"),
        F.col(f"{v}.position.speed").alias("speed"),
        F.col(f"{v}.current_stop_sequence").alias("current_stop_sequence"),
        F.col(f"{v}.stop_id").alias("stop_id"),
        enum_name(F.col(f"{v}.current_status"), VEHICLE_STOP_STATUS).alias("current_status"),
        F.col(f"{v}.timestamp").alias("vehicle_timestamp"),
        enum_name(F.col(f"{v}.occupancy_status"), OCCUPANCY_STATUS).alias("occupancy_status"),
    )
    return conform_positions(out)


def conform_positions(df: DataFrame) -> DataFrame:
    """Select the 16 position columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POSITION_SCHEMA.fields])


def parse_positions(records: DataFrame, value_col: str = "value", drop_unparsed: bool = False) -> DataFrame:
    """JSON record value (binary or text) -> the 16 position columns.

    Bad text parses to an all-null row; with ``drop_unparsed`` such rows are
    removed at ingest instead of later by the not-null filter (finding F17).
    """
    parsed = records.select(
        F.from_json(F.col(value_col).cast("string"), POSITION_SCHEMA).alias("row")
    ).select("row.*")
    if drop_unparsed:
        any_set = F.lit(False)
        for c in POSITION_COLUMNS:
            any_set = any_set | F.col(c).isNotNull()
        parsed = parsed.where(any_set)
    return parsed


def dedup(
    df: DataFrame,
    keys: Sequence[str] = ("vehicle_id", "feed_timestamp"),
    order_by: Sequence[str | Column] = ("ingest_timestamp", "entity_id"),
    prefer_valid: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per ``keys`` deterministically: the first by ``order_by`` (A1).

    NULL keys compare equal (as in ``dropDuplicates``).  Planned as a group limit
    of one: each task keeps the first row of a key before the shuffle, so a key
    holding a huge group of copies costs one row per map task, not one huge
    sorted group in one task.  Complete ties are broken by the other columns.
    ``prefer_valid`` (finding F2) ranks rows with all listed columns non-null
    first, so a null-GPS twin never displaces a good row.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    if prefer_valid:
        bad = F.lit(False)
        for c in prefer_valid:
            bad = bad | F.col(c).isNull()
        order.insert(0, bad)
    named = {*keys, *[o for o in order_by if isinstance(o, str)]}
    rest = [F.col(c) for c, kind in df.dtypes if c not in named and not kind.startswith("map")]
    first = Window.partitionBy(*keys).orderBy(*[o.asc_nulls_first() for o in [*order, *rest]])
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def clean_positions(df: DataFrame, required: Sequence[str] = REQUIRED_FOR_BUNCHING) -> DataFrame:
    """Four-way not-null conjunction (P3).  Not ``dropna``: NaN stays."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def current(dim: DataFrame) -> DataFrame:
    """Current rows of an SCD2 dimension."""
    return dim.where(F.col("is_current"))


def located(df: DataFrame, lat: str = "latitude", lon: str | None = "longitude") -> DataFrame:
    """Rows with a position (P13); ``lon=None`` checks only the latitude."""
    cond = F.col(lat).isNotNull()
    if lon:
        cond = cond & F.col(lon).isNotNull()
    return df.where(cond)


def enrich_routes(
    positions: DataFrame,
    dim_route: DataFrame,
    columns: Sequence[str] = ("route_short_name", "route_long_name"),
    checked: bool = True,
) -> DataFrame:
    """positions LEFT JOIN current routes USING (route_id).

    The dimension is filtered to current rows and pruned to ``columns``.  Two
    current rows of a route are an error, not two copies of its positions
    (``checked``; finding F18).
    """
    dim = current(dim_route).select("route_id", *columns)
    return join_dimension(positions, dim, ["route_id"], checked=checked)
