"""Staging views (P12), the bunching mart with route and nearest weather
(J2, J3), and the hourly rollup (A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.columns import epoch_to_ts
from headway.operators.joins import join_dimension
from headway.operators.nearest import nearest_join
from headway.operators.positions import current
from headway.sources.tables import read_snapshot, replace_table

# The mart's columns.
MART_EVENT_COLUMNS = [
    "route_id",
    "route_short_name",
    "route_long_name",
    "route_color",
    "event_time",
    "vehicle_id_a",
    "vehicle_id_b",
    "stop_sequence_gap",
    "detected_at",
    "temperature_c",
    "weather_condition",
    "wind_kmh",
]


def stg_bunching_events(events: DataFrame) -> DataFrame:
    cols = ["route_id", "route_short_name", "vehicle_id_a", "vehicle_id_b", "stop_sequence_gap"]
    detected = F.col("detected_at") if "detected_at" in events.columns else F.lit(None).cast("timestamp")
    return events.select(
        "route_id",
        "route_short_name",
        epoch_to_ts("feed_timestamp").alias("event_time"),
        *cols[2:],
        detected.alias("detected_at"),
    )


def stg_dim_route_current(dim_route: DataFrame) -> DataFrame:
    return current(dim_route).select(
        "route_id", "route_short_name", "route_long_name", "route_type", "route_color", "route_text_color"
    )


def stg_dim_stop_current(dim_stop: DataFrame) -> DataFrame:
    return current(dim_stop).select(
        "stop_id", "stop_code", "stop_name", "stop_lat", "stop_lon", "wheelchair_boarding"
    )


def stg_fact_weather(fact_weather: DataFrame) -> DataFrame:
    return fact_weather.select(
        "station_id",
        "station_name",
        "observed_at",
        "temperature_c",
        "condition",
        "humidity_pct",
        "wind_kmh",
        "pressure_kpa",
    )


def stg_road_restrictions(road_restrictions: DataFrame) -> DataFrame:
    """Active restrictions: ``NOT expired`` (a NULL flag is dropped too) (P5)."""
    return road_restrictions.where(~F.col("expired")).select(
        "restriction_id",
        "road",
        "road_class",
        "latitude",
        "longitude",
        "planned",
        "expired",
        "start_time",
        "end_time",
        "description",
    )


def stg_stops_near_restrictions(pairs: DataFrame) -> DataFrame:
    return pairs.select("stop_id", "restriction_id", "distance_m")


def mart_bunching_events(
    stg_events: DataFrame,
    stg_routes: DataFrame,
    stg_weather: DataFrame,
    weather_by: Sequence[str] | None = None,
    event_by: Sequence[str] | None = None,
    tolerance_seconds: float | None = None,
    weather_tie_cols: Sequence[str] = ("station_id",),
) -> DataFrame:
    """Events LEFT JOIN current routes, plus the nearest weather observation in
    time (any station unless ``weather_by``; no time limit unless
    ``tolerance_seconds``; findings F14)."""
    routes = stg_routes.select(
        "route_id",
        F.col("route_short_name").alias("_r_short"),
        "route_long_name",
        "route_color",
    )
    b = join_dimension(stg_events, routes, ["route_id"], checked=True).select(
        "route_id",
        F.coalesce("_r_short", "route_short_name").alias("route_short_name"),
        "route_long_name",
        "route_color",
        "event_time",
        "vehicle_id_a",
        "vehicle_id_b",
        "stop_sequence_gap",
        "detected_at",
    )
    w = stg_weather.select(
        *(weather_by or []),
        "observed_at",
        *[c for c in weather_tie_cols if c not in (weather_by or [])],
        "temperature_c",
        F.col("condition").alias("weather_condition"),
        "wind_kmh",
    )
    out = nearest_join(
        b,
        w,
        left_time="event_time",
        right_time="observed_at",
        by=event_by,
        right_by=weather_by,
        right_cols=["temperature_c", "weather_condition", "wind_kmh"],
        tie_cols=["observed_at", *weather_tie_cols],
        tolerance_seconds=tolerance_seconds,
    )
    return out.select(*MART_EVENT_COLUMNS)


def mart_bunching_hourly(mart_events: DataFrame) -> DataFrame:
    """(route, hour) rollup: event count and mean stop gap (A4, C4)."""
    return mart_events.groupBy(
        "route_id",
        "route_short_name",
        "route_long_name",
        F.date_trunc("hour", "event_time").alias("event_hour"),
    ).agg(
        F.count(F.lit(1)).alias("bunching_event_count"),
        F.avg("stop_sequence_gap").alias("avg_stop_sequence_gap"),
    )


# The partition column of both marts, the month of their time column (event_time, event_hour).
MONTH = "event_month"


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def time_filter(df: DataFrame, column: str, from_=None, to=None) -> DataFrame:
    """Dashboard time range, inclusive on both ends (P9); ``None`` = open.

    Of a mart as it is stored, with its ``event_month``, the range's months are
    bounds too: constants that Catalyst turns into partition filters, so other
    months are never listed or read."""
    c: Column = F.col(column)
    stored = MONTH in df.columns and column in ("event_time", "event_hour")
    if from_ is not None:
        first = F.lit(from_).cast("timestamp")
        df = df.where(c >= first)
        df = df.where(F.col(MONTH) >= month_of(first)) if stored else df
    if to is not None:
        last = F.lit(to).cast("timestamp")
        df = df.where(c <= last)
        df = df.where(F.col(MONTH) <= month_of(last)) if stored else df
    return df


def register_staging(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models as temp views (S19): pass raw tables by name, get views."""
    makers = {
        "stg_bunching_events": ("bunching_events", stg_bunching_events),
        "stg_dim_route_current": ("dim_route", stg_dim_route_current),
        "stg_dim_stop_current": ("dim_stop", stg_dim_stop_current),
        "stg_fact_weather": ("fact_weather", stg_fact_weather),
        "stg_road_restrictions": ("road_restrictions", stg_road_restrictions),
        "stg_stops_near_restrictions": ("stops_near_restrictions", stg_stops_near_restrictions),
    }
    views = {}
    for view, (src, fn) in makers.items():
        if src in tables:
            v = fn(tables[src])
            v.createOrReplaceTempView(view)
            views[view] = v
    return views


def build_marts(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out_dir: str | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Full-rebuild marts (S20).  With ``out_dir`` each mart is written as a new
    committed version (the old one is read until then, and stays if the rebuild
    fails), and the hourly mart is built from the written events, so lineage is cut.

    Both are partitioned by ``event_month``, and rows are rebalanced on it after the
    joins: files follow the months and, in a large month, its bytes, whatever the
    joins did to the partitioning.  Inside files events are sorted by ``event_time``,
    hours by ``event_hour`` and route, so that a range prunes whole partitions, then
    files and row groups by their min/max.  Days need no folders of their own (years
    of sparse days would be thousands of tiny files).

    The events are counted (of a stored table its footers are read), as the mart has a
    row for each: beyond ``tables.SORTED_ROWS`` it is dealt by ranges of time, so that no
    task sorts a whole month."""
    views = register_staging(spark, tables)
    events = mart_bunching_events(views["stg_bunching_events"], views["stg_dim_route_current"], views["stg_fact_weather"])
    if not out_dir:
        return {"mart_bunching_events": events, "mart_bunching_hourly": mart_bunching_hourly(events)}
    paths = _mart_paths(out_dir)
    replace_table(
        events.withColumn(MONTH, month_of(F.col("event_time"))),
        paths[EVENTS],
        fmt,
        partition_by=[MONTH],
        sort_within=["event_time"],
        keep=1,
        rows=tables["bunching_events"].count(),
    )
    hourly = mart_bunching_hourly(read_snapshot(spark, paths[EVENTS], fmt=fmt))
    replace_table(
        hourly.withColumn(MONTH, month_of(F.col("event_hour"))),
        paths[HOURLY],
        fmt,
        partition_by=[MONTH],
        sort_within=["event_hour", "route_short_name", "route_id"],
        keep=1,
    )
    return read_marts(spark, out_dir, fmt)


EVENTS, HOURLY = "mart_bunching_events", "mart_bunching_hourly"


def _mart_paths(out_dir: str) -> dict[str, str]:
    return {name: f"{out_dir.rstrip('/')}/{name}" for name in (EVENTS, HOURLY)}


def read_marts(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The current versions of the written marts, with ``event_month`` as their last column, by which ``time_filter``
    (and so every report's range) prunes partitions."""
    return {name: read_snapshot(spark, path, fmt=fmt) for name, path in _mart_paths(out_dir).items()}
