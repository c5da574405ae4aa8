"""Dashboard reports over the marts (R1-R11).  Each takes a mart and an
optional inclusive time range ``from_``/``to`` (P9) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import mode_label, round_half_up, severity_label
from headway.operators.joins import join_dimension
from headway.operators.topk import top_k
from headway.plans.marts import time_filter


def route_label(short="route_short_name", long="route_long_name"):
    """``short || ' ' || long``: NULL when either part is NULL."""
    return F.concat(F.col(short), F.lit(" "), F.col(long))


def report_total(mart: DataFrame, from_=None, to=None) -> DataFrame:
    """Events in range."""
    return time_filter(mart, "event_time", from_, to).agg(F.count(F.lit(1)).alias("value"))


def report_network_share(mart: DataFrame, total_routes, from_=None, to=None) -> DataFrame:
    """R2: percent of the network with an event, one decimal (A3).

    ``total_routes`` is an int, or a route dimension whose current rows are
    counted in the same aggregation (no cross join, no driver round trip).
    """
    ev = time_filter(mart, "event_time", from_, to).select(F.col("route_id").alias("_r"), F.lit(1).alias("_s"))
    if isinstance(total_routes, int):
        agg = ev.agg(F.countDistinct("_r").alias("_n"))
        share = F.lit(100.0) * F.col("_n") / F.lit(total_routes)
        return agg.select(round_half_up(share, 1).alias("value"))
    dim = total_routes.where(F.col("is_current")) if "is_current" in total_routes.columns else total_routes
    both = ev.unionByName(dim.select(F.col("route_id").alias("_r"), F.lit(2).alias("_s")))
    agg = both.agg(
        F.countDistinct(F.when(F.col("_s") == 1, F.col("_r"))).alias("_n"),
        F.countDistinct(F.when(F.col("_s") == 2, F.col("_r"))).alias("_d"),
    )
    share = F.lit(100.0) * F.col("_n") / F.col("_d")
    return agg.select(round_half_up(share, 1).alias("value"))


def report_top_routes(hourly: DataFrame, k: int = 10, from_=None, to=None) -> DataFrame:
    """Top k route labels by summed events."""
    h = time_filter(hourly, "event_hour", from_, to)
    agg = h.groupBy(route_label().alias("route")).agg(
        F.sum("bunching_event_count").alias("bunching_events")
    )
    return top_k(agg, ["-bunching_events"], k, ["route"])


def report_hourly_top8(hourly: DataFrame, k: int = 8, from_=None, to=None) -> DataFrame:
    """Hourly series of the k routes (by short name) with most events."""
    h = time_filter(hourly, "event_hour", from_, to)
    top = top_k(
        h.groupBy("route_short_name").agg(F.sum("bunching_event_count").alias("_total")),
        ["-_total"],
        k,
        ["route_short_name"],
    ).select("route_short_name")
    # Inner join on a key that is distinct in ``top`` behaves as a semi join.
    kept = h.join(F.broadcast(top), on="route_short_name", how="left_semi")
    return kept.select(
        F.col("event_hour").alias("time"),
        route_label().alias("metric"),
        F.col("bunching_event_count").alias("value"),
    ).orderBy("time", "metric")


def report_by_condition(mart: DataFrame, from_=None, to=None) -> DataFrame:
    """Events per weather condition; NULL is its own group."""
    m = time_filter(mart, "event_time", from_, to)
    return (
        m.groupBy(F.col("weather_condition").alias("weather"))
        .agg(F.count(F.lit(1)).alias("bunching_events"))
        .orderBy(F.desc("bunching_events"), F.asc_nulls_first("weather"))
    )


def report_by_hour(mart: DataFrame, from_=None, to=None) -> DataFrame:
    """Events per UTC hour of day, as two-digit text."""
    m = time_filter(mart, "event_time", from_, to)
    hour = F.lpad(F.hour("event_time").cast("string"), 2, "0")
    return m.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("bunching_events")).orderBy("hour")


def report_by_mode(mart: DataFrame, routes: DataFrame, from_=None, to=None) -> DataFrame:
    """Average events per route by mode, rounded to an integer."""
    m = time_filter(mart, "event_time", from_, to)
    r = routes.where(F.col("is_current")) if "is_current" in routes.columns else routes
    j = join_dimension(m.select("route_id"), r.select("route_id", "route_type"), ["route_id"], checked=True)
    agg = j.groupBy(mode_label("route_type").alias("mode")).agg(
        F.count(F.lit(1)).alias("_n"), F.countDistinct("route_id").alias("_r")
    )
    return agg.select(
        "mode", round_half_up(F.col("_n").cast("double") / F.col("_r"), 0).alias("avg_events_per_route")
    ).orderBy(F.desc("avg_events_per_route"), "mode")


def report_severity(mart: DataFrame, from_=None, to=None) -> DataFrame:
    """Events by stop gap label."""
    m = time_filter(mart, "event_time", from_, to)
    return (
        m.groupBy(severity_label("stop_sequence_gap").alias("severity"))
        .agg(F.count(F.lit(1)).alias("bunching_events"))
        .orderBy(F.desc("bunching_events"), "severity")
    )


def report_top_detail(hourly: DataFrame, k: int = 15, from_=None, to=None, weighted: bool = False) -> DataFrame:
    """Top k routes with the mean of hourly mean gaps (unweighted, as the
    dashboard does, finding F11); ``weighted`` adds the event-weighted mean."""
    h = time_filter(hourly, "event_hour", from_, to)
    aggs = [
        F.sum("bunching_event_count").alias("bunching_events"),
        round_half_up(F.avg("avg_stop_sequence_gap"), 2).alias("avg_stop_gap"),
    ]
    if weighted:
        aggs.append(
            round_half_up(
                F.sum(F.col("avg_stop_sequence_gap") * F.col("bunching_event_count"))
                / F.sum("bunching_event_count"),
                2,
            ).alias("weighted_avg_stop_gap")
        )
    agg = h.groupBy(F.col("route_short_name").alias("route"), F.col("route_long_name").alias("name")).agg(*aggs)
    return top_k(agg, ["-bunching_events"], k, ["route", "name"])


def report_recent(mart: DataFrame, k: int = 200, from_=None, to=None) -> DataFrame:
    """Latest k events with their weather (T4)."""
    m = time_filter(mart, "event_time", from_, to)
    top = top_k(m, ["-event_time"], k, ["route_id", "vehicle_id_a", "vehicle_id_b"])
    return top.select(
        F.col("event_time").alias("time"),
        F.col("route_short_name").alias("route"),
        F.col("route_long_name").alias("name"),
        "vehicle_id_a",
        "vehicle_id_b",
        F.col("stop_sequence_gap").alias("stops_apart"),
        "temperature_c",
        F.col("weather_condition").alias("weather"),
    )


def route_totals(mart: DataFrame) -> DataFrame:
    """Whole-history totals per route with the mean gap to 3 places (A10)."""
    return mart.groupBy("route_id", "route_short_name", "route_long_name").agg(
        F.count(F.lit(1)).alias("bunching_events"),
        round_half_up(F.avg("stop_sequence_gap"), 3).alias("avg_stop_gap"),
    )


def avg_speed_by_route(positions: DataFrame, excluded_status: str = "STOPPED_AT") -> DataFrame:
    """A6 demo: mean speed (6 decimals: a float sum depends on the order of
    addition) and row count per route, moving vehicles only (P8)."""
    return (
        positions.where(F.col("current_status") != excluded_status)
        .groupBy("route_id")
        .agg(F.round(F.avg("speed"), 6).alias("avg_speed"), F.count(F.lit(1)).alias("n"))
        .orderBy("route_id")
    )


AVG_SPEED_SQL = """
SELECT route_id, ROUND(AVG(speed), 6) AS avg_speed, COUNT(*) AS n
FROM {view}
WHERE current_status <> '{excluded}'
GROUP BY route_id
ORDER BY route_id
"""


def avg_speed_by_route_sql(positions: DataFrame, excluded_status: str = "STOPPED_AT") -> DataFrame:
    """A6 through a temp view and Spark SQL."""
    view = "positions_v"
    positions.createOrReplaceTempView(view)
    return positions.sparkSession.sql(AVG_SPEED_SQL.format(view=view, excluded=excluded_status))


def panels(mart: DataFrame, hourly: DataFrame, routes: DataFrame, from_=None, to=None, total_routes=None) -> dict:
    """The ten dashboard panels (R1-R10) for one time range, as DataFrames.

    ``total_routes`` defaults to the current rows of ``routes`` (finding F12).
    """
    return {
        "total": report_total(mart, from_, to),
        "network_share": report_network_share(mart, total_routes if total_routes is not None else routes, from_, to),
        "top_routes": report_top_routes(hourly, 10, from_, to),
        "hourly_top8": report_hourly_top8(hourly, 8, from_, to),
        "by_condition": report_by_condition(mart, from_, to),
        "by_hour": report_by_hour(mart, from_, to),
        "by_mode": report_by_mode(mart, routes, from_, to),
        "severity": report_severity(mart, from_, to),
        "top_detail": report_top_detail(hourly, 15, from_, to),
        "recent": report_recent(mart, 200, from_, to),
    }


def refresh(frames: dict, parallelism: int = 4, max_rows: int = 100_000) -> dict:
    """Evaluate panels concurrently, as a dashboard refresh does (Spark runs
    jobs from several threads at once), and return their rows.

    A panel is a single aggregate, a label-keyed count, a top-k list or an
    hourly series over a time range.  One of more than ``max_rows`` rows, such as
    the hourly series of an open range over many years, is an error: it needs a
    narrower range, not a larger driver.
    """
    from concurrent.futures import ThreadPoolExecutor

    def rows(name, df):
        found = df.limit(max_rows + 1).collect()
        if len(found) > max_rows:
            raise ValueError(f"panel {name} has more than {max_rows} rows; give it a time range")
        return found

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        futures = {name: ex.submit(rows, name, df) for name, df in frames.items()}
        return {name: f.result() for name, f in futures.items()}
