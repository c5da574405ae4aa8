"""Registered queries: each reads the driver's tables under ``sf_dir`` and
runs one operator (or report) of the library over them, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import TimestampType

from headway.operators.bunching import detect_bunching
from headway.operators.nearest import nearest_join
from headway.operators.positions import dedup
from headway.plans import fixtures as fx
from headway.plans import marts as mt
from headway.plans import reports as rp
from headway.plans.inputs import table
from headway.plans.silver import silver_positions
from headway.session import ensure_utc

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Output convention: timestamps as ``timestamp_ntz`` (UTC wall clock)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def all_queries() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return naive_timestamps(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: wrap(v) for k, v in _REGISTRY.items()}


# --- shared building blocks ------------------------------------------------


def _events(spark, sf):
    return table(spark, sf, "events")


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark, sf, name, make) -> DataFrame:
    """A table derived from ``sf``, written once in a session and read from then on,
    as the jobs do between their steps, until the files under ``sf`` change."""
    return spark.read.parquet(_stored_path(spark, sf, name, lambda path: make(spark, sf).write.parquet(path)))


def _stored_path(spark, sf, name, write) -> str:
    from headway.sources.paths import fingerprint

    key = (spark.sparkContext.applicationId, f"{sf} {fingerprint(spark, sf)}", name)
    if key not in _STORED:
        path = _scratch(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def _positions(spark, sf):
    return fx.positions_from_events(_events(spark, sf))


def _dim_route(spark, sf):
    return fx.dim_route_from_events(_events(spark, sf))


def _silver(spark, sf):
    return silver_positions(_positions(spark, sf), _dim_route(spark, sf))


def _events_table(spark, sf, method="split"):
    return detect_bunching(_silver(spark, sf), method=method)


def _weather(spark, sf):
    return fx.weather_from_events(_events(spark, sf))


def _stored_routes(spark, sf):
    return _stored(spark, sf, "dim-route", _dim_route)


def _built_mart(spark, sf):
    return mt.mart_bunching_events(
        mt.stg_bunching_events(_stored(spark, sf, "bunching-events", _events_table)),
        mt.stg_dim_route_current(_stored_routes(spark, sf)),
        mt.stg_fact_weather(_stored(spark, sf, "fact-weather", _weather)),
    )


def _marts(spark, sf):
    """Both marts as the job builds and writes them."""

    def build(path):
        sources = {"bunching_events": _stored(spark, sf, "bunching-events", _events_table), "dim_route": _stored_routes(spark, sf)}
        mt.build_marts(spark, {**sources, "fact_weather": _stored(spark, sf, "fact-weather", _weather)}, out_dir=path)

    return mt.read_marts(spark, _stored_path(spark, sf, "marts", build))


def _mart(spark, sf):
    return _marts(spark, sf)["mart_bunching_events"]


def _hourly(spark, sf):
    return _marts(spark, sf)["mart_bunching_hourly"]


# --- positions, silver, bunching ------------------------------------------


@register("positions")
def q_positions(spark, sf):
    """Bronze positions derived from events, incl. re-delivered copies."""
    return _positions(spark, sf)


@register("dedup_positions")
def q_dedup_positions(spark, sf):
    """A1: one row per (vehicle, snapshot), first by (ingest time, entity)."""
    return dedup(_positions(spark, sf))


@register("silver_positions")
def q_silver_positions(spark, sf):
    """A1 + P3 + J1."""
    return _silver(spark, sf)


@register("bunching_events")
def q_bunching_events(spark, sf):
    """W1 (split form: per-stop window + per-stop aggregates)."""
    return _events_table(spark, sf, "split")


@register("bunching_events_window")
def q_bunching_events_window(spark, sf):
    """W1 (single lag window per route/snapshot)."""
    return _events_table(spark, sf, "window")


@register("dim_route_current")
def q_dim_route_current(spark, sf):
    """P4 + P12: current route rows."""
    return mt.stg_dim_route_current(_dim_route(spark, sf))


@register("parse_positions")
def q_parse_positions(spark, sf):
    """S2 + P2: positions -> message records -> parsed back."""
    from headway.operators.positions import parse_positions
    from headway.sources.messages import to_records

    return parse_positions(to_records(_positions(spark, sf)))


# --- marts and reports -----------------------------------------------------


@register("mart_bunching_events")
def q_mart_events(spark, sf):
    """J2 + J3 + C1 + C11 (detected_at left out: run-time stamp)."""
    return _built_mart(spark, sf).drop("detected_at")


@register("mart_bunching_hourly")
def q_mart_hourly(spark, sf):
    return _hourly(spark, sf).drop(mt.MONTH)


@register("report_total")
def q_report_total(spark, sf):
    return rp.report_total(_mart(spark, sf))


@register("report_network_share")
def q_report_network_share(spark, sf):
    return rp.report_network_share(_mart(spark, sf), _stored_routes(spark, sf))


@register("report_top_routes")
def q_report_top_routes(spark, sf):
    return rp.report_top_routes(_hourly(spark, sf))


@register("report_hourly_top8")
def q_report_hourly_top8(spark, sf):
    return rp.report_hourly_top8(_hourly(spark, sf))


@register("report_by_condition")
def q_report_by_condition(spark, sf):
    return rp.report_by_condition(_mart(spark, sf))


@register("report_by_hour")
def q_report_by_hour(spark, sf):
    return rp.report_by_hour(_mart(spark, sf))


@register("report_by_mode")
def q_report_by_mode(spark, sf):
    return rp.report_by_mode(_mart(spark, sf), _stored_routes(spark, sf))


@register("report_severity")
def q_report_severity(spark, sf):
    return rp.report_severity(_mart(spark, sf))


@register("report_top_detail")
def q_report_top_detail(spark, sf):
    return rp.report_top_detail(_hourly(spark, sf))


@register("report_recent")
def q_report_recent(spark, sf):
    return rp.report_recent(_mart(spark, sf))


@register("route_totals")
def q_route_totals(spark, sf):
    return rp.route_totals(_mart(spark, sf))


@register("avg_speed_by_route")
def q_avg_speed(spark, sf):
    return rp.avg_speed_by_route(_positions(spark, sf))


@register("avg_speed_by_route_sql")
def q_avg_speed_sql(spark, sf):
    return rp.avg_speed_by_route_sql(_positions(spark, sf))


@register("self_bunching_check")
def q_self_bunching(spark, sf):
    """Q3: rows returned are failures."""
    from headway.operators.quality import no_self_pairs

    return no_self_pairs(_mart(spark, sf).drop("detected_at", mt.MONTH))


# --- nearest-in-time join ----------------------------------------------------


@register("nearest_weather")
def q_nearest_weather(spark, sf):
    """J3 on every event: the closest observation of any station."""
    ev = _events(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("event_time"))
    w = _weather(spark, sf).select("station_id", "observed_at", "temperature_c")
    return nearest_join(
        ev, w, "event_time", "observed_at", right_cols=["station_id", "observed_at", "temperature_c"],
        tie_cols=["observed_at", "station_id"],
    )


@register("nearest_weather_keyed")
def q_nearest_weather_keyed(spark, sf):
    """J3 keyed by station: the closest observation of the event's station."""
    ev = _events(spark, sf).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("station_id"),
    )
    w = _weather(spark, sf).select("station_id", "observed_at", "temperature_c")
    return nearest_join(
        ev, w, "event_time", "observed_at", by=["station_id"], right_cols=["observed_at", "temperature_c"],
        tie_cols=["observed_at"],
    )


# --- SCD2, merge, insert-once -----------------------------------------------


def _customer(spark, sf):
    return table(spark, sf, "customer")


@register("scd2_diff")
def q_scd2_diff(spark, sf):
    """Classify every customer key of current vs incoming."""
    from headway.operators.scd2 import scd2_diff

    c = _customer(spark, sf)
    return scd2_diff(fx.customer_current(c), fx.customer_incoming(c), fx.SCD2_KEY, fx.SCD2_TRACKED)


@register("scd2_counts")
def q_scd2_counts(spark, sf):
    """Q5: inserted / expired / unchanged of one load."""
    from headway.operators.scd2 import scd2_counts, scd2_diff

    c = _customer(spark, sf)
    return scd2_counts(scd2_diff(fx.customer_current(c), fx.customer_incoming(c), fx.SCD2_KEY, fx.SCD2_TRACKED))


def _scd2_applied(spark, sf):
    from headway.operators.scd2 import scd2_apply

    c = _customer(spark, sf)
    return scd2_apply(
        fx.customer_history(c), fx.customer_incoming(c), fx.SCD2_KEY, fx.SCD2_TRACKED, fx.SCD2_LOAD_TS
    )


@register("scd2_apply")
def q_scd2_apply(spark, sf):
    """M2: full history after applying the incoming load."""
    return _scd2_applied(spark, sf)


@register("scd2_as_of")
def q_scd2_as_of(spark, sf):
    """M3: the versions valid at 2024-03-01 after the load."""
    from headway.operators.scd2 import scd2_as_of

    return scd2_as_of(_scd2_applied(spark, sf), "2024-03-01 00:00:00")


def _history_loaded(spark, sf):
    """Two loads of one feed, the second without a change and sent twice."""
    from headway.plans.history import load_history, store_history

    c, out = _customer(spark, sf), _scratch(spark, "history")
    store_history(fx.customer_history(c), out, fx.SCD2_KEY)
    for step, ts in ((1, fx.SCD2_LOAD_TS), (2, "2024-07-01 00:00:00"), (2, "2024-08-01 00:00:00")):
        load_history(fx.customer_incoming(c), out, fx.SCD2_KEY, fx.SCD2_TRACKED, ts, step)
    return out


@register("history_loads")
def q_history_loads(spark, sf):
    """M2: the history of a table whose loads rewrite open rows only."""
    from headway.plans.history import read_history

    return read_history(spark, _history_loaded(spark, sf))


@register("history_as_of")
def q_history_as_of(spark, sf):
    """M3: the versions valid at 2024-03-01, of a history kept in parts."""
    from headway.plans.history import read_as_of

    return read_as_of(spark, _history_loaded(spark, sf), "2024-03-01 00:00:00")


@register("scd2_join_as_of")
def q_scd2_join_as_of(spark, sf):
    """M3: each order joined to the customer version valid at its date."""
    from headway.operators.scd2 import scd2_join_as_of

    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("timestamp").alias("t")
    )
    o = o.select("o_orderkey", "c_custkey", (F.col("t") + F.expr("INTERVAL 11323 DAYS")).alias("t"))
    return scd2_join_as_of(o, _scd2_applied(spark, sf), "c_custkey", "t", ["c_mktsegment"])


@register("last_row_wins")
def q_last_row_wins(spark, sf):
    """Last order (largest order key) per customer."""
    from headway.operators.scd2 import last_row_wins

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return last_row_wins(o, "o_custkey", "o_orderkey")


@register("insert_if_absent")
def q_insert_if_absent(spark, sf):
    """Weather table after inserting a batch with repeats; first write wins."""
    from headway.sources.tables import insert_if_absent

    w = _weather(spark, sf)
    target = w.where(F.col("observed_at") < F.lit("2024-01-15 00:00:00").cast("timestamp"))
    again = w.where(F.col("humidity_pct") % 5 == 0).withColumn("temperature_c", F.col("temperature_c") + 100)
    incoming = w.unionByName(again)
    keys = ["station_id", "observed_at"]
    return target.unionByName(insert_if_absent(target, incoming, keys))


# --- spatial ---------------------------------------------------------------


def _stops(spark, sf):
    return fx.stops_from_supplier(table(spark, sf, "supplier"))


def _restrictions(spark, sf):
    return fx.restrictions_from_part(table(spark, sf, "part"))


def _near(spark, sf, radius):
    from headway.operators.spatial import within_radius

    pairs = within_radius(_stops(spark, sf), _restrictions(spark, sf), radius_m=radius)
    return pairs.withColumn("distance_m", F.round("distance_m", 6))


@register("stops_near_restrictions")
def q_stops_near(spark, sf):
    """Stop-restriction pairs within 150 m (exact grid)."""
    return _near(spark, sf, 150.0)


@register("stops_near_restrictions_500m")
def q_stops_near_500(spark, sf):
    """J4 at 500 m: larger cells, same exactness."""
    return _near(spark, sf, 500.0)


@register("stops_near_restrictions_dense")
def q_stops_near_dense(spark, sf):
    """J4 at 500 m with the restrictions of dense cells dealt over shares."""
    from headway.operators.spatial import within_radius

    pairs = within_radius(_stops(spark, sf), _restrictions(spark, sf), 500.0, replicate="points", dense_rows=3)
    return pairs.withColumn("distance_m", F.round("distance_m", 6))


@register("stg_road_restrictions")
def q_stg_road_restrictions(spark, sf):
    """P5: active restrictions only."""
    r = _restrictions(spark, sf).select(
        "*",
        F.lit(None).cast("timestamp").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
    )
    return mt.stg_road_restrictions(r)


# --- raw inputs: feed, JSON documents, CSV, JDBC, snapshots ------------------


def _scratch(spark, name):
    from headway.session import scratch_path

    return scratch_path(spark, name)


@register("flatten_feed")
def q_flatten_feed(spark, sf):
    """FeedMessage-shaped snapshots -> one row per vehicle entity."""
    from headway.operators.positions import flatten_feed

    return flatten_feed(fx.feed_messages(_events(spark, sf)))


@register("read_restrictions")
def q_read_restrictions(spark, sf):
    """Restriction JSON text (with broken backslashes) -> rows."""
    from headway.sources.files import read_restrictions

    path = _scratch(spark, "restrictions")
    fx.restriction_docs(table(spark, sf, "part")).write.text(path)
    return read_restrictions(spark, path, one_doc_per_file=False).drop("loaded_at")


@register("read_weather")
def q_read_weather(spark, sf):
    """GeoJSON weather documents -> fact_weather rows."""
    from headway.sources.files import read_weather

    path = _scratch(spark, "weather")
    fx.weather_docs(_events(spark, sf)).write.text(path)
    return read_weather(spark, path, multi_line=False).drop("loaded_at")


@register("read_gtfs_stops")
def q_read_gtfs_stops(spark, sf):
    """Stops.txt (BOM, quoted commas, blanks) -> typed stop rows."""
    from headway.schemas import STOP_TYPES
    from headway.sources.files import read_gtfs_csv, type_gtfs

    path = _scratch(spark, "stops_txt")
    fx.stops_csv_rows(table(spark, sf, "supplier")).write.option("header", True).csv(path)
    cols = ["stop_id", *STOP_TYPES]
    return type_gtfs(read_gtfs_csv(spark, path, cols), STOP_TYPES)


@register("snapshot_as_of")
def q_snapshot_as_of(spark, sf):
    """Version 0 of a table stays readable after version 1 overwrites it."""
    from headway.sources.tables import read_snapshot, write_snapshot

    path = _scratch(spark, "snapshots")
    routes = mt.stg_dim_route_current(_dim_route(spark, sf))
    write_snapshot(routes, path)
    write_snapshot(routes.withColumn("route_short_name", F.lit("RENAMED")), path)
    return read_snapshot(spark, path, version=0)


@register("dq_checks")
def q_dq_checks(spark, sf):
    """Q1-Q3: the 19 data tests over staging and marts; failures per check."""
    from headway.operators.quality import run_checks
    from headway.operators.spatial import within_radius

    routes = _dim_route(spark, sf)
    stops = _stops(spark, sf).select(
        "stop_id",
        F.lit(None).cast("string").alias("stop_code"),
        "stop_name",
        "stop_lat",
        "stop_lon",
        F.lit(None).cast("int").alias("wheelchair_boarding"),
        F.lit(True).alias("is_current"),
    )
    restr = _restrictions(spark, sf).select(
        "*",
        F.lit(None).cast("timestamp").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
    )
    mart = _mart(spark, sf)
    tables = {
        "stg_bunching_events": mt.stg_bunching_events(_events_table(spark, sf)),
        "stg_dim_route_current": mt.stg_dim_route_current(routes),
        "stg_dim_stop_current": mt.stg_dim_stop_current(stops),
        "stg_fact_weather": mt.stg_fact_weather(_weather(spark, sf)),
        "stg_road_restrictions": mt.stg_road_restrictions(restr),
        "stg_stops_near_restrictions": within_radius(_stops(spark, sf), _restrictions(spark, sf)),
        "mart_bunching_events": mart,
        "mart_bunching_hourly": mt.mart_bunching_hourly(mart),
    }
    return run_checks(tables)


# --- streaming ----------------------------------------------------------------


# Ranges of about eight days arrive in order; inside a range rows are in no
# particular order, so watermark delays cover one range.
STREAM_DELAY = "10 days"
SENTINEL_AFTER_S = 11 * 86_400
FILES_PER_RANGE = 4


def _stream_source(spark, sf, sentinel: bool = False):
    from headway.streaming.ingest import read_position_stream

    src = _scratch(spark, "stream-src")
    fx.write_stream_files(
        _positions(spark, sf), src, SENTINEL_AFTER_S if sentinel else None, files_per_range=FILES_PER_RANGE
    )
    return read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=FILES_PER_RANGE)


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    """ST1-ST3, ST5: record files -> parsed stream -> parquet append sink
    (availableNow, one file per micro-batch) -> bronze table read back."""
    from headway.streaming.ingest import ingest, run_ingest

    sink, ckpt = _scratch(spark, "stream-sink"), _scratch(spark, "stream-ckpt")
    q = run_ingest(ingest(_stream_source(spark, sf)), sink, ckpt, trigger="availableNow")
    q.awaitTermination()
    return spark.read.parquet(sink).drop("date", "hour")


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    """ST7: re-delivered rows dropped across micro-batches within the
    watermark; the surviving (vehicle, snapshot) keys."""
    from headway.streaming.ingest import dedup_stream, ingest

    sink, ckpt = _scratch(spark, "dedup-sink"), _scratch(spark, "dedup-ckpt")
    s = dedup_stream(ingest(_stream_source(spark, sf)), delay=STREAM_DELAY)
    q = (
        s.select("vehicle_id", "feed_timestamp")
        .writeStream.format("parquet")
        .option("checkpointLocation", ckpt)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("stream_bunching")
def q_stream_bunching(spark, sf):
    """ST8: bunching on the stream; snapshots close as the high-water mark
    passes them (a sentinel row eleven days later closes the last ones)."""
    from headway.streaming.bunching import read_stream_events, run_stream_bunching
    from headway.streaming.ingest import ingest

    out, ckpt = _scratch(spark, "stream-events"), _scratch(spark, "stream-bunch-ckpt")
    q = run_stream_bunching(
        ingest(_stream_source(spark, sf, sentinel=True)), _dim_route(spark, sf), out, ckpt, delay=STREAM_DELAY
    )
    q.awaitTermination()
    return read_stream_events(spark, out)


@register("closed_snapshots")
def q_closed_snapshots(spark, sf):
    """ST8: the rows of snapshots that the watermark has passed, once each, without late rows: a stream that is stopped
    and started again, whose second part brings copies of rows long closed."""
    from headway.streaming.bunching import closed_snapshots
    from headway.streaming.ingest import ingest, read_position_stream

    src, out, ckpt = _scratch(spark, "closing-src"), _scratch(spark, "closed"), _scratch(spark, "closing-ckpt")
    pos = _stored(spark, sf, "positions", _positions)
    cut = F.unix_timestamp(F.lit("2024-01-24 00:00:00").cast("timestamp"))
    late = pos.where(F.col("feed_timestamp") < cut - 20 * 86_400).withColumn("ingest_timestamp", F.lit(0).cast("long"))
    first, rest = pos.where(F.col("feed_timestamp") < cut), pos.where(F.col("feed_timestamp") >= cut)
    for part, sentinel in ((first, None), (rest, SENTINEL_AFTER_S), (late, None)):
        fx.write_stream_files(part, src, sentinel, files_per_range=FILES_PER_RANGE)
        stream = ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=FILES_PER_RANGE))
        rows = closed_snapshots(stream, STREAM_DELAY)
        rows.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).where("vehicle_id is null or vehicle_id != 'sentinel'").select("vehicle_id", "feed_timestamp", "ingest_timestamp", "entity_id", "route_id")


@register("rebuild_bronze")
def q_rebuild_bronze(spark, sf):
    """Feed snapshots archived as gzip JSON by snapshot time, scanned
    back (time from the path), flattened and de-duplicated into bronze rows."""
    from headway.sources.files import read_archive, rebuild_bronze, write_archive

    root = _scratch(spark, "archive")
    feeds = fx.feed_messages(_events(spark, sf)).withColumn(
        "file_time", F.timestamp_seconds(F.col("header.timestamp"))
    )
    write_archive(feeds, root)
    return rebuild_bronze(read_archive(spark, root))


@register("silver_job")
def q_silver_job(spark, sf):
    """Entry B end to end: silver written partitioned by snapshot date, read
    back, bunching events written with Observation counts, events read back
    (run-time ``detected_at`` left out)."""
    from headway.plans.silver import run_silver_job

    silver, events = _scratch(spark, "silver"), _scratch(spark, "events")
    metrics = run_silver_job(spark, _positions(spark, sf), _dim_route(spark, sf), silver, events)
    out = spark.read.parquet(events).drop("detected_at")
    if metrics["bunching_events"] != out.count():
        raise RuntimeError(f"observed {metrics['bunching_events']} events, table holds a different count")
    return out


@register("gtfs_route_loads")
def q_gtfs_route_loads(spark, sf):
    """S13 + M1/M2 + S9 as the loader runs them: two routes.txt versions
    loaded into a versioned SCD2 dimension; the resulting history."""
    from headway.plans.loaders import load_dimension
    from headway.schemas import DIM_ROUTE_SCHEMA, ROUTE_TRACKED, ROUTE_TYPES
    from headway.sources.tables import read_snapshot

    ev = _events(spark, sf)
    out = _scratch(spark, "dim_route")
    for version, ts in ((1, "2024-01-01 00:00:00"), (2, "2024-06-01 00:00:00")):
        csv = _scratch(spark, f"routes{version}")
        fx.routes_txt_rows(ev, version).write.option("header", True).csv(csv)
        load_dimension(
            spark, csv, out, "route_id", ROUTE_TRACKED, ROUTE_TYPES, DIM_ROUTE_SCHEMA, ts, "route_key"
        )
    return read_snapshot(spark, out).drop("route_key")


# --- time ranges, real cuts, planted failures -----------------------------------

RANGE = ("2024-01-08 00:00:00", "2024-01-20 16:00:00")


def _ranged(name, make):
    @register(f"{name}_range")
    def q(spark, sf):
        return make(spark, sf, *RANGE)

    q.__doc__ = f"P9: {name} over an inclusive time range."


_ranged("report_total", lambda s, sf, a, b: rp.report_total(_mart(s, sf), a, b))
_ranged("report_network_share", lambda s, sf, a, b: rp.report_network_share(_mart(s, sf), _stored_routes(s, sf), a, b))
_ranged("report_top_routes", lambda s, sf, a, b: rp.report_top_routes(_hourly(s, sf), 10, a, b))
_ranged("report_hourly_top8", lambda s, sf, a, b: rp.report_hourly_top8(_hourly(s, sf), 8, a, b))
_ranged("report_by_condition", lambda s, sf, a, b: rp.report_by_condition(_mart(s, sf), a, b))
_ranged("report_by_hour", lambda s, sf, a, b: rp.report_by_hour(_mart(s, sf), a, b))
_ranged("report_by_mode", lambda s, sf, a, b: rp.report_by_mode(_mart(s, sf), _stored_routes(s, sf), a, b))
_ranged("report_severity", lambda s, sf, a, b: rp.report_severity(_mart(s, sf), a, b))
_ranged("report_top_detail", lambda s, sf, a, b: rp.report_top_detail(_hourly(s, sf), 15, a, b, weighted=True))
_ranged("report_recent", lambda s, sf, a, b: rp.report_recent(_mart(s, sf), 200, a, b))


@register("bunching_events_gap3")
def q_bunching_events_gap3(spark, sf):
    """W1 with up to three stops between the vehicles (split form)."""
    return detect_bunching(_silver(spark, sf), max_gap=3, method="split")


@register("bunching_events_gap3_window")
def q_bunching_events_gap3_window(spark, sf):
    return detect_bunching(_silver(spark, sf), max_gap=3, method="window")


@register("nearest_clustered")
def q_nearest_clustered(spark, sf):
    """J3 where the times crowd into seconds beside a few very old ones."""
    asked, seen = fx.clustered_times(_events(spark, sf))
    return nearest_join(
        asked, seen, "event_time", "observed_at", right_cols=["observed_at", "temperature_c"],
        tie_cols=["observed_at", "station_id", "temperature_c"],
    )


@register("located_positions")
def q_located_positions(spark, sf):
    """Rows with a position; some have none."""
    from headway.operators.positions import located

    return located(_positions(spark, sf)).select("entity_id", "latitude", "longitude")


@register("position_records")
def q_position_records(spark, sf):
    """Record keys and the fields of the JSON value, NULLs written out."""
    from headway.sources.messages import to_records

    value = F.col("value").cast("string")
    return to_records(_positions(spark, sf)).select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(value, "$.entity_id").alias("entity_id"),
        F.get_json_object(value, "$.occupancy_status").alias("occupancy_status"),
        F.size(F.json_object_keys(value)).alias("n_fields"),
    )


@register("dq_checks_planted")
def q_dq_checks_planted(spark, sf):
    """Q1-Q3 over tables that break them: NULLs, repeated keys, self pairs."""
    from headway.operators.quality import run_checks

    ev = _events(spark, sf)
    pairs = fx.planted_pairs(ev)
    tables = {
        "stg_bunching_events": pairs,
        "stg_dim_stop_current": fx.planted_stops(ev),
        "mart_bunching_events": pairs.select("route_id", "event_time", "vehicle_id_a", "vehicle_id_b"),
    }
    return run_checks(tables)


# --- tables, loaders and jobs as they run -----------------------------------------


@register("snapshot_empty_version")
def q_snapshot_empty_version(spark, sf):
    """Three versions, the middle one empty; each reads back as written."""
    from headway.sources.tables import read_snapshot, write_snapshot

    path = _scratch(spark, "snapshots")
    routes = mt.stg_dim_route_current(_dim_route(spark, sf))
    for df in (routes, routes.where("false"), routes.where("route_type = 0")):
        write_snapshot(df, path)
    parts = [read_snapshot(spark, path, v).select(F.lit(v).alias("version"), "route_id") for v in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _failing(df, column):
    """``df`` with a row that raises while it is written."""
    broken = F.raise_error(F.lit("planted failure")).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(F.pmod(F.xxhash64(column), F.lit(2)) == 0, broken).otherwise(F.col(column)))


def _fails(write) -> None:
    try:
        write()
    except Exception as e:
        if "planted failure" in str(e):
            return
        raise
    raise RuntimeError("a write that had to fail did not")


@register("snapshot_failed_write")
def q_snapshot_failed_write(spark, sf):
    """A write that raises half-way leaves no version; the current one is still read, and the next write is version 1."""
    from headway.sources.tables import latest_version, read_snapshot, write_snapshot

    path = _scratch(spark, "snapshots")
    routes = mt.stg_dim_route_current(_dim_route(spark, sf))
    write_snapshot(routes, path)
    _fails(lambda: write_snapshot(_failing(routes, "route_id"), path))
    after = read_snapshot(spark, path).select(F.lit(latest_version(spark, path)).alias("version"), "route_id", "route_short_name")
    n = write_snapshot(routes.withColumn("route_short_name", F.lit("RENAMED")), path)
    now = read_snapshot(spark, path).select(F.lit(n).alias("version"), "route_id", "route_short_name")
    return after.unionByName(now)


@register("full_refresh_failed")
def q_full_refresh_failed(spark, sf):
    """Refreshes that fail, by an error while writing, repeated keys or no rows, leave the old rows."""
    from headway.sources.tables import full_refresh, read_snapshot

    path = _scratch(spark, "refreshed")
    stops = _stops(spark, sf)
    full_refresh(stops, path, keys=["stop_id"])
    _fails(lambda: full_refresh(_failing(stops, "stop_name"), path, keys=["stop_id"]))
    for bad in (stops.unionByName(stops.where("stop_id = '1'")), stops.where("false")):
        try:
            full_refresh(bad, path, keys=["stop_id"])
        except ValueError:
            continue
        raise RuntimeError("a refresh that had to fail did not")
    return read_snapshot(spark, path)


@register("rebuild_shrinks")
def q_rebuild_shrinks(spark, sf):
    """A partitioned table rewritten with fewer dates has only those."""
    from headway.sources.tables import with_bronze_partitions, write_table

    path = _scratch(spark, "rebuilt")
    rows = with_bronze_partitions(_positions(spark, sf)).select("entity_id", "date")
    write_table(rows, path, partition_by=["date"])
    write_table(rows.where("date >= '2024-01-20'"), path, partition_by=["date"])
    return spark.read.option("mergeSchema", "false").parquet(path).select("entity_id", F.col("date").cast("string").alias("date"))


@register("write_bronze")
def q_write_bronze(spark, sf):
    """Bronze by row time, written in two appends and read back."""
    from headway.sources.tables import read_bronze, write_bronze

    path = _scratch(spark, "bronze")
    pos = _positions(spark, sf)
    first = F.col("feed_timestamp") < F.unix_timestamp(F.lit("2024-01-12 00:00:00").cast("timestamp"))
    write_bronze(pos.where(first), path)
    write_bronze(pos.where(~first), path)
    return read_bronze(spark, path).drop("date", "hour")


@register("sql_on_path")
def q_sql_on_path(spark, sf):
    """SQL over a path."""
    from headway.sources.tables import sql_on_path

    path = _scratch(spark, "by-path")
    _positions(spark, sf).write.parquet(path)
    return sql_on_path(spark, path, query="SELECT route_id, count(*) AS n, min(vehicle_timestamp) AS first_seen FROM {t} GROUP BY route_id")


@register("full_refresh")
def q_full_refresh(spark, sf):
    """A table replaced with blanks as NULL."""
    from headway.sources.tables import full_refresh, read_snapshot

    path = _scratch(spark, "refreshed")
    supplier = table(spark, sf, "supplier")
    full_refresh(_stops(spark, sf), path, keys=["stop_id"])
    blank = F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).otherwise(F.col("s_name"))
    full_refresh(supplier.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("stop_id"), blank.alias("stop_name")), path, keys=["stop_id"])
    return read_snapshot(spark, path)


@register("export_csv")
def q_export_csv(spark, sf):
    """The route totals as CSV, one file by choice, read back."""
    from headway.sources.tables import export_csv

    path = _scratch(spark, "export")
    export_csv(rp.route_totals(_mart(spark, sf)), path, single_file=True)
    schema = "route_id string, route_short_name string, route_long_name string, bunching_events long, avg_stop_gap double"
    return spark.read.schema(schema).option("header", True).csv(path)


@register("build_marts")
def q_build_marts(spark, sf):
    """Both marts built and written twice into one folder, the second
    time with all events; the hourly mart read back."""
    out = _scratch(spark, "marts")
    events = _stored(spark, sf, "bunching-events", _events_table)
    tables = {"dim_route": _stored_routes(spark, sf), "fact_weather": _stored(spark, sf, "fact-weather", _weather)}
    half = F.col("feed_timestamp") < F.unix_timestamp(F.lit("2024-01-12 00:00:00").cast("timestamp"))
    for part in (events.where(half), events):
        built = mt.build_marts(spark, {"bunching_events": part, **tables}, out_dir=out)
    return built["mart_bunching_hourly"].drop(mt.MONTH)


@register("hourly_increments")
def q_hourly_increments(spark, sf):
    """The hourly mart from three increments, the last with late events of
    old hours; one of them is sent twice."""
    from headway.plans.rollup import add_increment, read_rollup

    out = _scratch(spark, "rollup")
    mart = _mart(spark, sf).drop(mt.MONTH)
    same_stop, first = F.col("stop_sequence_gap") == 0, F.col("event_time") < F.lit("2024-01-12 00:00:00").cast("timestamp")
    increments = [mart.where(same_stop & first), mart.where(same_stop & ~first), mart.where(~same_stop | same_stop.isNull())]
    for n, rows in ((0, increments[0]), (1, increments[1]), (1, increments[1]), (2, increments[2])):
        add_increment(rows, out, n)
    return read_rollup(spark, out).drop(mt.MONTH)


@register("staging_views")
def q_staging_views(spark, sf):
    """Staging views by name, queried with SQL."""
    mt.register_staging(spark, {"fact_weather": _stored(spark, sf, "fact-weather", _weather), "dim_route": _stored_routes(spark, sf)})
    return spark.sql(
        "SELECT station_id, condition, count(*) AS n, (SELECT count(*) FROM stg_dim_route_current) AS routes "
        "FROM stg_fact_weather GROUP BY station_id, condition"
    )


def _gtfs_folder(spark, sf):
    folder = _scratch(spark, "gtfs")
    for name, rows in (
        ("routes", fx.routes_txt_rows(_events(spark, sf), 1)),
        ("stops", fx.stops_csv_rows(table(spark, sf, "supplier"))),
        ("trips", fx.trips_csv_rows(table(spark, sf, "orders"))),
    ):
        rows.write.option("header", True).csv(f"{folder}/{name}.txt")
    return folder


@register("gtfs_stop_loads")
def q_gtfs_stop_loads(spark, sf):
    """The stop dimension after two loads of one feed (nothing changes the second time)."""
    from headway.plans.loaders import load_gtfs_dimensions
    from headway.sources.tables import read_snapshot

    folder, out = _gtfs_folder(spark, sf), _scratch(spark, "dims")
    for ts in ("2024-01-01 00:00:00", "2024-06-01 00:00:00"):
        load_gtfs_dimensions(spark, folder, out, ts)
    return read_snapshot(spark, f"{out}/dim_stop").drop("stop_key")


@register("gtfs_trip_load")
def q_gtfs_trip_load(spark, sf):
    """The trip table."""
    from headway.plans.loaders import load_gtfs_dimensions
    from headway.sources.tables import read_snapshot

    out = _scratch(spark, "dims")
    load_gtfs_dimensions(spark, _gtfs_folder(spark, sf), out, "2024-01-01 00:00:00")
    return read_snapshot(spark, f"{out}/dim_trip").drop("loaded_at")


@register("restriction_snapshot")
def q_restriction_snapshot(spark, sf):
    """Restriction documents loaded, and the stops near the located ones."""
    from headway.plans.loaders import load_restriction_snapshot
    from headway.sources.tables import read_snapshot

    docs, out = _scratch(spark, "closures"), _scratch(spark, "restrictions")
    fx.restriction_docs(table(spark, sf, "part")).write.text(docs)
    stops = _stops(spark, sf).withColumn("is_current", F.col("stop_id").cast("int") % 7 != 0)
    load_restriction_snapshot(spark, docs, stops, out, "2024-01-01 00:00:00", one_doc_per_file=False)
    pairs = read_snapshot(spark, f"{out}/stops_near_restrictions")
    return pairs.select("stop_id", "restriction_id", F.round("distance_m", 6).alias("distance_m"))


@register("observation_loads")
def q_observation_loads(spark, sf):
    """Two loads of weather documents; the first write of a station and time stays."""
    from headway.plans.loaders import load_observations

    target = _scratch(spark, "fact-weather-loads")
    ev = _events(spark, sf)
    for i, part in enumerate((ev.where("event_id % 3 = 0"), ev)):
        docs = _scratch(spark, "weather-docs")
        fx.weather_docs(part).write.text(docs)
        load_observations(spark, docs, target, f"2024-01-0{i + 1} 00:00:00", multi_line=False)
    return spark.read.parquet(target).select("station_id", "observed_at", F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded"))


@register("observation_loads_by_month")
def q_observation_loads_by_month(spark, sf):
    """As observation_loads, into a table kept by month; the second load is sent twice."""
    from headway.plans.loaders import load_observations_by_month
    from headway.sources.parts import read_parts

    target = _scratch(spark, "fact-weather-months")
    ev = _events(spark, sf)
    for step, part in ((0, ev.where("event_id % 3 = 0")), (1, ev), (1, ev)):
        docs = _scratch(spark, "weather-docs")
        fx.weather_docs(part).write.text(docs)
        load_observations_by_month(spark, docs, target, f"2024-01-0{step + 1} 00:00:00", step, multi_line=False)
    return read_parts(spark, target).select("station_id", "observed_at", F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded"))


def _checked_orders(spark, sf):
    """Orders as text, with planted blanks, bad numbers, copies and repeated keys, loaded under declared constraints."""
    from headway.plans.loaders import load_checked

    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 17 == 0, F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(k % 19 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 23 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    copies = orders.where("o_orderkey % 29 = 0").withColumn("o_orderstatus", F.explode(F.array(F.col("o_orderstatus"), F.lit("A"))))
    out = _scratch(spark, "checked-orders")
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.LongType(), False),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderstatus", T.StringType(), False),
        ]
    )
    load_checked(orders.unionByName(copies), f"{out}/orders", f"{out}/rejects", schema, ["o_orderkey"], ["o_orderstatus"], {"o_orderstatus": "U"})
    return out


@register("checked_load")
def q_checked_load(spark, sf):
    """The orders that keep to the declared types, NOT NULL columns and key."""
    from headway.sources.tables import read_snapshot

    return read_snapshot(spark, f"{_checked_orders(spark, sf)}/orders")


@register("checked_load_rejects")
def q_checked_load_rejects(spark, sf):
    """The orders refused, with their reasons and the number of equal rows."""
    from headway.sources.tables import read_snapshot

    rejects = read_snapshot(spark, f"{_checked_orders(spark, sf)}/rejects")
    return rejects.select("o_orderkey", "o_orderstatus", F.concat_ws(", ", "reject_reasons").alias("reasons"), "copies")


@register("stream_compacted")
def q_stream_compacted(spark, sf):
    """S8/ST3: a stream in many micro-batches, resumed once and then another one from a
    new checkpoint over the same files, into compacted days."""
    from headway.sources.parts import read_parts
    from headway.streaming.ingest import ingest, read_position_stream, run_compacted_ingest

    src, out, pos = _scratch(spark, "stream-src"), _scratch(spark, "stream-days"), _stored(spark, sf, "positions", _positions)
    first = F.col("feed_timestamp") < F.unix_timestamp(F.lit("2024-01-16 00:00:00").cast("timestamp"))
    ckpt = _scratch(spark, "days-ckpt")
    for part in (pos.where(first), pos.where(~first)):
        fx.write_stream_files(part, src, None, files_per_range=FILES_PER_RANGE)
        stream = ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=FILES_PER_RANGE))
        run_compacted_ingest(stream, out, ckpt, "availableNow", 1, "day").awaitTermination()
    run_compacted_ingest(stream, out, _scratch(spark, "days-ckpt"), "availableNow", 1, "day").awaitTermination()
    return read_parts(spark, out).groupBy("route_id", "feed_timestamp").agg(F.count(F.lit(1)).alias("n"), F.count("vehicle_id").alias("vehicles"))


@register("replay_archive")
def q_replay_archive(spark, sf):
    """ST5: an archive replayed into bronze by a stream."""
    from headway.sources.files import write_archive
    from headway.streaming.ingest import replay

    root, sink, ckpt = _scratch(spark, "archive"), _scratch(spark, "replayed"), _scratch(spark, "replay-ckpt")
    feeds = fx.feed_messages(_events(spark, sf)).withColumn("file_time", F.timestamp_seconds(F.col("header.timestamp")))
    write_archive(feeds, root)
    replay(spark, root, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("entity_id", "vehicle_id", "feed_timestamp", "ingest_timestamp", "current_status", "occupancy_status")


@register("stream_bunching_restart")
def q_stream_bunching_restart(spark, sf):
    """ST8: two queries, one after the other, on one checkpoint and its state."""
    from headway.streaming.bunching import read_stream_events, run_stream_bunching
    from headway.streaming.ingest import ingest, read_position_stream

    src, out, ckpt = _scratch(spark, "stream-src"), _scratch(spark, "stream-events"), _scratch(spark, "stream-restart-ckpt")
    pos, routes = _stored(spark, sf, "positions", _positions), _stored_routes(spark, sf)
    first = F.col("feed_timestamp") < F.unix_timestamp(F.lit("2024-01-16 00:00:00").cast("timestamp"))
    for part, sentinel in ((pos.where(first), None), (pos.where(~first), SENTINEL_AFTER_S)):
        fx.write_stream_files(part, src, sentinel, files_per_range=FILES_PER_RANGE)
        stream = ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=FILES_PER_RANGE))
        run_stream_bunching(stream, routes, out, ckpt, delay=STREAM_DELAY).awaitTermination()
    return read_stream_events(spark, out)
