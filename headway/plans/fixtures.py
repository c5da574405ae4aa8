"""Inputs of the transit model derived from the driver's tables.

Each function reads whole tables and maps them with column expressions, so
the work grows with the data.  The same expressions are written in SQL in
``headway.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import OCCUPANCY_STATUS, enum_name, to_ts
from headway.schemas import POSITION_SCHEMA

# Mapping constants of the derived inputs.
LAT0, LON0 = 43.60, -79.50
LAT_STEP, LON_STEP = 0.0002, 0.0003
ROUTE_TYPE_BY_EVENT = {"click": 0, "view": 3, "error": 1}
EXCLUDED_ROUTE = "signup"
ROUTES_PER_EVENT = 6
SNAPSHOT_S = 8 * 3600
STOPS = 25
CURRENT_FROM = "2024-01-01 00:00:00"
HISTORY_FROM = "2023-01-01 00:00:00"


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def _coord(key, mult: int, origin: float, step: float):
    """A thousand places in a tile; further keys go to further tiles, so that the
    area grows with the table and places are not shared ever more densely."""
    tile = (key % 300_000 / 1000).cast("long") if origin < 0 else (key / 300_000).cast("long") % 100
    return F.lit(origin) + ((key * mult) % 1000).cast("double") * F.lit(step) + tile.cast("double") * F.lit(0.4 if origin < 0 else 0.3)


def _k():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def _status(k):
    return (
        F.when(k % 3 == 0, F.lit("STOPPED_AT"))
        .when(k % 3 == 1, F.lit("IN_TRANSIT_TO"))
        .otherwise(F.lit("INCOMING_AT"))
    )


def _route_id():
    """Six routes for each event type, so that top-k reports really cut."""
    return F.concat(F.col("event_type"), F.lit("-"), (F.col("user_id") % ROUTES_PER_EVENT).cast("string"))


def _snapshot(ts):
    return (F.floor(F.unix_seconds(ts) / SNAPSHOT_S) * SNAPSHOT_S).cast("long")


def positions_from_events(events: DataFrame) -> DataFrame:
    """Bronze positions from ``events`` plus re-delivered copies (every 10th
    event again, 5 s later, entity id suffixed 'd').  The JSON of an event is
    parsed once for the three columns made from it: a column of its own stays one,
    while an expression would be evaluated in each of them."""
    eid, k = F.col("event_id"), F.col("_json_k")
    ts = to_ts("ts")
    gone_gps = eid % 19 == 0
    base = events.withColumn("_json_k", _k()).select(
        _snapshot(ts).alias("feed_timestamp"),
        F.unix_seconds(ts).alias("ingest_timestamp"),
        eid.cast("string").alias("entity_id"),
        _null_if(eid % 29 == 0, F.col("user_id").cast("string")).alias("vehicle_id"),
        _null_if(eid % 13 == 0, F.concat(F.lit("T"), (eid % 400).cast("string"))).alias("trip_id"),
        _null_if(eid % 17 == 0, _route_id()).alias("route_id"),
        _null_if(eid % 7 == 0, (eid % 2).cast("int")).alias("direction_id"),
        _null_if(gone_gps, _coord(eid, 37, LAT0, LAT_STEP)).cast("float").alias("latitude"),
        _null_if(gone_gps, _coord(eid, 91, LON0, LON_STEP)).cast("float").alias("longitude"),
        (eid % 360).cast("float").alias("bearing"),
        F.col("value").cast("float").alias("speed"),
        _null_if(eid % 23 == 0, k % STOPS).alias("current_stop_sequence"),
        _null_if(eid % 11 == 0, F.concat(F.lit("P"), k.cast("string"))).alias("stop_id"),
        _status(k).alias("current_status"),
        _null_if(eid % 5 == 0, F.unix_seconds(ts) - 3).alias("vehicle_timestamp"),
        enum_name(F.when(eid % 10 < 9, eid % 10), OCCUPANCY_STATUS).alias("occupancy_status"),
        (eid % 10 == 0).alias("_copy"),
    )
    copies = base.where("_copy").select(
        *[
            (F.col("ingest_timestamp") + 5).alias(c)
            if c == "ingest_timestamp"
            else F.concat(F.col("entity_id"), F.lit("d")).alias(c)
            if c == "entity_id"
            else F.col(c)
            for c in POSITION_SCHEMA.names
        ]
    )
    return base.drop("_copy").unionByName(copies)


def positions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Bench-scale positions: vehicle = supplier, route = 'R' || partkey % 50,
    snapshot = ship date, stop sequence = quantity."""
    ship = to_ts("l_shipdate")
    return lineitem.select(
        F.unix_seconds(ship).alias("feed_timestamp"),
        F.unix_seconds(ship).alias("ingest_timestamp"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long")).alias(
            "entity_id"
        ),
        F.col("l_suppkey").cast("string").alias("vehicle_id"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.concat(F.lit("R"), (F.col("l_partkey") % 50).cast("string")).alias("route_id"),
        F.lit(None).cast("int").alias("direction_id"),
        _coord(F.col("l_suppkey"), 37, LAT0, LAT_STEP).cast("float").alias("latitude"),
        _coord(F.col("l_suppkey"), 91, LON0, LON_STEP).cast("float").alias("longitude"),
        F.lit(None).cast("float").alias("bearing"),
        F.lit(None).cast("float").alias("speed"),
        F.col("l_quantity").cast("int").alias("current_stop_sequence"),
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.lit(None).cast("string").alias("current_status"),
        F.lit(None).cast("long").alias("vehicle_timestamp"),
        F.lit(None).cast("string").alias("occupancy_status"),
    )


def _route_type(col):
    expr = F.lit(None).cast("int")
    kind = F.split_part(col, F.lit("-"), F.lit(1))
    for name, code in ROUTE_TYPE_BY_EVENT.items():
        expr = F.when(kind == name, F.lit(code)).otherwise(expr)
    return expr


def dim_route_from(route_ids: DataFrame) -> DataFrame:
    """SCD2 route dimension from a one-column frame of route ids: one current
    row per route plus one expired older version (must be filtered out)."""
    r = F.col("route_id")
    key = F.xxhash64(r)
    cur = route_ids.select(
        key.alias("route_key"),
        r,
        F.upper(r).alias("route_short_name"),
        F.concat(F.upper(r), F.lit(" LINE")).alias("route_long_name"),
        _route_type(r).alias("route_type"),
        F.upper(F.substring(r, 1, 3)).alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
        F.to_timestamp(F.lit(CURRENT_FROM)).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    old = route_ids.select(
        (key + 1).alias("route_key"),
        r,
        F.concat(F.lit("OLD "), F.upper(r)).alias("route_short_name"),
        F.lit("OLD LINE").alias("route_long_name"),
        F.lit(3).alias("route_type"),
        F.lit(None).cast("string").alias("route_color"),
        F.lit(None).cast("string").alias("route_text_color"),
        F.to_timestamp(F.lit(HISTORY_FROM)).alias("valid_from"),
        F.to_timestamp(F.lit(CURRENT_FROM)).alias("valid_to"),
        F.lit(False).alias("is_current"),
    )
    return cur.unionByName(old)


def dim_route_from_events(events: DataFrame) -> DataFrame:
    ids = events.where(F.col("event_type") != EXCLUDED_ROUTE).select(_route_id().alias("route_id")).distinct()
    return dim_route_from(ids)


def dim_route_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ids = lineitem.select(
        F.concat(F.lit("R"), (F.col("l_partkey") % 50).cast("string")).alias("route_id")
    ).distinct()
    return dim_route_from(ids)


def weather_from_events(events: DataFrame) -> DataFrame:
    """Observations: the 'error' events, three stations, condition NULL when k % 4 = 0."""
    k = _k()
    st = (F.col("user_id") % 3).cast("string")
    return events.where(F.col("event_type") == "error").select(
        F.concat(F.lit("S"), st).alias("station_id"),
        F.concat(F.lit("Station "), st).alias("station_name"),
        to_ts("ts").alias("observed_at"),
        F.col("value").alias("temperature_c"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), (k % 4).cast("string"))).alias(
            "condition"
        ),
        k.alias("humidity_pct"),
        k.cast("double").alias("wind_kmh"),
        (F.lit(100.0) + k.cast("double") / 10).alias("pressure_kpa"),
    )


def weather_from_orders(orders: DataFrame) -> DataFrame:
    """Bench-scale observations from ``orders`` (one per order, keyed by time)."""
    return orders.select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 3).cast("string")).alias("station_id"),
        F.lit(None).cast("string").alias("station_name"),
        (to_ts("o_orderdate") + F.make_interval(secs=(F.col("o_orderkey") % 86400).cast("int"))).alias(
            "observed_at"
        ),
        (F.col("o_totalprice") / 10000).alias("temperature_c"),
        F.col("o_orderpriority").alias("condition"),
        F.lit(None).cast("int").alias("humidity_pct"),
        (F.col("o_orderkey") % 50).cast("double").alias("wind_kmh"),
        F.lit(None).cast("double").alias("pressure_kpa"),
    )


def stops_from_supplier(supplier: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    return supplier.select(
        sk.cast("string").alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        _coord(sk, 37, LAT0, LAT_STEP).alias("stop_lat"),
        _coord(sk, 91, LON0, LON_STEP).alias("stop_lon"),
    )


def restrictions_from_part(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.select(
        pk.cast("string").alias("restriction_id"),
        F.col("p_name").alias("road"),
        F.col("p_type").alias("road_class"),
        _coord(pk, 53, LAT0, LAT_STEP).alias("latitude"),
        _coord(pk, 17, LON0, LON_STEP).alias("longitude"),
        (F.col("p_size") % 3 == 0).alias("planned"),
        (F.col("p_size") % 2 == 0).alias("expired"),
        F.col("p_name").alias("description"),
    )


def customer_current(customer: DataFrame) -> DataFrame:
    """SCD2 'current' side: key c_custkey, tracked name, segment, nation."""
    return customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


def customer_incoming(customer: DataFrame) -> DataFrame:
    """SCD2 'incoming' side: every 11th key gone, every 7th segment changed,
    nation as text (0 must equal '0'), every 13th key re-issued +1,000,000."""
    key = F.col("c_custkey")
    kept = customer.where(key % 11 != 0).select(
        key,
        "c_name",
        F.when(key % 7 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
    )
    new = customer.where(key % 13 == 0).select(
        (key + 1_000_000).alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
    )
    return kept.unionByName(new)


SCD2_KEY = "c_custkey"
SCD2_TRACKED = ["c_name", "c_mktsegment", "c_nationkey"]
SCD2_LOAD_TS = "2024-06-01 00:00:00"


def customer_history(customer: DataFrame) -> DataFrame:
    """SCD2 history: one open row per customer from 2024-01-01, plus a
    closed older version for every 5th customer."""
    cur = customer_current(customer).select(
        "*",
        F.to_timestamp(F.lit(CURRENT_FROM)).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    old = customer.where(F.col("c_custkey") % 5 == 0).select(
        "c_custkey",
        "c_name",
        F.lit("OLD").alias("c_mktsegment"),
        "c_nationkey",
        F.to_timestamp(F.lit(HISTORY_FROM)).alias("valid_from"),
        F.to_timestamp(F.lit(CURRENT_FROM)).alias("valid_to"),
        F.lit(False).alias("is_current"),
    )
    return cur.unionByName(old)


# Markers replaced by raw backslashes in generated JSON text.
BAD_BACKSLASH_MARK = "~BS~"
VALID_ESCAPE_MARK = "~VS~"
DOC_SIZE = 100


def restriction_docs(part: DataFrame) -> DataFrame:
    """``{"Closure": [...]}`` documents (one per line, at most DOC_SIZE
    closures each) with blank/zero times, text coordinates, JSON booleans, a
    lone backslash (every 7th) and an escaped one before a letter (every 11th)."""
    pk = F.col("p_partkey")
    desc = (
        F.when(pk % 7 == 0, F.concat(F.col("p_name"), F.lit(f" Water {BAD_BACKSLASH_MARK} Sewer")))
        .when(pk % 11 == 0, F.concat(F.col("p_name"), F.lit(f" {VALID_ESCAPE_MARK}S")))
        .otherwise(F.col("p_name"))
    )
    start = (
        F.when(pk % 4 == 0, F.lit(""))
        .when(pk % 4 == 1, F.lit(None))
        .otherwise((F.lit(1_700_000_000_000) + pk * 3_600_000).cast("string"))
    )
    end = F.when(pk % 3 == 0, F.lit(0)).otherwise(F.lit(1_800_000_000_000) + pk * 60_000)
    lat = F.when(pk % 13 == 0, F.lit("")).otherwise(_coord(pk, 53, LAT0, LAT_STEP).cast("string"))
    closure = F.struct(
        pk.cast("string").alias("id"),
        F.col("p_name").alias("road"),
        F.col("p_type").alias("roadClass"),
        lat.alias("latitude"),
        _coord(pk, 17, LON0, LON_STEP).alias("longitude"),
        (F.col("p_size") % 3 == 0).alias("planned"),
        (F.col("p_size") % 2 == 0).alias("expired"),
        start.alias("startTime"),
        end.alias("endTime"),
        desc.alias("description"),
    )
    docs = part.groupBy((pk / DOC_SIZE).cast("long").alias("_doc")).agg(
        F.collect_list(closure).alias("Closure")
    )
    text = F.to_json(F.struct("Closure"))
    # Java replacement text: a doubled backslash yields one literal backslash.
    text = F.regexp_replace(text, BAD_BACKSLASH_MARK, r"\\")
    text = F.regexp_replace(text, VALID_ESCAPE_MARK, r"\\\\")
    return docs.select(text.alias("value"))


def weather_docs(events: DataFrame) -> DataFrame:
    """GeoJSON current-conditions documents, one per 'error' event; every 5th
    has no wind object at all."""
    k = _k()
    st = (F.col("user_id") % 3).cast("string")
    en = lambda c: F.struct(c.alias("en"))
    val = lambda c: F.struct(en(c).alias("value"))
    cond = F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), (k % 4).cast("string")))
    cc = F.struct(
        en(F.date_format(to_ts("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).alias("timestamp"),
        val(F.col("value")).alias("temperature"),
        en(cond).alias("condition"),
        val(k).alias("relativeHumidity"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.struct(val(k.cast("double")).alias("speed"))).alias("wind"),
        val(F.lit(100.0) + k.cast("double") / 10).alias("pressure"),
    )
    props = F.struct(
        F.concat(F.lit("S"), st).alias("identifier"),
        en(F.concat(F.lit("Station "), st)).alias("name"),
        cc.alias("currentConditions"),
    )
    return events.where(F.col("event_type") == "error").select(F.to_json(F.struct(props.alias("properties"))).alias("value"))


def stops_csv_rows(supplier: DataFrame) -> DataFrame:
    """stops.txt content as text columns: BOM before the first header name,
    names with commas, blank codes, coordinates with trailing zeros."""
    sk = F.col("s_suppkey")
    return supplier.select(
        sk.cast("string").alias("﻿stop_id"),
        F.when(sk % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), sk.cast("string"))).alias("stop_code"),
        F.concat(F.col("s_name"), F.lit(", Centre")).alias("stop_name"),
        F.format_string("%.6f", _coord(sk, 37, LAT0, LAT_STEP)).alias("stop_lat"),
        F.format_string("%.6f", _coord(sk, 91, LON0, LON_STEP)).alias("stop_lon"),
        (sk % 3).cast("string").alias("wheelchair_boarding"),
    )


FEED_GROUP = 50


def feed_messages(events: DataFrame) -> DataFrame:
    """Feed snapshots shaped like ``FeedMessage``: the positions of one
    snapshot hour, in messages of at most FEED_GROUP entities; every 31st
    entity carries no vehicle (skipped by flattening); enums as numbers."""
    pos = positions_from_events(events).where(~F.col("entity_id").endswith("d"))
    pos = pos.withColumn("_eid", F.col("entity_id").cast("long"))
    status_num = (
        F.when(F.col("current_status") == "INCOMING_AT", F.lit("0"))
        .when(F.col("current_status") == "STOPPED_AT", F.lit("1"))
        .when(F.col("current_status") == "IN_TRANSIT_TO", F.lit("2"))
    )
    vehicle = F.struct(
        F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
        F.struct(
            F.col("trip_id").alias("trip_id"),
            F.col("route_id").alias("route_id"),
            F.col("direction_id").alias("direction_id"),
        ).alias("trip"),
        F.when(
            F.col("latitude").isNotNull(),
            F.struct(
                F.col("latitude").alias("latitude"),
                F.col("longitude").alias("longitude"),
                F.col("bearing").alias("bearing"),
                F.col("speed").alias("speed"),
            ),
        ).alias("position"),
        F.col("current_stop_sequence").alias("current_stop_sequence"),
        F.col("stop_id").alias("stop_id"),
        status_num.alias("current_status"),
        F.col("vehicle_timestamp").alias("timestamp"),
        F.create_map(*[F.lit(x) for k, v in OCCUPANCY_STATUS.items() for x in (v, str(k))])[F.col("occupancy_status")].alias("occupancy_status"),
    )
    entity = F.struct(
        F.col("entity_id").alias("id"),
        F.when(F.col("_eid") % 31 != 0, vehicle).alias("vehicle"),
    )
    return pos.groupBy("feed_timestamp", (F.col("_eid") / FEED_GROUP).cast("long").alias("_grp")).agg(
        F.struct(F.col("feed_timestamp").alias("timestamp")).alias("header"),
        F.collect_list(entity).alias("entity"),
        F.max("ingest_timestamp").alias("ingest_timestamp"),
    ).drop("_grp", "feed_timestamp")


def write_stream_files(
    positions: DataFrame, path: str, sentinel_after_s: int | None = None, files_per_range: int = 4
) -> None:
    """Position records as JSON lines, written as four time ranges (cut at the
    quartiles of the snapshot times, one aggregate row) one after
    the other (one write job each, ``files_per_range`` tasks and files per
    job), so file modification order follows snapshot-time order between
    ranges; plus an optional one-row sentinel ``sentinel_after_s`` after
    the last snapshot."""
    from headway.sources.messages import to_records

    t = F.col("feed_timestamp")
    q = positions.agg(F.percentile_approx(t, [0.25, 0.5, 0.75]).alias("q")).first()["q"] or []
    ends = sorted(set(q))
    for lo, hi in zip([None, *ends], [*ends, None], strict=True):
        inside = F.lit(True) if lo is None else t >= lo
        part = positions.where(inside if hi is None else inside & (t < hi))
        to_records(part).select(F.col("value").cast("string").alias("value")).repartition(
            files_per_range
        ).write.mode("append").text(path)
    if sentinel_after_s is not None:
        last = positions.agg(F.max("feed_timestamp").alias("feed_timestamp"))
        sentinel = last.select(
            *[
                (F.col("feed_timestamp") + sentinel_after_s).alias(c)
                if c in ("feed_timestamp", "ingest_timestamp")
                else F.lit("sentinel").alias(c)
                if c in ("entity_id", "vehicle_id")
                else F.lit(None).cast(t).alias(c)
                for c, t in ((f.name, f.dataType) for f in POSITION_SCHEMA.fields)
            ]
        )
        # a single aggregate row
        to_records(sentinel).select(F.col("value").cast("string").alias("value")).write.mode("append").text(path)


def routes_txt_rows(events: DataFrame, version: int) -> DataFrame:
    """routes.txt content (all text) from the event types: version 1 lacks
    'signup'; version 2 lacks 'error', renames 'view' and adds 'signup'."""
    r = F.col("route_id")
    ids = events.select(F.col("event_type").alias("route_id")).distinct()
    ids = ids.where(r != ("signup" if version == 1 else "error"))
    long_name = F.concat(F.upper(r), F.lit(" LINE"))
    if version == 2:
        long_name = F.when(r == "view", F.lit("VIEW LINE 2")).otherwise(long_name)
    return ids.select(
        r,
        F.upper(r).alias("route_short_name"),
        long_name.alias("route_long_name"),
        F.coalesce(_route_type(r).cast("string"), F.lit("")).alias("route_type"),
        F.upper(F.substring(r, 1, 3)).alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
    )


def clustered_times(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(asked, observations) whose times crowd into 16 seconds, but for a few
    observations of fifty years earlier."""
    day = F.lit("2024-01-10 00:00:00").cast("timestamp")
    inside = lambda us: F.timestamp_micros(F.unix_micros(day) + us % 16_000_000)
    us = F.unix_micros(to_ts("ts"))
    asked = events.select("event_id", inside(us * 7).alias("event_time"))
    w = weather_from_events(events)
    old = F.lit("1974-01-01 00:00:00").cast("timestamp")
    seen = F.when(F.col("humidity_pct") == 0, old).otherwise(inside(F.unix_micros("observed_at")))
    return asked, w.select("station_id", seen.alias("observed_at"), "temperature_c")


def planted_pairs(events: DataFrame) -> DataFrame:
    """Rows shaped like the events mart, with NULL routes and times and pairs of a vehicle with itself."""
    eid = F.col("event_id")
    return events.select(
        _null_if(eid % 17 == 0, _route_id()).alias("route_id"),
        _null_if(eid % 40 == 0, to_ts("ts")).alias("event_time"),
        _null_if(eid % 9 == 0, F.col("user_id").cast("string")).alias("vehicle_id_a"),
        (F.col("user_id") + F.when(eid % 50 == 0, 0).otherwise(1)).cast("string").alias("vehicle_id_b"),
    )


def planted_stops(events: DataFrame) -> DataFrame:
    """Stop ids with NULLs and repeats."""
    return events.select(_null_if(F.col("event_id") % 33 == 0, (F.col("event_id") % 900).cast("string")).alias("stop_id"))


def trips_csv_rows(orders: DataFrame) -> DataFrame:
    """trips.txt content as text columns, with blanks."""
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("trip_id"),
        F.concat(F.lit("R"), (F.col("o_custkey") % 50).cast("string")).alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
        F.when(key % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("To, "), F.col("o_orderstatus"))).alias("trip_headsign"),
        F.when(key % 5 == 0, F.lit("")).otherwise((key % 2).cast("string")).alias("direction_id"),
        F.lit("").alias("shape_id"),
    )
