import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from headway.operators.positions import clean_positions, dedup, flatten_feed, parse_positions
from headway.schemas import FEED_SCHEMA, POSITION_COLUMNS
from headway.sources.messages import to_records
from headway.sources.tables import write_bronze

FULL = {
    "id": "e1",
    "vehicle": {
        "vehicle": {"id": "1234"},
        "trip": {"trip_id": "trip_001", "route_id": "504", "direction_id": 0},
        "position": {"latitude": 43.6532, "longitude": -79.3832, "bearing": 90.0, "speed": 8.3},
        "current_stop_sequence": 12,
        "stop_id": None,
        "current_status": "2",
        "timestamp": 1700000000,
        "occupancy_status": "1",
    },
}
SPARSE = {"id": "e2", "vehicle": {"vehicle": {"id": "5678"}, "position": {"latitude": 43.7, "longitude": -79.4}}}
NO_VEHICLE = {"id": "alert-1", "vehicle": None}


def feed(spark):
    return spark.createDataFrame(
        [({"timestamp": 1700000000}, [FULL, SPARSE, NO_VEHICLE], 1700000005)],
        StructType([*FEED_SCHEMA.fields, StructField("ingest_timestamp", LongType())]),
    )


def test_flatten_full_and_sparse_entity(spark):
    rows = {r["vehicle_id"]: r for r in flatten_feed(feed(spark)).collect()}
    assert set(rows) == {"1234", "5678"}  # entity without vehicle skipped
    f = rows["1234"]
    assert f["feed_timestamp"] == 1700000000 and f["ingest_timestamp"] == 1700000005
    assert (f["route_id"], f["trip_id"], f["direction_id"]) == ("504", "trip_001", 0)
    assert abs(f["latitude"] - 43.6532) < 1e-4 and f["bearing"] == 90.0
    assert f["current_stop_sequence"] == 12
    assert f["current_status"] == "IN_TRANSIT_TO" and f["occupancy_status"] == "MANY_SEATS_AVAILABLE"
    s = rows["5678"]
    assert s["route_id"] is None and s["trip_id"] is None and s["current_status"] is None
    assert s["bearing"] is None and s["latitude"] is not None


def test_bronze_parquet_has_exactly_the_declared_columns(spark, tmp_dir):
    pos = flatten_feed(feed(spark))
    path = os.path.join(tmp_dir, "bronze")
    write_bronze(pos, path)
    back = spark.read.parquet(path)
    assert [c for c in back.columns if c not in ("date", "hour")] == POSITION_COLUMNS
    got = back.select(F.col("date").cast("string").alias("d"), "hour").distinct().collect()
    assert [(r["d"], r["hour"]) for r in got] == [("2023-11-14", 22)]


def test_record_shape_and_parse_roundtrip(spark):
    pos = flatten_feed(feed(spark))
    rec = {bytes(r["key"]).decode(): bytes(r["value"]).decode() for r in to_records(pos).collect()}
    assert set(rec) == {"1234", "5678"}
    assert '"route_id":null' in rec["5678"]  # nulls written out
    back = parse_positions(to_records(pos))
    assert back.exceptAll(pos).count() == 0 and pos.exceptAll(back).count() == 0


def test_records_key_is_empty_for_null_vehicle(spark):
    pos = spark.createDataFrame([(None, 1)], "vehicle_id string, feed_timestamp long")
    pos = pos.select(*[F.col(c) if c in pos.columns else F.lit(None).alias(c) for c in POSITION_COLUMNS])
    assert bytes(to_records(pos).first()["key"]) == b""


def test_parse_bad_text_gives_all_null_row(spark):
    df = spark.createDataFrame([("not json",), ('{"vehicle_id": "7"}',)], "value string")
    rows = parse_positions(df).collect()
    assert all(v is None for v in rows[0])
    assert parse_positions(df, drop_unparsed=True).count() == 1


def _pos(spark, rows):
    schema = "vehicle_id string, feed_timestamp long, ingest_timestamp long, entity_id string, latitude float"
    return spark.createDataFrame(rows, schema)


def test_dedup_is_deterministic_and_nulls_collapse(spark):
    df = _pos(
        spark,
        [
            ("v1", 10, 6, "b", None),
            ("v1", 10, 5, "z", 1.0),
            ("v1", 10, 5, "a", None),
            (None, 10, 7, "n1", 2.0),
            (None, 10, 8, "n2", 3.0),
        ],
    )
    got = {(r["vehicle_id"], r["entity_id"]) for r in dedup(df).collect()}
    assert got == {("v1", "a"), (None, "n1")}
    # prefer_valid keeps the row with a position even if it came later
    got = {(r["vehicle_id"], r["entity_id"]) for r in dedup(df, prefer_valid=["latitude"]).collect()}
    assert got == {("v1", "z"), (None, "n1")}


def test_dedup_invariant_under_input_order(spark):
    rows = [(f"v{i % 7}", i % 3, i, f"e{i}", None) for i in range(60)]
    a = dedup(_pos(spark, rows)).collect()
    b = dedup(_pos(spark, list(reversed(rows))).repartition(5)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_clean_keeps_nan_drops_null(spark):
    df = spark.createDataFrame(
        [(float("nan"), 1.0, "r", 1), (None, 1.0, "r", 1), (1.0, 1.0, None, 1)],
        "latitude double, longitude double, route_id string, current_stop_sequence int",
    )
    assert clean_positions(df).count() == 1


def test_blank_ids_become_null_only_when_asked(spark):
    ent = {"id": "e", "vehicle": {"vehicle": {"id": ""}, "trip": {"trip_id": "", "route_id": ""}}}
    df = spark.createDataFrame([({"timestamp": 1}, [ent], 2)], StructType([*FEED_SCHEMA.fields, StructField("ingest_timestamp", LongType())]))
    parity = flatten_feed(df).first()
    assert parity["route_id"] == "" and parity["vehicle_id"] == ""
    fixed = flatten_feed(df, blank_ids_as_null=True).first()
    assert fixed["route_id"] is None and fixed["vehicle_id"] is None and fixed["trip_id"] is None


def test_the_json_of_an_event_is_parsed_once(spark):
    import datetime as dt
    import io
    from contextlib import redirect_stdout

    from headway.plans.fixtures import positions_from_events

    day = dt.datetime(2024, 1, 1)
    rows = [(i, day, 7, "view", 1.0, k) for i, k in ((1, '{"k": 30}'), (23, '{"k": 4}'), (11, '{"k": 2}'), (2, None), (3, "no json"), (10, '{"k": 1}'))]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    pos = positions_from_events(events)
    got = {r["entity_id"]: (r["current_stop_sequence"], r["stop_id"], r["current_status"]) for r in pos.collect()}
    assert got == {
        "1": (5, "P30", "STOPPED_AT"), "23": (None, "P4", "IN_TRANSIT_TO"), "11": (2, None, "INCOMING_AT"), "2": (None, None, "INCOMING_AT"),
        "3": (None, None, "INCOMING_AT"), "10": (1, "P1", "IN_TRANSIT_TO"), "10d": (1, "P1", "IN_TRANSIT_TO"),
    }
    buf = io.StringIO()
    with redirect_stdout(buf):
        pos.explain()
    assert buf.getvalue().count("get_json_object") == 2  # the events and their copies
