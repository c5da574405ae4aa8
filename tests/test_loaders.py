import json
import os

import pytest

from headway.plans.loaders import load_gtfs_dimensions, load_observations, load_restriction_snapshot
from headway.sources.tables import read_snapshot


def _gtfs(d, routes, stops, trips):
    os.makedirs(d, exist_ok=True)
    for name, text in (("routes.txt", routes), ("stops.txt", stops), ("trips.txt", trips)):
        with open(os.path.join(d, name), "w", encoding="utf-8-sig") as f:
            f.write(text)


HDR_R = "route_id,route_short_name,route_long_name,route_type,route_color,route_text_color\n"
HDR_S = "stop_id,stop_code,stop_name,stop_lat,stop_lon,wheelchair_boarding\n"
HDR_T = "trip_id,route_id,service_id,trip_headsign,direction_id,shape_id\n"


def test_gtfs_loads_are_scd2_and_versioned(spark, tmp_dir):
    g1, g2, out = (os.path.join(tmp_dir, x) for x in ("g1", "g2", "out"))
    _gtfs(g1, HDR_R + "504,504,King,0,,\n999,999,Gone,3,,\n", HDR_S + "1,,A,43.65,-79.38,\n", HDR_T + "t1,504,s,King,0,\n")
    c1 = load_gtfs_dimensions(spark, g1, out, "2024-01-01 00:00:00")
    assert c1["dim_route"] == {"inserted": 2, "expired": 0, "unchanged": 0}
    _gtfs(g2, HDR_R + "504,504,King Car,0,,\n504,504,King Streetcar,0,,\n", HDR_S + "1,,A,43.650000,-79.380000,\n", HDR_T + "t2,504,s,King,1,\n")
    c2 = load_gtfs_dimensions(spark, g2, out, "2024-06-01 00:00:00")
    assert c2["dim_route"] == {"inserted": 1, "expired": 2, "unchanged": 0}
    assert c2["dim_stop"] == {"inserted": 0, "expired": 0, "unchanged": 1}  # 43.65 == "43.650000"
    routes = read_snapshot(spark, os.path.join(out, "dim_route"))
    assert routes.count() == 3 and routes.where("is_current").count() == 1
    assert routes.where("is_current").first()["route_long_name"] == "King Streetcar"  # last row wins
    assert read_snapshot(spark, os.path.join(out, "dim_route"), version=0).count() == 2
    assert [r["trip_id"] for r in read_snapshot(spark, os.path.join(out, "dim_trip")).collect()] == ["t2"]


def test_restrictions_and_pairs(spark, tmp_dir):
    stops = spark.createDataFrame(
        [("s1", 43.6501, -79.3801, True), ("s2", 43.70, -79.42, True), ("s3", None, None, True)],
        "stop_id string, stop_lat double, stop_lon double, is_current boolean",
    )
    p = os.path.join(tmp_dir, "closures.json")
    with open(p, "w") as f:
        f.write('{"Closure":[{"id":"R1","latitude":"43.65","longitude":"-79.38","expired":true,'
                '"description":"Water \\ Sewer"},{"id":"R2","latitude":"","longitude":""}]}')
    load_restriction_snapshot(spark, p, stops, tmp_dir, "2024-01-01 00:00:00")
    assert read_snapshot(spark, os.path.join(tmp_dir, "road_restrictions")).count() == 2
    pairs = read_snapshot(spark, os.path.join(tmp_dir, "stops_near_restrictions")).collect()
    assert [(r["stop_id"], r["restriction_id"]) for r in pairs] == [("s1", "R1")]
    load_restriction_snapshot(spark, p, stops, os.path.join(tmp_dir, "b"), "2024-01-01", active_only=True)
    assert read_snapshot(spark, os.path.join(tmp_dir, "b", "stops_near_restrictions")).count() == 0


def test_weather_insert_once(spark, tmp_dir):
    def doc(ts, temp):
        return {"properties": {"identifier": "st-1", "name": {"en": "Central"},
                               "currentConditions": {"timestamp": {"en": ts}, "temperature": {"value": {"en": temp}}}}}

    d1, d2, table = (os.path.join(tmp_dir, x) for x in ("d1", "d2", "fw"))
    for d, docs in ((d1, [doc("2024-01-01T00:00:00Z", 1.0)]), (d2, [doc("2024-01-01T00:00:00Z", 9.0), doc("2024-01-01T01:00:00Z", 2.0)])):
        os.makedirs(d)
        with open(os.path.join(d, "w.json"), "w") as f:
            f.write("\n".join(json.dumps(x) for x in docs))
    assert load_observations(spark, d1, table, "2024-01-01 00:05:00", multi_line=False) == 1
    assert load_observations(spark, d2, table, "2024-01-01 01:05:00", multi_line=False) == 1
    rows = sorted((r["observed_at"].hour, r["temperature_c"]) for r in spark.read.parquet(table).collect())
    assert rows == [(0, 1.0), (1, 2.0)]  # first write wins


def test_a_bad_restriction_document_leaves_the_tables_alone(spark, tmp_dir):
    stops = spark.createDataFrame([("s1", 43.6501, -79.3801, True)], "stop_id string, stop_lat double, stop_lon double, is_current boolean")
    p = os.path.join(tmp_dir, "closures.json")
    with open(p, "w") as f:
        f.write('{"Closure":[{"id":"R1","latitude":"43.65","longitude":"-79.38","description":"C:\\users and \\u00e9"}]}')
    load_restriction_snapshot(spark, p, stops, tmp_dir, "2024-01-01 00:00:00")
    for bad in ("not json at all", '{"Closed":[]}', '{"Closure":'):
        with open(p, "w") as f:
            f.write(bad)
        with pytest.raises(Exception, match="not a restriction document"):
            load_restriction_snapshot(spark, p, stops, tmp_dir, "2024-01-02 00:00:00")
    rows = read_snapshot(spark, os.path.join(tmp_dir, "road_restrictions")).collect()
    assert [(r["restriction_id"], r["description"]) for r in rows] == [("R1", "C:\\users and \u00e9")]
    with open(p, "w") as f:
        f.write('{"Closure":[]}')
    with pytest.raises(ValueError, match="no rows"):
        load_restriction_snapshot(spark, p, stops, tmp_dir, "2024-01-03 00:00:00")
    assert read_snapshot(spark, os.path.join(tmp_dir, "stops_near_restrictions")).count() == 1
