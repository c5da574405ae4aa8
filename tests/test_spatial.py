import math
import random

import pytest

from headway.functions.geo import haversine_m
from headway.operators.spatial import within_radius

EARTH_M = 6371000.0


def chord_m(lat1, lon1, lat2, lon2):
    """Great-circle distance from the chord between two points on the sphere."""

    def xyz(lat, lon):
        lat, lon = math.radians(lat), math.radians(lon)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    return 2 * EARTH_M * math.asin(min(1.0, math.dist(xyz(lat1, lon1), xyz(lat2, lon2)) / 2))


def pairs(spark, stops, restr, radius=150.0, **kw):
    s = spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double")
    r = spark.createDataFrame(restr, "restriction_id string, latitude double, longitude double")
    return {(x["stop_id"], x["restriction_id"]) for x in within_radius(s, r, radius_m=radius, **kw).collect()}


def test_distance_along_equator_and_meridian(spark):
    # a quarter of a great circle, and a thousandth of a degree of the equator
    quarter = math.pi / 2 * EARTH_M
    rows = [(0.0, 10.0, 0.0, 100.0, quarter), (0.0, 7.0, 90.0, 7.0, quarter), (0.0, 3.0, 0.0, 3.001, quarter / 90_000), (51.0, 9.0, 51.0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, want double")
    for r in df.select(haversine_m("a", "b", "c", "d").alias("m"), "want").collect():
        assert r["m"] == pytest.approx(r["want"], rel=1e-9, abs=1e-6)


def test_radius_is_a_sharp_bound(spark):
    # on a meridian one degree is EARTH_M * pi / 180 metres
    degree = EARTH_M * math.pi / 180
    stops = [("inside", 52.0 + 149.9 / degree, 13.4), ("outside", 52.0 + 150.1 / degree, 13.4), ("far", -52.0, 13.4)]
    assert pairs(spark, stops, [("r", 52.0, 13.4)]) == {("inside", "r")}


def test_exact_grid_finds_what_a_fixed_grid_misses(spark):
    # at 60 degrees north 0.0022 degrees of longitude are about 122 m, but more than two fixed cells
    stops, restr = [("s", 60.0, 24.9994)], [("r", 60.0, 25.0016)]
    assert 120 < chord_m(60.0, 24.9994, 60.0, 25.0016) < 125
    assert pairs(spark, stops, restr) == {("s", "r")}
    assert pairs(spark, stops, restr, compat_grid=True) == set()


def test_equals_all_pairs_at_random(spark):
    rnd = random.Random(23)
    point = lambda: (-33.9 + rnd.random() * 0.04, 18.4 + rnd.random() * 0.06)
    stops = [(f"s{i}", *point()) for i in range(140)] + [("nowhere", None, 18.4)]
    restr = [(f"r{i}", *point()) for i in range(90)] + [("nolat", None, 18.41), ("nolon", -33.9, None)]
    for radius in (90.0, 150.0, 800.0):
        want = {
            (s, r)
            for s, a, b in stops
            for r, c, d in restr
            if None not in (a, b, c, d) and chord_m(a, b, c, d) <= radius
        }
        assert want
        for side in ("centers", "points"):
            assert pairs(spark, stops, restr, radius, replicate=side) == want
    with pytest.raises(ValueError):
        pairs(spark, stops, restr, replicate="auto")


def test_dense_cells_are_split_and_lose_no_pair(spark):
    from headway.operators.spatial import split_dense

    rnd = random.Random(5)
    # one corner holds most stops; the rest is spread thin
    stops = [(f"s{i}", 10.0 + rnd.random() * 1e-4, 20.0 + rnd.random() * 1e-4) for i in range(1500)]
    stops += [(f"t{i}", 10.0 + rnd.random() * 0.05, 20.0 + rnd.random() * 0.05) for i in range(300)]
    restr = [(f"r{i}", 10.0 + rnd.random() * 0.01, 20.0 + rnd.random() * 0.01) for i in range(60)] + [("near", 10.0005, 20.0005), ("edge", 9.9992, 20.0)]
    plain = pairs(spark, stops, restr)
    assert len(plain) > 1500
    for side in ("centers", "points"):
        for most in (1, 100, 10_000):
            assert pairs(spark, stops, restr, replicate=side, dense_rows=most) == plain
    rows = spark.range(10_000).selectExpr("id", "if(id < 9000, 0, id) AS k")
    copied = spark.range(100).selectExpr("if(id < 50, 0, id + 9000) AS k", "id AS c")
    dealt, everywhere = split_dense(rows, copied, ["k"], "id", 500)
    sizes = [r["count"] for r in dealt.groupBy("k", "_share").count().collect()]
    assert sum(sizes) == 10_000 and 300 < max(sizes) < 700
    assert everywhere.where("k = 0").count() == 50 * 18 and everywhere.where("k > 0").count() == 50
