"""The code paths a 100 TB run takes: shuffled joins instead of broadcasts,
hot keys, and property checks against brute force (hypothesis)."""

import datetime as dt
import io
import math
import time
from contextlib import redirect_stdout

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.bunching import detect_bunching
from headway.operators.joins import require_unique
from headway.operators.nearest import nearest_join
from headway.operators.positions import dedup, enrich_routes
from headway.operators.spatial import within_radius
from headway.plans.silver import bunching_events

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def shuffled(spark):
    """The session with broadcasts by size switched off."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)

    class Off:
        def __enter__(self):
            spark.conf.set(key, "-1")

        def __exit__(self, *_):
            spark.conf.set(key, before)

    return Off()


def test_nearest_shuffled_path_equals_broadcast_path(spark):
    left = spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=7 * i), "ab"[i % 2]) for i in range(300)], "lid int, lt timestamp, k string"
    )
    right = spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=31 * i + 3), "ab"[i % 2]) for i in range(40)], "rid int, rt timestamp, k string"
    )
    for by in (None, ["k"]):
        a = nearest_join(left, right, "lt", "rt", by=by, right_cols=["rid"]).collect()
        with shuffled(spark):
            b = nearest_join(left, right, "lt", "rt", by=by, right_cols=["rid"], small_rows=39)  # one fewer than there are
            assert "BroadcastHashJoin" not in plan(b) and "explode" not in plan(b)
            assert sorted(map(tuple, a)) == sorted(map(tuple, b.collect()))


def test_spatial_and_enrich_shuffled_paths(spark):
    stops = spark.createDataFrame([(f"s{i}", 43.6 + i * 1e-4, -79.4) for i in range(50)], "stop_id string, stop_lat double, stop_lon double")
    restr = spark.createDataFrame([(f"r{i}", 43.6 + i * 5e-4, -79.4005) for i in range(10)], "restriction_id string, latitude double, longitude double")
    a = within_radius(stops, restr).collect()
    pos = spark.createDataFrame([("504", 1), ("9", 2)], "route_id string, x int")
    dim = spark.createDataFrame([("504", "504", "King", True)], "route_id string, route_short_name string, route_long_name string, is_current boolean")
    with shuffled(spark):
        b = within_radius(stops, restr)
        assert "BroadcastHashJoin" not in plan(b)
        assert sorted(map(tuple, a)) == sorted(map(tuple, b.collect()))
        e = enrich_routes(pos, dim)
        assert sorted((r["route_id"], r["route_short_name"]) for r in e.collect()) == [("504", "504"), ("9", None)]


def test_repeated_dimension_keys_are_an_error(spark):
    pos = spark.createDataFrame([("504", 1), (None, 2)], "route_id string, x int")
    rows = [("504", "a", "A", True), ("504", "b", "B", True), (None, "c", "C", True), (None, "d", "D", True)]
    dim = spark.createDataFrame(rows, "route_id string, route_short_name string, route_long_name string, is_current boolean")
    with pytest.raises(Exception, match="repeated key: 504"):
        enrich_routes(pos, dim).collect()
    assert enrich_routes(pos, dim.where("route_short_name != 'b'")).count() == 2
    assert enrich_routes(pos, dim, checked=False).count() == 3
    with pytest.raises(ValueError):
        require_unique(dim.where("is_current"), ["route_id"], "dim_route")


def test_dedup_hot_key_is_combined_map_side(spark):
    # a third of all rows are copies of one key
    rows = [("hot", 1, i, f"e{i:04d}") for i in range(600)] + [(f"v{i}", 1, i, f"e{i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "vehicle_id string, feed_timestamp long, ingest_timestamp long, entity_id string")
    d = dedup(df.repartition(8))
    shown = plan(d)
    assert "WindowGroupLimit" in shown.split("Exchange hashpartitioning")[1]  # before the shuffle, too
    hot = d.where("vehicle_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["entity_id"] == "e0000"


def test_split_detector_never_windows_a_whole_group(spark):
    df = spark.createDataFrame([("r", "R", 1, "a", 1)], "route_id string, route_short_name string, feed_timestamp long, vehicle_id string, current_stop_sequence int")
    p = plan(detect_bunching(df, method="split"))
    # every shuffle is by (route, snapshot, stop) or by (route, snapshot, opening-row key)
    keys = [seg.split(")")[0] for seg in p.split("hashpartitioning(")[1:]]
    assert any("current_stop_sequence" in k for k in keys)
    assert all("current_stop_sequence" in k or "_w" in k for k in keys), keys


times = st.lists(st.integers(min_value=0, max_value=20_000), min_size=0, max_size=25)


@settings(max_examples=12, deadline=None)
@given(lefts=st.lists(st.integers(min_value=-5_000, max_value=25_000), min_size=1, max_size=25), rights=times)
def test_nearest_property(spark, lefts, rights):
    left = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=t)) for i, t in enumerate(lefts)], "lid int, lt timestamp")
    right = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=t)) for i, t in enumerate(rights)], "rid int, rt timestamp")
    for bound in (0, 1000):
        found = nearest_join(left, right, "lt", "rt", right_cols=["rid"], tie_cols=["rt", "rid"], small_rows=bound)
        got = {r["lid"]: r["rid"] for r in found.collect()}
        for i, t in enumerate(lefts):
            cands = sorted((abs(t - rt), rt, j) for j, rt in enumerate(rights))
            assert got[i] == (cands[0][2] if cands else None)


def test_nearest_plans_of_many_slices_and_of_a_small_side(spark):
    left = spark.range(5000).select(F.col("id").alias("lid"), F.timestamp_seconds(F.col("id") * 7).alias("lt"))
    right = spark.range(900).select(F.col("id").alias("rid"), F.timestamp_seconds(F.col("id") * 31).alias("rt"))
    began = time.monotonic()
    many = nearest_join(left, right, "lt", "rt", right_cols=["rid"], slices=150, small_rows=0)
    assert len(plan(many)) < 20_000 and time.monotonic() - began < 60
    few = nearest_join(left, right, "lt", "rt", right_cols=["rid"])
    shown = plan(few)  # the left side is read once and moves nowhere
    assert "SortMergeJoin" not in shown and shown.count("Range (0, 5000") == 1
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))


def _hav(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(min(1.0, x)))


pts = st.lists(
    st.tuples(st.floats(min_value=43.60, max_value=43.62), st.floats(min_value=-79.42, max_value=-79.39)),
    min_size=0,
    max_size=20,
)


@settings(max_examples=10, deadline=None)
@given(a=pts, b=pts, radius=st.sampled_from([50.0, 150.0, 400.0]))
def test_spatial_property(spark, a, b, radius):
    s = spark.createDataFrame([(f"s{i}", x, y) for i, (x, y) in enumerate(a)], "stop_id string, stop_lat double, stop_lon double")
    r = spark.createDataFrame([(f"r{i}", x, y) for i, (x, y) in enumerate(b)], "restriction_id string, latitude double, longitude double")
    got = {(x["stop_id"], x["restriction_id"]) for x in within_radius(s, r, radius_m=radius).collect()}
    want = {
        (f"s{i}", f"r{j}")
        for i, (x1, y1) in enumerate(a)
        for j, (x2, y2) in enumerate(b)
        if _hav(x1, y1, x2, y2) <= radius
    }
    # pairs within 1 mm of the radius may differ by float rounding between engines
    border = {(f"s{i}", f"r{j}") for i, (x1, y1) in enumerate(a) for j, (x2, y2) in enumerate(b) if abs(_hav(x1, y1, x2, y2) - radius) < 1e-3}
    assert got - border == want - border


snap_rows = st.lists(
    st.tuples(
        st.sampled_from(["r1", "r2"]),
        st.integers(min_value=0, max_value=2),
        st.one_of(st.none(), st.sampled_from([f"v{i}" for i in range(12)])),
        st.integers(min_value=0, max_value=6),
    ),
    min_size=0,
    max_size=40,
)


@settings(max_examples=12, deadline=None)
@given(rows=snap_rows)
def test_split_detector_equals_window_property(spark, rows):
    df = spark.createDataFrame(
        [(r, r.upper(), ts, v, seq) for r, ts, v, seq in rows],
        "route_id string, route_short_name string, feed_timestamp long, vehicle_id string, current_stop_sequence int",
    )
    a = sorted(map(tuple, detect_bunching(df, method="window").collect()))
    b = sorted(map(tuple, detect_bunching(df, method="split").collect()))
    assert a == b


def test_one_shuffle_by_snapshot(spark, tmp_dir):
    rows = [(f"v{i % 40}", i // 40, i, f"e{i}", "AB"[i % 2], i % 12, 1.0, 2.0) for i in range(800)]
    bronze = spark.createDataFrame(
        rows + rows[:200],
        "vehicle_id string, feed_timestamp long, ingest_timestamp long, entity_id string, route_id string, current_stop_sequence int, latitude float, longitude float",
    )
    dim = spark.createDataFrame([("A", "A", "a", True)], "route_id string, route_short_name string, route_long_name string, is_current boolean")
    dim.coalesce(1).write.parquet(f"{tmp_dir}/dim")  # a stored dimension has a known size
    dim = spark.read.parquet(f"{tmp_dir}/dim")
    plain = sorted(map(str, bunching_events(bronze, dim).collect()))
    for method in ("split", "window"):
        df = bunching_events(bronze, dim, method=method, by_snapshot=True)
        shown = plan(df)
        assert shown.count("Exchange hashpartitioning(feed_timestamp") == 1
        assert shown.count("Exchange hashpartitioning(") == 2  # the other checks the dimension's keys
        assert sorted(map(str, df.collect())) == plain and plain
