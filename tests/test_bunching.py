import random

from headway.operators.bunching import detect_bunching

SCHEMA = "route_id string, route_short_name string, feed_timestamp long, vehicle_id string, current_stop_sequence int"


def events(spark, rows, method):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(
        (r["route_id"], r["feed_timestamp"], r["vehicle_id_a"], r["vehicle_id_b"], r["stop_sequence_gap"])
        for r in detect_bunching(df, method=method).collect()
    )


def both(spark, rows):
    a, b = events(spark, rows, "window"), events(spark, rows, "split")
    assert a == b
    return a


def test_three_vehicles_at_one_stop_give_two_events(spark):
    rows = [("r", "R", 1, v, 5) for v in ("a", "b", "c")]
    assert both(spark, rows) == [("r", 1, "a", "b", 0), ("r", 1, "b", "c", 0)]


def test_gap_one_counts_gap_two_does_not(spark):
    rows = [("r", "R", 1, "a", 1), ("r", "R", 1, "b", 2), ("r", "R", 1, "c", 4)]
    assert both(spark, rows) == [("r", 1, "a", "b", 1)]


def test_null_vehicle_blocks_pairs_across_it(spark):
    rows = [("r", "R", 1, "a", 1), ("r", "R", 1, None, 2), ("r", "R", 1, "b", 2)]
    # order: a(1), NULL(2), b(2): neither a-NULL nor NULL-b is an event
    assert both(spark, rows) == []


def test_self_pair_dropped_and_groups_separate(spark):
    rows = [
        ("r", "R", 1, "a", 3),
        ("r", "R", 1, "a", 3),
        ("r", "R", 2, "b", 3),
        ("q", "Q", 1, "c", 3),
    ]
    assert both(spark, rows) == []


def test_keep_and_extra_partition_columns(spark):
    df = spark.createDataFrame(
        [("r", "R", 1, "a", 1, 0, "s1"), ("r", "R", 1, "b", 1, 1, "s2"), ("r", "R", 1, "c", 2, 0, "s3")],
        SCHEMA + ", direction_id int, stop_id string",
    )
    for m in ("window", "split"):
        got = detect_bunching(df, partition=("route_id", "feed_timestamp", "direction_id"), keep=["stop_id"], method=m)
        assert sorted((r["vehicle_id_a"], r["vehicle_id_b"], r["stop_id"]) for r in got.collect()) == [("a", "c", "s3")]


def test_split_equals_window_on_random_snapshots(spark):
    rnd = random.Random(7)
    rows = []
    for route in ("r1", "r2", "r3"):
        for ts in range(4):
            vehicles = rnd.sample(range(40), rnd.randint(0, 25))
            for v in vehicles:
                vid = None if rnd.random() < 0.05 else f"v{v}"
                rows.append((route, route.upper(), ts, vid, rnd.randint(0, 12)))
    got = both(spark, rows)
    assert len(got) > 20


def test_wider_gaps_and_missing_stops_agree(spark):
    rnd = random.Random(8)
    rows = [
        (rnd.choice("AB"), "n", rnd.choice([1, 2]), rnd.choice(["v1", "v2", "v3", "v4", None]), rnd.choice([None, 1, 2, 4, 5, 9, 12]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "route_id string, route_short_name string, feed_timestamp long, vehicle_id string, current_stop_sequence int")
    for gap in (0, 1, 3, 5):
        split, window = (sorted(map(str, detect_bunching(df, max_gap=gap, method=m).collect())) for m in ("split", "window"))
        assert split == window and split
        assert all(0 <= int(r.rsplit("=", 1)[1].rstrip(")")) <= gap for r in split)
