import os

import pytest
from pyspark.sql import functions as F

from headway.plans import marts as mt
from headway.plans.rollup import add_increment, read_rollup
from headway.sources.parts import compact_parts, last_step, part_folders, put_parts, read_parts


def _events(spark, rows):
    schema = "route_id string, route_short_name string, route_long_name string, event_time string, stop_sequence_gap int"
    return spark.createDataFrame(rows, schema).withColumn("event_time", F.to_timestamp("event_time"))


def _row(time, gap, route="r1", name="One"):
    return (route, name, None, time, gap)


FIRST = [_row("2024-01-05 10:10:00", 0), _row("2024-01-05 10:50:00", 1), _row("2024-02-01 00:00:00", None), _row(None, 1)]
LATE = [_row("2024-01-05 10:59:59", 1), _row("2024-03-01 07:00:00", 3, None, None), _row("2024-03-01 07:00:00", 3, None, None), _row(None, 0)]


def _rows(df):
    return sorted(map(str, df.select("route_id", "event_hour", "bunching_event_count", "avg_stop_sequence_gap").collect()))


def _files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_increments_equal_one_rebuild_and_leave_other_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rollup")
    assert _rows(read_rollup(spark, path)) == []
    add_increment(_events(spark, FIRST), path, 0)
    february = [f for f in _files(path) if "2024-02" in f]
    stamps = [os.stat(f).st_mtime_ns for f in february]
    written = add_increment(_events(spark, LATE), path, 1)
    assert sorted(written) == ["event_month=2024-01", "event_month=2024-03", "event_month=__HIVE_DEFAULT_PARTITION__"]
    expected = _rows(mt.mart_bunching_hourly(_events(spark, FIRST + LATE)))
    assert _rows(read_rollup(spark, path)) == expected
    assert february and [os.stat(f).st_mtime_ns for f in february] == stamps
    # a repeated increment and one without events change nothing
    assert add_increment(_events(spark, LATE), path, 1) == []
    assert add_increment(_events(spark, []), path, 2) == []
    assert _rows(read_rollup(spark, path)) == expected and last_step(spark, path) == 2


def test_a_failed_increment_is_repeated_whole(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rollup")
    add_increment(_events(spark, FIRST), path, 0)
    before = _rows(read_rollup(spark, path))
    broken = _events(spark, LATE).withColumn("route_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        add_increment(broken, path, 1)
    assert _rows(read_rollup(spark, path)) == before and not [d for d in os.listdir(path) if d.startswith("_partial")]
    add_increment(_events(spark, LATE), path, 1)
    assert _rows(read_rollup(spark, path)) == _rows(mt.mart_bunching_hourly(_events(spark, FIRST + LATE)))


def test_ranges_prune_months_of_the_rollup(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rollup")
    add_increment(_events(spark, FIRST + LATE), path, 0)
    ranged = mt.time_filter(read_rollup(spark, path), "event_hour", "2024-03-01 00:00:00", "2024-03-02 00:00:00")
    assert ranged.count() == 1
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "event_month" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_parts_are_added_to_compacted_and_read_by_old_readers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "parts")
    for step in range(4):
        rows = spark.createDataFrame([(step, "a"), (10 + step, "b")] if step else [(0, "a")], "n int, p string")
        put_parts(rows, path, "p", step, replaces=lambda value: value == "p=b")
    assert sorted(r["n"] for r in read_parts(spark, path).collect()) == [0, 1, 2, 3, 13]
    old = read_parts(spark, path)
    assert compact_parts(spark, path, "p") == ["p=a"]
    assert len(part_folders(spark, path)["p=a"]) == 1
    assert sorted(r["n"] for r in read_parts(spark, path).collect()) == sorted(r["n"] for r in old.collect()) == [0, 1, 2, 3, 13]
    assert compact_parts(spark, path, "p") == []
    put_parts(spark.createDataFrame([(7, "a")], "n int, p string"), path, "p", 0, replaces=lambda value: False, writer="other")
    assert read_parts(spark, path).where("n = 7").count() == 1 and last_step(spark, path) == 3 and last_step(spark, path, "other") == 0
    put_parts(spark.createDataFrame([(0, "a"), (1, "a"), (2, "a"), (3, "a")], "n int, p string"), path, "p", 1, writer="other")
    put_parts(spark.createDataFrame([], "n int, p string"), path, "p", 6, clear=["p=b"])
    assert sorted(r["n"] for r in read_parts(spark, path).collect()) == [0, 1, 2, 3]
