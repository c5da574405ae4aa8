import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from headway.schemas import POSITION_SCHEMA, STOP_TYPES
from headway.sources.files import (
    gunzipped,
    read_archive,
    read_gtfs_csv,
    read_restrictions,
    read_weather,
    rebuild_bronze,
    type_gtfs,
)
from headway.sources.tables import (
    export_csv,
    full_refresh,
    insert_if_absent,
    latest_version,
    read_bronze,
    read_snapshot,
    sql_on_path,
    write_bronze,
    write_snapshot,
    write_table,
)


def _snapshot(ts, vehicles):
    return {
        "header": {"timestamp": ts},
        "entity": [
            {"id": f"e{v}", "vehicle": {"vehicle": {"id": v}, "trip": {"route_id": "504"},
                                      "position": {"latitude": 43.6, "longitude": -79.4},
                                      "current_stop_sequence": seq}}
            for v, seq in vehicles
        ],
    }


def _write_archive(root):
    names = {"20260813T010000": 1786582800, "20260813T005940": 1786582780, "20260813T010020": 1786582820}
    for name, ts in names.items():
        d = os.path.join(root, "date=2026-08-13", f"hour={name[9:11]}")
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, f"{name}.json.gz"), "wt") as f:
            f.write(json.dumps(_snapshot(ts, [("1", 5), ("2", 5)])))
    return names


def test_archive_name_to_time_and_order(spark, tmp_dir):
    names = _write_archive(tmp_dir)
    a = read_archive(spark, tmp_dir).orderBy("file_time")
    got = [(os.path.basename(r["path"]), r["file_time"].replace(tzinfo=None)) for r in a.collect()]
    assert [n for n, _ in got] == [f"{n}.json.gz" for n in sorted(names)]
    assert got[1][1] == dt.datetime(2026, 8, 13, 1, 0, 0)


def test_rebuild_bronze_from_archive(spark, tmp_dir):
    _write_archive(tmp_dir)
    rows = rebuild_bronze(read_archive(spark, tmp_dir))
    assert rows.count() == 6
    r = rows.where("feed_timestamp = 1786582800 AND vehicle_id = '1'").first()
    assert r["ingest_timestamp"] == 1786582800 and r["route_id"] == "504"


def test_snapshot_versions_stay_readable(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snap")
    assert write_snapshot(spark.range(1000).withColumn("sq", F.col("id") * F.col("id")), path) == 0
    assert write_snapshot(spark.range(500).withColumn("sq", F.col("id") * F.col("id")), path) == 1
    assert read_snapshot(spark, path).count() == 500
    assert read_snapshot(spark, path, version=0).count() == 1000
    assert sql_on_path(spark, path, query="SELECT count(*) AS n FROM {t} WHERE version = 0").first()["n"] == 1000


def test_gtfs_csv_bom_quotes_and_types(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stops.txt")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('stop_id,stop_code,stop_name,stop_lat,stop_lon,wheelchair_boarding\n')
        f.write('1,,"Main St, West",43.650000,-79.380000,1\n')
        f.write('2,C2,"Say ""hi""",43.7,-79.4,\n')
    df = type_gtfs(read_gtfs_csv(spark, p), STOP_TYPES)
    rows = {r["stop_id"]: r for r in df.collect()}
    assert df.columns[0] == "stop_id"
    assert rows["1"]["stop_code"] is None and rows["1"]["stop_name"] == "Main St, West"
    assert rows["1"]["stop_lat"] == 43.65 and rows["2"]["stop_name"] == 'Say "hi"'
    assert rows["1"]["wheelchair_boarding"] == 1 and rows["2"]["wheelchair_boarding"] is None


def test_restrictions_with_broken_backslash(spark, tmp_dir):
    doc = (
        '{"Closure":[{"id":"R1","road":"King","roadClass":"Major","latitude":"43.65","longitude":"-79.38",'
        '"planned":true,"expired":false,"startTime":"1700000000000","endTime":0,'
        '"description":"Water \\ Sewer"},'
        '{"id":"R2","latitude":"","longitude":"","planned":"false","expired":"true","startTime":"",'
        '"description":"ok \\\\S"}]}'
    )
    p = os.path.join(tmp_dir, "closures.json")
    with open(p, "w") as f:
        f.write(doc)
    rows = {r["restriction_id"]: r for r in read_restrictions(spark, p).collect()}
    r1, r2 = rows["R1"], rows["R2"]
    assert r1["description"] == "Water \\ Sewer" and r2["description"] == "ok \\S"
    assert r1["planned"] is True and r1["expired"] is False and r2["planned"] is False and r2["expired"] is True
    assert r1["latitude"] == 43.65 and r2["latitude"] is None
    assert r1["end_time"] is None and r2["start_time"] is None and r1["start_time"] is not None


def test_weather_missing_objects_are_null(spark, tmp_dir):
    d = {"properties": {"identifier": "st-1", "name": {"en": "Central"},
                        "currentConditions": {"timestamp": {"en": "2026-08-13T01:00:00Z"},
                                              "temperature": {"value": {"en": 21.5}},
                                              "condition": {"en": "Cloudy"}}}}
    p = os.path.join(tmp_dir, "w.json")
    with open(p, "w") as f:
        json.dump(d, f, indent=2)
    r = read_weather(spark, p).first()
    assert r["station_id"] == "st-1" and r["temperature_c"] == 21.5 and r["wind_kmh"] is None
    assert r["observed_at"].replace(tzinfo=None) == dt.datetime(2026, 8, 13, 1, 0, 0)


def test_insert_if_absent_first_write_wins(spark):
    target = spark.createDataFrame([("S", 1, 10.0)], "station_id string, t int, temp double")
    incoming = spark.createDataFrame([("S", 1, 99.0), ("S", 2, 5.0), ("S", 2, 6.0)], "station_id string, t int, temp double")
    got = sorted(tuple(r) for r in insert_if_absent(target, incoming, ["station_id", "t"]).collect())
    assert got == [("S", 2, 5.0)]


def test_full_refresh_blank_to_null_and_key_check(spark, tmp_dir):
    df = spark.createDataFrame([("t1", ""), ("t2", "x")], "trip_id string, shape_id string")
    full_refresh(df, os.path.join(tmp_dir, "trips"), keys=["trip_id"])
    back = read_snapshot(spark, os.path.join(tmp_dir, "trips"))
    assert back.where("shape_id IS NULL").count() == 1
    dup = spark.createDataFrame([("t1", "a"), ("t1", "b")], "trip_id string, shape_id string")
    try:
        full_refresh(dup, os.path.join(tmp_dir, "trips2"), keys=["trip_id"])
        raised = False
    except ValueError:
        raised = True
    assert raised


def test_export_csv_single_file(spark, tmp_dir):
    out = os.path.join(tmp_dir, "report")
    export_csv(spark.createDataFrame([("504", 3)], "route_id string, n int"), out, single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1


def test_versions_are_found_by_their_folders(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    rows = spark.range(3)
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, t)
    assert [write_snapshot(df, t) for df in (rows, rows.where("id > 9"), rows.where("id > 0"))] == [0, 1, 2]
    assert [read_snapshot(spark, t, v).count() for v in (0, 1, 2, None)] == [3, 0, 2, 2]
    # an unreadable file is an error, not a missing table, and nothing is overwritten
    with open(os.path.join(t, "version=2", "part-bad.parquet"), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017
        read_snapshot(spark, t).count()
    assert latest_version(spark, t) == 2 and write_snapshot(rows, t) == 3
    assert read_snapshot(spark, t, 0).count() == 3


def test_full_rewrite_drops_old_partitions(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    rows = spark.range(20).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 2 + 1).cast("string")).alias("date"))
    write_table(rows, t, partition_by=["date"])
    write_table(rows.where("date = '2024-01-02'"), t, partition_by=["date"])
    assert spark.read.parquet(t).count() == 10
    write_table(rows.where("id = 0"), t, partition_by=["date"], keep_other_partitions=True)
    assert spark.read.parquet(t).count() == 11


def test_files_follow_the_partitions_not_the_tasks(spark, tmp_dir):
    t = os.path.join(tmp_dir, "bronze")
    rows = spark.range(16 * 500).repartition(16).select(
        *[(F.col("id") % 48 * 3600).cast(f.dataType).alias(f.name) if f.name == "ingest_timestamp" else F.lit(None).cast(f.dataType).alias(f.name) for f in POSITION_SCHEMA.fields]
    )
    write_bronze(rows, t)
    files = [f for _, _, names in os.walk(t) for f in names if f.endswith(".parquet")]
    assert 48 <= len(files) <= 60, len(files)
    assert read_bronze(spark, t).count() == 8000


def test_full_refresh_checks_before_it_replaces(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    good = spark.createDataFrame([("a", ""), ("b", "x")], "k string, v string")
    full_refresh(good, t, keys=["k"])
    for bad in (good.unionByName(good), good.where("false")):
        with pytest.raises(ValueError):
            full_refresh(bad, t, keys=["k"])
    assert sorted((r["k"], r["v"]) for r in read_snapshot(spark, t).collect()) == [("a", None), ("b", "x")]
    full_refresh(good.where("false"), t, keys=["k"], allow_empty=True)
    assert read_snapshot(spark, t).count() == 0


def test_gzip_content_is_unpacked(spark):
    import gzip as gz

    df = spark.createDataFrame([(gz.compress(b"abc"),), (b"abc",), (None,), (b"",)], "c binary")
    got = [r["x"] if r["x"] is None else bytes(r["x"]) for r in df.select(gunzipped("c").alias("x")).collect()]
    assert got == [b"abc", b"abc", None, b""]


def test_only_committed_versions_exist(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    rows = spark.range(6)
    bad = rows.select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_snapshot(bad, t)
    assert latest_version(spark, t) is None and not [n for n in os.listdir(t) if not n.startswith(".")]
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, t)
    assert write_snapshot(rows, t) == 0
    # a folder that a dead writer left half renamed: no version, not the next number either
    os.makedirs(os.path.join(t, "version=1"))
    assert latest_version(spark, t) == 0 and read_snapshot(spark, t).count() == 6
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, t, 1)
    assert write_snapshot(rows.where("id > 2"), t) == 2
    assert read_snapshot(spark, t).count() == 3 and read_snapshot(spark, t, 0).count() == 6
    # complete, but its pointer was never set: still the version before
    write_table(rows.where("id = 0"), os.path.join(t, "version=3"))
    assert latest_version(spark, t) == 2


def test_two_writers_cannot_take_one_version(spark, tmp_dir):
    from headway.sources import versions

    t = os.path.join(tmp_dir, "t")
    folder = versions.stage(spark.range(2), t, lambda df, to: df.write.parquet(to))
    write_snapshot(spark.range(9), t)
    with pytest.raises(Exception, match="exist"):
        versions.rename_new(spark, folder, versions.version_path(t, 0))
    assert read_snapshot(spark, t).count() == 9


def test_readers_keep_their_version_through_a_refresh(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    full_refresh(spark.range(5), t)
    open_reader = read_snapshot(spark, t)
    full_refresh(spark.range(7), t)
    assert open_reader.count() == 5 and read_snapshot(spark, t).count() == 7
    full_refresh(spark.range(8), t)
    assert sorted(n for n in os.listdir(t) if n.startswith("version=")) == ["version=1", "version=2"]
