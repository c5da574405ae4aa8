import os

import pytest
from pyspark.sql import functions as F

from headway.operators.bunching import detect_bunching
from headway.plans import marts as mt
from headway.plans import reports as rp
from headway.plans.silver import run_silver_job, silver_positions
from headway.schemas import POSITION_COLUMNS
from headway.sources.files import read_archive, write_archive
from headway.streaming.ingest import replay


def _positions(spark):
    rows = []
    for snap in range(3):
        t = 1_786_582_800 + snap * 3600
        for v, seq in (("a", 3), ("b", 3), ("c", 4), ("d", 9)):
            rows.append((t, t, f"{t}{v}", v, "504", seq))
        rows.append((t, t + 1, f"{t}ax", "a", "504", 3))  # re-delivery
    df = spark.createDataFrame(
        rows, "feed_timestamp long, ingest_timestamp long, entity_id string, vehicle_id string, route_id string, current_stop_sequence int"
    )
    df = df.withColumn("latitude", F.lit(43.6).cast("float")).withColumn("longitude", F.lit(-79.4).cast("float"))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in POSITION_COLUMNS])


def _dim(spark):
    return spark.createDataFrame(
        [("504", "504", "King", 0, "C1", "FFF", True), ("504", "OLD", "Old", 0, None, None, False)],
        "route_id string, route_short_name string, route_long_name string, route_type int, route_color string, "
        "route_text_color string, is_current boolean",
    )


def test_silver_job_writes_and_observes(spark, tmp_dir):
    pos, dim = _positions(spark), _dim(spark)
    m = run_silver_job(
        spark, pos, dim, os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "events"), load_ts="2026-08-13 02:00:00"
    )
    assert m == {"silver_rows": 12, "bunching_events": 6}
    ev = spark.read.parquet(os.path.join(tmp_dir, "events"))
    assert ev.where(F.col("detected_at").isNull()).count() == 0
    assert ev.select("route_short_name").distinct().first()[0] == "504"  # current row only
    assert sorted(os.listdir(os.path.join(tmp_dir, "silver")))[0].startswith("_") or any(
        d.startswith("date=") for d in os.listdir(os.path.join(tmp_dir, "silver"))
    )


def test_build_marts_written_and_reports(spark, tmp_dir):
    pos, dim = _positions(spark), _dim(spark)
    events = detect_bunching(silver_positions(pos, dim))
    weather = spark.createDataFrame(
        [("S1", None, "2026-08-13 01:10:00", 20.0, "Rain", None, 5.0, None)],
        "station_id string, station_name string, observed_at string, temperature_c double, condition string, humidity_pct int, wind_kmh double, pressure_kpa double",
    ).withColumn("observed_at", F.to_timestamp("observed_at"))
    out = mt.build_marts(
        spark, {"bunching_events": events, "dim_route": dim, "fact_weather": weather}, out_dir=tmp_dir
    )
    me, mh = out["mart_bunching_events"], out["mart_bunching_hourly"]
    assert me.count() == 6 and me.where("weather_condition = 'Rain'").count() == 6
    assert any(d.startswith("event_month=") for d in os.listdir(os.path.join(tmp_dir, "mart_bunching_events", "version=0")))
    assert mh.count() == 3 and mh.agg(F.sum("bunching_event_count")).first()[0] == 6
    assert rp.report_total(me).first()["value"] == 6
    assert rp.report_network_share(me, 4).first()["value"] == 25.0
    assert rp.report_network_share(me, dim).first()["value"] == 100.0
    assert [r["severity"] for r in rp.report_severity(me).collect()] == ["One stop apart", "Same stop"]
    assert rp.report_total(me, from_="2026-08-13 01:00:00", to="2026-08-13 01:00:00").first()["value"] == 2
    top = rp.report_top_detail(mh, weighted=True).first()
    assert top["route"] == "504" and top["bunching_events"] == 6 and top["avg_stop_gap"] == 0.5
    assert "weighted_avg_stop_gap" in rp.report_top_detail(mh, weighted=True).columns


def test_replay_archive_into_bronze(spark, tmp_dir):
    feeds = spark.createDataFrame(
        [
            ({"timestamp": 1786582800}, [{"id": "e1", "vehicle": {"vehicle": {"id": "7"}}}], "2026-08-13 01:00:00"),
            ({"timestamp": 1786582820}, [{"id": "e1", "vehicle": {"vehicle": {"id": "7"}}}], "2026-08-13 01:00:20"),
        ],
        "header struct<timestamp: bigint>, entity array<struct<id: string, vehicle: struct<vehicle: struct<id: string>>>>, file_time string",
    ).withColumn("file_time", F.to_timestamp("file_time"))
    root = os.path.join(tmp_dir, "raw")
    write_archive(feeds, root)
    assert read_archive(spark, root).count() == 2
    q = replay(spark, root, os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt"), files_per_trigger=1)
    q.awaitTermination()
    bronze = spark.read.parquet(os.path.join(tmp_dir, "bronze"))
    got = sorted((r["feed_timestamp"], r["ingest_timestamp"], r["vehicle_id"]) for r in bronze.collect())
    assert got == [(1786582800, 1786582800, "7"), (1786582820, 1786582820, "7")]


def test_dashboard_refresh_runs_all_panels(spark):
    pos, dim = _positions(spark), _dim(spark)
    events = detect_bunching(silver_positions(pos, dim))
    weather = spark.createDataFrame([("S1", "2026-08-13 01:10:00", 20.0)], "station_id string, observed_at string, temperature_c double")
    weather = weather.select(
        "station_id", F.lit(None).cast("string").alias("station_name"), F.to_timestamp("observed_at").alias("observed_at"),
        "temperature_c", F.lit("Rain").alias("condition"), F.lit(None).cast("int").alias("humidity_pct"),
        F.lit(None).cast("double").alias("wind_kmh"), F.lit(None).cast("double").alias("pressure_kpa"),
    )
    me = mt.mart_bunching_events(mt.stg_bunching_events(events), mt.stg_dim_route_current(dim), mt.stg_fact_weather(weather))
    got = rp.refresh(rp.panels(me, mt.mart_bunching_hourly(me), dim), parallelism=3)
    assert len(got) == 10 and got["total"][0]["value"] == 6
    assert got["by_mode"][0]["mode"] == "Streetcar" and got["by_condition"][0]["weather"] == "Rain"


def test_paced_replay_releases_one_snapshot_per_trigger(spark, tmp_dir):
    feeds = spark.createDataFrame(
        [({"timestamp": 1786582800 + 20 * i}, [{"id": "e1", "vehicle": {"vehicle": {"id": "7"}}}], f"2026-08-13 01:00:{20 * i:02d}") for i in range(3)],
        "header struct<timestamp: bigint>, entity array<struct<id: string, vehicle: struct<vehicle: struct<id: string>>>>, file_time string",
    ).withColumn("file_time", F.to_timestamp("file_time"))
    root = os.path.join(tmp_dir, "raw")
    write_archive(feeds, root)
    q = replay(spark, root, os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt"), files_per_trigger=1, pace="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(os.path.join(tmp_dir, "bronze")).count() == 3
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3


def test_marts_prune_months_and_bound_their_files(spark, tmp_dir):
    import io
    from contextlib import redirect_stdout

    routes = spark.createDataFrame([("504", "504", "King", True)], "route_id string, route_short_name string, route_long_name string, is_current boolean")
    dim = routes.select("*", F.lit(0).alias("route_type"), F.lit("F").alias("route_color"), F.lit("0").alias("route_text_color"))
    hours = spark.range(0, 24 * 365, 1, 8)
    events = hours.select(
        F.lit("504").alias("route_id"), F.lit("504").alias("route_short_name"), (F.col("id") * 3600 + 1704067200).alias("feed_timestamp"),
        F.lit("a").alias("vehicle_id_a"), F.lit("b").alias("vehicle_id_b"), (F.col("id") % 2).cast("int").alias("stop_sequence_gap"),
    )
    weather = hours.where("id % 50 = 0").select(
        F.lit("S").alias("station_id"), F.lit("S").alias("station_name"), F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias("observed_at"),
        F.lit(1.0).alias("temperature_c"), F.lit("Rain").alias("condition"), F.lit(1).alias("humidity_pct"), F.lit(1.0).alias("wind_kmh"), F.lit(1.0).alias("pressure_kpa"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marts = mt.build_marts(spark, {"bunching_events": events, "dim_route": dim, "fact_weather": weather}, out_dir=tmp_dir)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in ("mart_bunching_events", "mart_bunching_hourly"):
        files = [f for _, _, names in os.walk(os.path.join(tmp_dir, name)) for f in names if f.endswith(".parquet")]
        assert len(files) == 12, (name, len(files))
    me, mh = marts["mart_bunching_events"], marts["mart_bunching_hourly"]
    span = ("2024-02-20 00:00:00", "2024-03-02 00:00:00")
    for df in (
        rp.report_total(me, *span), rp.report_network_share(me, dim, *span), rp.report_top_routes(mh, 10, *span), rp.report_hourly_top8(mh, 8, *span),
        rp.report_by_condition(me, *span), rp.report_by_hour(me, *span), rp.report_by_mode(me, dim, *span), rp.report_severity(me, *span),
        rp.report_top_detail(mh, 15, *span), rp.report_recent(me, 200, *span),
    ):
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        filters = [line for line in buf.getvalue().splitlines() if line.startswith("PartitionFilters") and "event_month" in line]
        assert filters and all(">= 2024-02" in f and "<= 2024-03" in f for f in filters)
    assert rp.report_total(me, *span).first()["value"] == 11 * 24 + 1


def test_a_failed_rebuild_leaves_the_marts(spark, tmp_dir):
    dim = spark.createDataFrame([("504", "504", "King", 0, "F", "0", True)], "route_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string, is_current boolean")
    weather = spark.createDataFrame([], "station_id string, station_name string, observed_at timestamp, temperature_c double, condition string, humidity_pct int, wind_kmh double, pressure_kpa double")
    events = spark.createDataFrame([("504", "504", 1704067200, "a", "b", 0)], "route_id string, route_short_name string, feed_timestamp long, vehicle_id_a string, vehicle_id_b string, stop_sequence_gap int")
    tables = {"bunching_events": events, "dim_route": dim, "fact_weather": weather}
    mt.build_marts(spark, tables, out_dir=tmp_dir)
    with pytest.raises(Exception, match="repeated key"):
        mt.build_marts(spark, tables | {"dim_route": dim.unionByName(dim)}, out_dir=tmp_dir)
    marts = mt.read_marts(spark, tmp_dir)
    assert marts["mart_bunching_events"].count() == 1 and marts["mart_bunching_hourly"].count() == 1


def test_a_month_of_many_events_is_sorted_by_many_tasks(spark, tmp_dir, monkeypatch):
    """A single task used to sort a whole month, however many rows it had; many events of one time are dealt too."""
    import pyarrow.parquet as pq

    from headway.sources import tables as tb

    monkeypatch.setattr(tb, "SORTED_ROWS", 500)
    dim = spark.createDataFrame([("504", "504", "King", 0, "F", "0", True)], "route_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string, is_current boolean")
    weather = spark.createDataFrame([], "station_id string, station_name string, observed_at timestamp, temperature_c double, condition string, humidity_pct int, wind_kmh double, pressure_kpa double")
    events = spark.range(4000).select(
        F.lit("504").alias("route_id"), F.lit("504").alias("route_short_name"), (F.lit(1704067200) + (F.col("id") / 1000).cast("long") * 86400).alias("feed_timestamp"),
        F.col("id").cast("string").alias("vehicle_id_a"), F.lit("b").alias("vehicle_id_b"), F.lit(0).alias("stop_sequence_gap"),
    )
    marts = mt.build_marts(spark, {"bunching_events": events, "dim_route": dim, "fact_weather": weather}, out_dir=tmp_dir)
    files = [os.path.join(d, f) for d, _, names in os.walk(os.path.join(tmp_dir, "mart_bunching_events")) for f in names if f.endswith(".parquet")]
    rows = [pq.read_metadata(f).num_rows for f in files]
    assert sum(rows) == 4000 and len(rows) >= 7 and max(rows) <= 1000, rows
    assert marts["mart_bunching_events"].select("vehicle_id_a").distinct().count() == 4000
