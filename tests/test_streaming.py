import os

from pyspark.sql import functions as F

from headway.operators.bunching import detect_bunching
from headway.plans.silver import silver_positions
from headway.schemas import POSITION_COLUMNS
from headway.sources.messages import to_records
from headway.streaming.bunching import read_stream_events, run_stream_bunching
from headway.streaming.ingest import dedup_stream, ingest, read_position_stream, run_ingest


def _positions(spark, rows):
    df = spark.createDataFrame(
        rows, "feed_timestamp long, ingest_timestamp long, entity_id string, vehicle_id string, route_id string, current_stop_sequence int"
    )
    df = df.withColumn("latitude", F.lit(43.6).cast("float")).withColumn("longitude", F.lit(-79.4).cast("float"))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in POSITION_COLUMNS])


def _write_files(df, path, n_files):
    ts = sorted({r["feed_timestamp"] for r in df.select("feed_timestamp").distinct().collect()})
    chunks = [ts[i::n_files] for i in range(n_files)]
    for i in range(n_files):
        lo, hi = ts[len(ts) * i // n_files], ts[min(len(ts) - 1, len(ts) * (i + 1) // n_files - 1)]
        part = df.where((F.col("feed_timestamp") >= lo) & (F.col("feed_timestamp") <= hi))
        to_records(part).select(F.col("value").cast("string").alias("value")).coalesce(1).write.mode("append").text(path)
    return chunks


def _rows():
    rows = []
    for snap in range(6):
        t = 1_700_000_000 + snap * 20
        for v, seq in (("a", 3), ("b", 3), ("c", 4)):
            rows.append((t, t + 1, f"{t}{v}", v, "504", seq))
            rows.append((t, t + 2, f"{t}{v}x", v, "504", seq))  # re-delivery
    return rows


def test_stream_ingest_equals_batch(spark, tmp_dir):
    pos = _positions(spark, _rows())
    src = os.path.join(tmp_dir, "src")
    _write_files(pos, src, 3)
    q = run_ingest(
        ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=1)),
        os.path.join(tmp_dir, "sink"),
        os.path.join(tmp_dir, "ckpt"),
        trigger="availableNow",
    )
    q.awaitTermination()
    back = spark.read.parquet(os.path.join(tmp_dir, "sink")).drop("date", "hour")
    assert back.exceptAll(pos).count() == 0 and pos.exceptAll(back).count() == 0


def test_stream_dedup_drops_redelivery(spark, tmp_dir):
    rows = [r for r in _rows() if r[0] < 1_700_000_060]  # 3 snapshots x 3 vehicles x 2 copies = 18
    pos = _positions(spark, rows)
    src = os.path.join(tmp_dir, "src")
    _write_files(pos, src, 3)
    s = dedup_stream(ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=1)))
    q = s.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert pos.count() == 18 and spark.table("dedup_out").count() == 9


def test_stream_bunching_equals_batch(spark, tmp_dir):
    rows = _rows()
    sentinel = (1_800_000_000, 1_800_000_000, "sentinel", "sentinel", None, None)
    pos = _positions(spark, rows + [sentinel])
    dim = spark.createDataFrame([("504", "504", "King", True)], "route_id string, route_short_name string, route_long_name string, is_current boolean")
    src = os.path.join(tmp_dir, "src")
    _write_files(pos, src, 3)
    out = os.path.join(tmp_dir, "events")
    q = run_stream_bunching(
        ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=1)),
        dim, out, os.path.join(tmp_dir, "ckpt"), delay="30 seconds",
    )
    q.awaitTermination()
    got = read_stream_events(spark, out)
    want = detect_bunching(silver_positions(pos, dim))
    assert got.count() == 12  # a-b (gap 0) and b-c (gap 1) in each of 6 snapshots
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_parquet_position_stream_with_schema(spark, tmp_dir):
    from headway.operators.positions import conform_positions
    from headway.schemas import POSITION_SCHEMA

    pos = conform_positions(_positions(spark, _rows()))
    src = os.path.join(tmp_dir, "pq")
    pos.write.parquet(src)
    s = read_position_stream(spark, fmt="parquet", path=src, schema=POSITION_SCHEMA)
    q = s.writeStream.format("memory").queryName("pq_positions").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("pq_positions").count() == pos.count()


def test_stream_bunching_survives_a_restart(spark, tmp_dir):
    """Two queries, one after the other, on one checkpoint and its state: no event is lost."""
    rows = _rows()
    cut = sorted({r[0] for r in rows})[3]
    dim = spark.createDataFrame([("504", "504", "King", True)], "route_id string, route_short_name string, route_long_name string, is_current boolean")
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "events", "ckpt"))
    parts = [[r for r in rows if r[0] < cut], [r for r in rows if r[0] >= cut], [(1_800_000_000, 1_800_000_000, "sentinel", "sentinel", None, None)]]
    for part in parts:
        _write_files(_positions(spark, part), src, 1)
        stream = ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=1))
        q = run_stream_bunching(stream, dim, out, ckpt, delay="30 seconds")
        q.awaitTermination()
        assert q.exception() is None
    got, want = read_stream_events(spark, out), detect_bunching(silver_positions(_positions(spark, rows), dim))
    assert got.count() == 12
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a run without new rows changes nothing, and nothing is kept beside the events and Spark's own checkpoint
    q = run_stream_bunching(stream, dim, out, ckpt, delay="30 seconds")
    q.awaitTermination()
    assert read_stream_events(spark, out).count() == 12
    assert sorted(d for d in os.listdir(ckpt) if not d.startswith(".")) == ["commits", "metadata", "offsets", "sources", "state"]


def test_closed_snapshots_close_once_and_drop_late_rows(spark, tmp_dir):
    """Each batch: new rows, what closes; a late row of a closed snapshot changes nothing, state does not grow."""
    from headway.operators.positions import dedup
    from headway.streaming.bunching import closed_snapshots

    t0 = 1_700_000_000
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "closed", "ckpt"))
    batches = [[(t0 + 20 * s, t0 + 20 * s + k, f"e{k}", v, "504", 3) for v in "ab" for k in (2, 1)] for s in range(12)]
    late = [(t0, t0, "late", "a", "504", 9), (t0, t0, "late", "z", "504", 9)]
    batches[8] += late
    state = []
    for rows in [*batches, [(t0 + 10_000, t0 + 10_000, "sentinel", "s", None, None)]]:
        to_records(_positions(spark, rows)).select(F.col("value").cast("string").alias("value")).coalesce(1).write.mode("append").text(src)
        s = closed_snapshots(ingest(read_position_stream(spark, fmt="text", path=src, max_files_per_trigger=1)), "40 seconds")
        q = s.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
        q.awaitTermination()
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.parquet(out)
    want = dedup(_positions(spark, [r for b in batches for r in b if r not in late]))
    assert got.count() == 24 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert max(state) <= 8 and state[-1] == 1, state  # snapshots within the delay, two vehicles each; then the sentinel
