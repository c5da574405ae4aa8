"""Bunching on a stream (ST8).

``lag`` is not allowed on streams, and a snapshot is only complete once no
more of its rows can arrive.  ``closed_snapshots`` keeps each open snapshot's rows
as state, one for each vehicle, and gives them out when the watermark passes the
snapshot: an append-mode aggregation, so Spark's own checkpoint holds what is open,
a restarted query goes on with it, and state leaves the store with its snapshot.
Rows for a snapshot that is already closed are late and dropped by the watermark.

``run_stream_bunching`` runs the batch silver and detector functions on the
snapshots that closed in a micro-batch and writes their events under the batch's
id, so that a batch that is run again overwrites its own output.  A micro-batch
reads its new rows and the state of what it closes; nothing is staged, listed or
read back, however long the stream has been running.  The result equals the batch
job over the same non-late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.bunching import detect_bunching
from headway.plans.silver import silver_positions


def closed_snapshots(positions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The rows of snapshots that the watermark (``delay`` behind the newest
    ``feed_timestamp``) has passed, de-duplicated as the batch job does (A1).

    State holds one row for each (vehicle, snapshot) that is open: the first by
    ingest time, entity id and then the other columns.  Re-delivered copies are
    combined in each task before the shuffle, so a crash loop's copies of one key
    cost a row each task.  A row without a ``feed_timestamp`` belongs to no
    snapshot and is left out, as the batch job's cleaning does.  All rows of a
    snapshot are given out in the same micro-batch.
    """
    first = ["ingest_timestamp", "entity_id"]
    rest = [c for c in positions.columns if c not in (*first, "vehicle_id", "feed_timestamp")]
    timed = positions.where("feed_timestamp is not null").withColumn("_snapshot", F.timestamp_seconds("feed_timestamp"))
    kept = (
        timed.withWatermark("_snapshot", delay)
        .groupBy("_snapshot", "feed_timestamp", "vehicle_id")
        .agg(F.min(F.struct(*first, *rest)).alias("_row"))
    )
    return kept.select(*[F.col(c) if c in ("vehicle_id", "feed_timestamp") else F.col(f"_row.{c}") for c in positions.columns])


def run_stream_bunching(
    positions: DataFrame,
    dim_route: DataFrame,
    events_path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    trigger: str | None = "availableNow",
    method: str = "split",
) -> StreamingQuery:
    """Start the stream; events land in ``events_path`` (parquet, a folder
    ``batch_id=`` for each micro-batch that closed snapshots)."""

    def close(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # the state store must not be asked twice in one batch
        try:
            if not rows.isEmpty():
                events = detect_bunching(silver_positions(rows, dim_route), method=method)
                events.write.mode("overwrite").parquet(f"{events_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    w = closed_snapshots(positions, delay).writeStream.outputMode("append").foreachBatch(close)
    w = w.option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def read_stream_events(spark: SparkSession, events_path: str) -> DataFrame:
    return spark.read.parquet(events_path).drop("batch_id")
