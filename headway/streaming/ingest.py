"""Streaming ingest of position records (ST1-ST7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.positions import flatten_feed, parse_positions
from headway.schemas import FEED_SCHEMA
from headway.sources.files import archive_time
from headway.sources.parts import compact_parts, put_parts
from headway.sources.tables import with_bronze_partitions

# Processing-time trigger of the live ingest.
DEFAULT_TRIGGER = "30 seconds"


def read_position_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    schema=None,
) -> DataFrame:
    """Stream of raw records with a ``value`` column (ST1).

    ``kafka`` subscribes to ``topic`` from the earliest offset on the first
    run; later runs resume from the checkpoint.  ``text`` reads files whose
    lines are JSON values (the same records, for tests and file drops).
    Other file formats (``json``, ``parquet``, ``csv``) need ``schema`` (file
    streams do not infer one); e.g. ``POSITION_SCHEMA`` to read position rows
    directly, without ``ingest``.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        for k, v in opts.items():
            r = r.option(k, v)
        return r.load()
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def ingest(raw: DataFrame, drop_unparsed: bool = False) -> DataFrame:
    """Stateless parse of record values into the 16 position columns (ST2)."""
    return parse_positions(raw, "value", drop_unparsed=drop_unparsed)


def run_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    fmt: str = "parquet",
    partition: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append sink with a checkpoint (ST3).  ``trigger="availableNow"``
    processes what is there and stops (bounded backfill, ST5); otherwise a
    processing-time trigger runs until stopped (``awaitTermination``, ST4).
    Rows are laid out by ``date=/hour=`` of their ingest time."""
    out = with_bronze_partitions(stream) if partition else stream
    w = out.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition:
        w = w.partitionBy("date", "hour")
    if query_name:
        w = w.queryName(query_name)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(path)


PERIOD = "ingest_period"
# Partition values of the periods.
PERIODS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def run_compacted_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    compact_over: int = 4,
    every: str = "hour",
) -> StreamingQuery:
    """Append sink whose files follow its volume, not its triggers (S8, ST3); read it with ``parts.read_parts``.

    A micro-batch is rebalanced by the period (``every``, an hour or a day) of its ingest
    time, so it adds a file for each period (more only for large ones), committed at once
    under the batch's number and the query's id: a retried batch is not added twice, and a
    query on another checkpoint adds to the table.  Periods with more than
    ``compact_over`` batches are rewritten into large files as soon as a batch comes
    that has no rows of them, so a period is rewritten about once.  Rows without an
    ingest time are a period of their own.  The manifest, some 100 bytes a period, is
    read and written by each batch.
    """
    written_as = PERIODS[every]

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch.withColumn(PERIOD, F.date_format(F.timestamp_seconds(F.col("ingest_timestamp")), written_as))
        still_open = put_parts(rows, path, PERIOD, batch_id, replaces=lambda value: False, sort_within=["feed_timestamp"], writer=writer)
        compact_parts(spark, path, PERIOD, sort_within=["feed_timestamp"], folders_over=compact_over, but=still_open)

    w = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def archive_stream(spark: SparkSession, root: str, pattern: str = "*.json.gz", files_per_trigger: int | None = None):
    """Archive files as a stream of snapshots with their file time (ST5, ST6)."""
    r = (
        spark.readStream.schema(FEED_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    df = r.json(root).withColumn("path", F.col("_metadata.file_path"))
    t = archive_time("path")
    return df.select(F.struct("header", "entity").alias("feed"), F.unix_seconds(t).alias("ingest_timestamp"))


def replay(
    spark: SparkSession,
    root: str,
    sink: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
    pace: str | None = None,
    pattern: str = "*.json.gz",
) -> StreamingQuery:
    """Replay an archive into bronze (ST5/ST6).  Default: everything as fast
    as possible (``availableNow``).  With ``files_per_trigger`` and ``pace``
    (e.g. "20 seconds") it releases a fixed number of snapshots per trigger,
    which paces the rate, not exact gaps."""
    snaps = archive_stream(spark, root, pattern, files_per_trigger)
    rows = flatten_feed(snaps, feed_col="feed")
    return run_ingest(rows, sink, checkpoint, trigger=pace or "availableNow")


def with_event_time(stream: DataFrame, epoch_col: str = "feed_timestamp", name: str = "event_time") -> DataFrame:
    return stream.withColumn(name, F.timestamp_seconds(F.col(epoch_col)))


def dedup_stream(
    stream: DataFrame,
    keys: Sequence[str] = ("vehicle_id", "feed_timestamp"),
    time_col: str = "event_time",
    delay: str = "10 minutes",
) -> DataFrame:
    """Drop re-delivered rows across micro-batches and restarts (ST7).

    State per key lives until the watermark passes the key's event time plus
    ``delay``, so it stays bounded; rows later than the watermark are dropped.
    """
    if time_col not in stream.columns:
        stream = with_event_time(stream, name=time_col)
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))
