"""The hourly rollup kept by increments (A4, S20): new events are added to stored
partial states, and only months with new events are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from headway.plans.marts import MONTH, month_of
from headway.sources.parts import last_step, put_parts, read_parts
from headway.sources.paths import folders, remove_folder
from headway.sources.tables import write_table

_KEYS = ["route_id", "route_short_name", "route_long_name", "event_hour", MONTH]
_STATES = ["events", "gap_sum", "gap_count"]

STATE_SCHEMA = StructType(
    [
        StructField("route_id", StringType()),
        StructField("route_short_name", StringType()),
        StructField("route_long_name", StringType()),
        StructField("event_hour", TimestampType()),
        *[StructField(s, LongType()) for s in _STATES],
        StructField(MONTH, StringType()),
    ]
)


def hourly_states(mart_events: DataFrame) -> DataFrame:
    """Mergeable state of each (route, hour): events, and sum and count of the gaps that are not NULL."""
    hour = F.date_trunc("hour", "event_time")
    keys = [*_KEYS[:3], hour.alias("event_hour"), month_of(hour).alias(MONTH)]
    return mart_events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(F.col("stop_sequence_gap").cast("long")), F.lit(0)).alias("gap_sum"),
        F.count("stop_sequence_gap").alias("gap_count"),
    )


def add_increment(new_events: DataFrame, path: str, increment: int) -> list[str]:
    """Add mart events that no earlier increment held to the rollup; the months written.

    Increments are numbered upwards; one given again after it was committed changes
    nothing, so a failed run is repeated as a whole.  Late events of an old hour are
    merged into it.  Only the months of the new events are read and written; the
    files of all others stay.  What is read grows with the increment and its months'
    hours, not with the events before it.

    Names are part of the key, as in the full rebuild: events that carry another name
    of their route make a row of their own.  Events without a time make up a month of
    their own (NULL).  An increment without events is committed and writes no month.
    """
    spark, path = new_events.sparkSession, path.rstrip("/")
    if increment <= last_step(spark, path):
        return []
    partial = f"{path}/_partial-{uuid.uuid4().hex}"
    try:
        write_table(hourly_states(new_events), partial, partition_by=[MONTH])
        months = [m for m in folders(spark, partial) if m.startswith(f"{MONTH}=")]
        added = spark.read.schema(STATE_SCHEMA).parquet(partial)
        stored = read_parts(spark, path, STATE_SCHEMA, months)
        merged = stored.unionByName(added).groupBy(*_KEYS).agg(*[F.sum(s).alias(s) for s in _STATES])
        out = merged.select(*STATE_SCHEMA.names)
        return put_parts(out, path, MONTH, increment, sort_within=["event_hour", "route_short_name", "route_id"])
    finally:
        remove_folder(spark, partial)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The hourly mart from the stored states, with ``event_month``, by which ``time_filter`` prunes."""
    states = read_parts(spark, path, STATE_SCHEMA)
    return states.select(
        *_KEYS[:4],
        F.col("events").alias("bunching_event_count"),
        F.try_divide(F.col("gap_sum").cast("double"), "gap_count").alias("avg_stop_sequence_gap"),
        MONTH,
    )
