"""Bunching detector (W1): adjacent vehicles on one route in one snapshot that
are at most ``max_gap`` stops apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT_COLUMNS = [
    "route_id",
    "route_short_name",
    "feed_timestamp",
    "vehicle_id_a",
    "vehicle_id_b",
    "stop_sequence_gap",
]


def detect_bunching(
    silver: DataFrame,
    partition: Sequence[str] = ("route_id", "feed_timestamp"),
    max_gap: int = 1,
    keep: Sequence[str] = (),
    detected_at: Column | None = None,
    method: str = "split",
) -> DataFrame:
    """Pairs of vehicles adjacent in ``current_stop_sequence`` order within
    each ``partition`` group whose stop gap is ``<= max_gap``.

    Order is ``(current_stop_sequence, vehicle_id NULLS FIRST)`` so ties are
    broken deterministically (finding F3).  Only adjacent pairs: k vehicles at
    one stop give k-1 events.  A row with a NULL vehicle keeps its place and
    blocks pairs across it; a pair of a vehicle with itself is dropped.  A row
    without a stop sequence has no place and is left out.

    ``method="window"`` is the direct form: one ``lag`` window over the whole
    group.  ``method="split"`` (default) never sorts a whole route/snapshot in
    one task: rows are clustered by
    ``(group, stop)``; same-stop pairs come from ``lag`` inside a stop; the
    cross-stop pair needs only each stop's opening row, so the second window
    over the whole group sees one row per distinct stop.  A route/snapshot
    holding a third of all rows is thereby spread over its stops.
    Extra ``partition`` columns (e.g. ``direction_id``, finding F15) and
    ``keep`` columns of vehicle b (e.g. ``stop_id``, finding F16) pass through.
    """
    partition = list(partition)
    keep = [c for c in keep if c not in EVENT_COLUMNS and c not in partition]
    if max_gap < 0 or method not in ("split", "window"):
        raise ValueError("max_gap must not be negative, and method split or window")
    silver = silver.where(F.col("current_stop_sequence").isNotNull())
    events = (_split if method == "split" else _window)(silver, partition, max_gap, keep)
    extra = [c for c in partition if c not in EVENT_COLUMNS]
    cols = EVENT_COLUMNS + extra + keep
    events = events.select(*cols)
    if detected_at is not None:
        events = events.withColumn("detected_at", detected_at)
    return events


def _window(silver: DataFrame, partition, max_gap: int, keep) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(
        F.col("current_stop_sequence").asc(), F.col("vehicle_id").asc_nulls_first()
    )
    return (
        silver.select(
            *partition,
            *[c for c in ("route_short_name",) if c not in partition],
            "vehicle_id",
            "current_stop_sequence",
            *keep,
            F.lag("vehicle_id").over(w).alias("vehicle_id_a"),
            F.lag("current_stop_sequence").over(w).alias("_prev_seq"),
        )
        .where(F.col("vehicle_id_a").isNotNull() & (F.col("vehicle_id_a") != F.col("vehicle_id")))
        .withColumn("stop_sequence_gap", F.col("current_stop_sequence") - F.col("_prev_seq"))
        .where(F.col("stop_sequence_gap") <= max_gap)
        .withColumnRenamed("vehicle_id", "vehicle_id_b")
    )


def _split(silver: DataFrame, partition, max_gap: int, keep) -> DataFrame:
    seq = "current_stop_sequence"
    vid = F.col("vehicle_id")
    sub = [*partition, seq]
    rsn = [] if "route_short_name" in partition else ["route_short_name"]
    base = silver.select(*partition, seq, "vehicle_id", *rsn, *keep)

    # Pass 1, clustered by (group, stop), vehicles sorted NULLS FIRST: the
    # same-stop predecessor, whether the row opens its stop, and the stop's
    # last vehicle.
    w1 = Window.partitionBy(*sub).orderBy(vid.asc_nulls_first())
    r = base.select(
        "*",
        F.lag("vehicle_id").over(w1).alias("_a0"),
        F.lag(F.lit(1)).over(w1).isNull().alias("_first"),
        F.max("vehicle_id").over(Window.partitionBy(*sub)).alias("_last"),
    )
    # Keep same-stop pairs and the one opening row per stop.
    r = r.where(F.col("_first") | (F.col("_a0").isNotNull() & (F.col("_a0") != vid)))

    # Pass 2: opening rows of one group meet in one partition (at most one
    # row per distinct stop) to see the previous stop; pair rows stay spread
    # by stop.  No branch and no union, so pass 1 runs once.
    key2 = F.when(F.col("_first"), F.lit(None)).otherwise(F.col(seq))
    w2 = Window.partitionBy(*partition, key2).orderBy(seq)
    r = r.select(
        "*",
        F.lag("_last").over(w2).alias("_plast"),
        F.lag(seq).over(w2).alias("_pseq"),
    )
    across = (
        F.col("_first")
        & vid.isNotNull()
        & F.col("_plast").isNotNull()
        & (F.col(seq) - F.col("_pseq") <= max_gap)
        & (F.col("_plast") != vid)
    )
    gap0 = ~F.col("_first")
    return r.where(gap0 | across).select(
        *partition,
        *rsn,
        vid.alias("vehicle_id_b"),
        F.when(gap0, F.col("_a0")).otherwise(F.col("_plast")).alias("vehicle_id_a"),
        F.when(gap0, F.lit(0)).otherwise(F.col(seq) - F.col("_pseq")).alias("stop_sequence_gap"),
        *keep,
    )
