"""Nearest-in-time join (J3): for each left row, the one right row whose time
is closest, in the past or the future.

Spark cannot decorrelate ``LATERAL (... ORDER BY abs(dt) LIMIT 1)``.  There are two
ways, chosen by the counted size of the right side:

- Each row of a right side of at most ``small_rows`` rows (weather beside events)
  becomes the cell of times that it is nearest to.  Time is cut at quantiles of the
  right rows, however they crowd, a cell stands in each slice that it touches, and
  a left row, whose slice is found by binary search in the cuts, is joined with the
  cells of its slice, PER_SLICE of them or SMALL_ROWS / MOST_SLICES.  The left side
  is read once, and Spark may broadcast the cells, whose number the count bounds.
- A larger one makes a time line of both sides: a row for each (key, time), with
  the right row of that time where there is one.  The line is written once, dealt
  by range of time into slices that are about equally full, however the times
  crowd.  Inside a slice the last right row before and the first after each point
  are running values of two windows; what a slice does not know, the nearest right
  rows of the slices around it, comes from one row for each key and slice.  The
  nearer neighbour is joined back to the left rows by (key, time).  A slice is the
  number of the partition that a row was written in, so the plan has one size for
  any number of slices, and all points of a time are one row, so a repeated time
  does not fill a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.columns import micros
from headway.session import scratch_path

#: A right side of at most so many rows is made into cells; right rows of a slice of them, and slices, at most.
SMALL_ROWS, PER_SLICE, MOST_SLICES = 200_000, 16, 1024


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    by: Sequence[str] | None = None,
    right_by: Sequence[str] | None = None,
    right_cols: Sequence[str] | None = None,
    tie_cols: Sequence[str] = (),
    tolerance_seconds: float | None = None,
    prefix: str = "",
    slices: int | None = None,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Left-outer nearest-in-time join; returns all left columns plus
    ``right_cols`` (default: every right column except keys), optionally
    prefixed.  Of two equally near rows the earlier one is taken, of right rows
    of one time that with the smallest ``tie_cols``, then payload.  A left row
    gets NULLs when the right side (for its key) is empty, its time is NULL or,
    with ``tolerance_seconds``, the nearest row is farther.  ``slices`` (default:
    the shuffle partitions) is the number of parts of the time line of a large
    right side; ``small_rows=0`` always takes that way.
    """
    by = list(by or [])
    right_by = list(right_by or by)
    if right_cols is None:
        right_cols = [c for c in right.columns if c not in right_by]
    right_cols = list(right_cols)
    keys = [f"_k{i}" for i in range(len(by))]

    ties = F.struct(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_cols)], F.struct(*right_cols).alias("_p"))
    named = [F.col(c).alias(k) for c, k in zip(right_by, keys, strict=True)]
    seen = right.select(*named, micros(right_time).alias("_t"), ties.alias("_row")).where(F.col("_t").isNotNull())
    cuts = _cuts(seen, keys, small_rows) if small_rows else None
    if cuts is not None:
        joined = _join_cells(left, seen, left_time, by, keys, cuts)
    else:
        joined = _merge(left, seen, left_time, by, keys, slices or _shuffle_partitions(left))
    payload = [F.col(f"_near.p.{c}") for c in right_cols]
    if tolerance_seconds is not None:
        near = F.abs(micros(left_time) - F.col("_near.t")) <= F.lit(int(tolerance_seconds * 1_000_000))
        payload = [F.when(near, c) for c in payload]
    return joined.select(*[F.col(c) for c in left.columns], *[p.alias(f"{prefix}{c}") for p, c in zip(payload, right_cols, strict=True)])


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _nearer(t: Column, before: Column, after: Column) -> Column:
    """Of the two neighbours (structs with ``t``), either of which may be missing."""
    return F.when(after.isNull() | (t - before.getField("t") <= after.getField("t") - t), before).otherwise(after)


def _cuts(seen: DataFrame, keys: list[str], small_rows: int) -> list[int] | None:
    """Quantiles of the right times; None if there are more rows than ``small_rows``.  One aggregate row reaches the driver."""
    n_keys = F.approx_count_distinct(F.struct(*keys)) if keys else F.lit(1)
    shares = ", ".join(f"{i / MOST_SLICES}D" for i in range(1, MOST_SLICES))
    quantiles = F.expr(f"percentile_approx(_t, array({shares}), 10000)")
    n, n_keys, found = seen.agg(F.count(F.lit(1)), n_keys, quantiles).first()
    if n > small_rows:
        return None
    # A cell of a key with few rows touches many slices: no more of them than leave as many copies as rows.
    slices = min(MOST_SLICES, n // (PER_SLICE * max(1, n_keys)))
    return sorted(set((found or [])[MOST_SLICES // slices - 1 :: MOST_SLICES // slices])) if slices > 1 else []


def _join_cells(left: DataFrame, seen: DataFrame, left_time: str, by: list[str], keys: list[str], cuts: list[int]) -> DataFrame:
    """``left`` with ``_near``: the right row in whose cell a left row's time lies.

    ``seen`` is small, so windows over all of it are too."""
    here = F.struct(F.col("_t").alias("t"), F.col("_row._p").alias("p"))
    first = seen.groupBy(*keys, "_t").agg(F.min("_row").alias("_row")).select(*keys, "_t", here.alias("_near"))
    # Of two equally near rows the earlier: a cell ends with the middle between its row and the next.
    order = Window.partitionBy(*keys).orderBy("_t")
    middle = lambda other: F.shiftright(F.col("_t") + other, 1)
    begin = F.coalesce(middle(F.lag("_t").over(order)) + 1, F.lit(-(1 << 62)))
    end = F.coalesce(middle(F.lead("_t").over(order)), F.lit(1 << 62))
    cells = first.select(*[F.col(k).alias(f"_f{k}") for k in keys], "_near", begin.alias("_begin"), end.alias("_end"))
    touched = F.sequence(_slice(F.col("_begin"), cuts), _slice(F.col("_end"), cuts))
    cells = cells.withColumn("_s", F.explode(touched))
    asked = left.withColumn("_at", micros(left_time)).withColumn("_slice", _slice(F.col("_at"), cuts))
    condition = (F.col("_slice") == F.col("_s")) & F.col("_at").between(F.col("_begin"), F.col("_end"))
    for c, k in zip(by, keys, strict=True):
        condition = condition & (asked[c] == F.col(f"_f{k}"))
    return asked.join(cells, condition, "left")


def _slice(t: Column, cuts: list[int]) -> Column:
    """How many cuts are at or before ``t`` (null for null): a binary search in one array literal."""
    table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    widths = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])

    def step(found: Column, width: Column) -> Column:
        on = found + width
        return F.when((on <= len(cuts)) & (F.get(table, on - 1) <= t), on).otherwise(found)

    return F.when(t.isNotNull(), F.aggregate(widths, F.lit(0), step) if cuts else F.lit(0))


def _merge(left: DataFrame, seen: DataFrame, left_time: str, by: list[str], keys: list[str], slices: int) -> DataFrame:
    """``left`` with ``_near``, over a time line in slices."""
    asked = left.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], micros(left_time).alias("_t"))
    nothing = F.lit(None).cast(seen.schema["_row"].dataType)
    points = seen.unionByName(asked.where(F.col("_t").isNotNull()).distinct().withColumn("_row", nothing))
    here = F.when(F.col("_row").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_row._p").alias("p")))
    line = points.groupBy(*keys, "_t").agg(F.min("_row").alias("_row")).select(*keys, "_t", here.alias("_here"))
    line = _in_slices(line, keys, slices)
    up = Window.partitionBy(*keys, "_s").orderBy("_t")
    down = Window.partitionBy(*keys, "_s").orderBy(F.desc("_t"))
    known = line.select(
        *keys, "_s", "_t", F.last("_here", True).over(up).alias("_before"), F.last("_here", True).over(down).alias("_after")
    )
    # The nearest right rows outside a slice; a row for each key and slice, at most `slices` for a key.
    ends = line.groupBy(*keys, "_s").agg(
        F.max_by("_here", F.when(F.col("_here").isNotNull(), F.col("_t"))).alias("_last"),
        F.min_by("_here", F.when(F.col("_here").isNotNull(), F.col("_t"))).alias("_first"),
    )
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    around = ends.select(
        *[F.col(k).alias(f"_e{k}") for k in keys],
        F.col("_s").alias("_es"),
        F.last("_last", True).over(earlier).alias("_far_before"),
        F.last("_first", True).over(later).alias("_far_after"),
    )
    same = F.col("_s") == F.col("_es")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_e{k}"))
    nearest = _nearer(F.col("_t"), F.coalesce("_before", "_far_before"), F.coalesce("_after", "_far_after"))
    found = known.join(around, same).select(*[F.col(k).alias(f"_f{k}") for k in keys], F.col("_t").alias("_ft"), nearest.alias("_near"))

    condition = micros(left_time) == F.col("_ft")
    for c, k in zip(by, keys, strict=True):
        condition = condition & (F.col(c) == F.col(f"_f{k}"))
    return left.join(found.where("_near is not null"), condition, "left")


def _in_slices(line: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """The line, written once, with the slice ``_s`` of each row.

    Dealt by time, of one time by key: for each key, slices rise with time."""
    path = scratch_path(line.sparkSession, "time-line")
    line.repartitionByRange(slices, "_t", *keys).withColumn("_s", F.spark_partition_id()).write.parquet(path)
    return line.sparkSession.read.schema(line.withColumn("_s", F.lit(0)).schema).parquet(path)
