"""SCD2 history kept in parts (M2, M3): a load rewrites the open rows and adds the
rows it closes; rows closed before are neither read nor written.

The parts are the open rows, ``ended=open``, and the closed ones by the month of
their ``valid_to``, ``ended=2024-06``.  Rows that no load can change (not flagged
current, or without a key) and that never ended are ``ended=unended``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from headway.operators.scd2 import scd2_apply, scd2_as_of, scd2_counts_of
from headway.plans.marts import month_of
from headway.sources.parts import last_step, put_parts, read_parts

ENDED, OPEN, UNENDED = "ended", "open", "unended"


def _with_part(rows: DataFrame, key: str) -> DataFrame:
    is_open = F.coalesce(F.col("is_current"), F.lit(False)) & F.col(key).isNotNull()
    ended = F.when(is_open, F.lit(OPEN)).when(F.col("valid_to").isNotNull(), month_of(F.col("valid_to"))).otherwise(F.lit(UNENDED))
    return rows.withColumn(ENDED, ended)


def store_history(history: DataFrame, path: str, key: str, step: int = 0) -> None:
    """A whole history as the table's first step."""
    put_parts(_with_part(history, key), path, ENDED, step, sort_within=[key])


def load_history(
    incoming: DataFrame,
    path: str,
    key: str,
    tracked: Sequence[str],
    load_ts,
    step: int,
    schema: StructType | None = None,
    types: Mapping[str, DataType] | None = None,
    surrogate_key: str | None = None,
) -> dict[str, int]:
    """Apply one load, as ``scd2_apply`` does, to a stored history (``schema``: of one
    without any step); inserted, expired and unchanged keys.

    ``incoming`` holds a row for each key, rows without a key are left out.  Only
    open rows are read and written anew; what the load closes is added to the month
    of ``load_ts``.  A step given again after its commit changes nothing and counts
    as 0.
    """
    spark = incoming.sparkSession
    if step <= last_step(spark, path):
        return {"inserted": 0, "expired": 0, "unchanged": 0}
    first = None if schema is None else StructType([*schema.fields, StructField(ENDED, StringType())])
    stored = read_parts(spark, path, first, [f"{ENDED}={OPEN}"]).drop(ENDED)
    before = stored.count()
    new = scd2_apply(stored, incoming, key, tracked, load_ts, types=types, surrogate_key=surrogate_key)
    part = f"{ENDED}={OPEN}"
    put_parts(_with_part(new, key), path, ENDED, step, replaces=lambda value: value == part, sort_within=[key], clear=[part])
    after = scd2_counts_of(read_parts(spark, path, values=[part]), load_ts).first()
    expired = before - (after["open"] - after["opened"])
    return {"inserted": after["opened"], "expired": expired, "unchanged": before - expired}


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all keys."""
    return read_parts(spark, path).drop(ENDED)


def read_as_of(spark: SparkSession, path: str, ts) -> DataFrame:
    """The versions valid at ``ts``; months of closed rows before it are not read."""
    t = F.lit(ts).cast("timestamp") if not isinstance(ts, Column) else ts
    rows = read_parts(spark, path)
    # the names of the two parts without an end are above all months
    return scd2_as_of(rows.where(F.col(ENDED) >= month_of(t)), t).drop(ENDED)
