"""Join helpers: joins with dimensions, semi/anti joins for membership, key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.quality import unique


def join_dimension(facts: DataFrame, dim: DataFrame, on: Sequence[str], checked: bool = False) -> DataFrame:
    """``facts`` LEFT JOIN ``dim``.  Spark broadcasts the dimension when its
    size in bytes (of the stored files, or measured at run time by AQE) is below
    ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise; no row is
    counted for it.  ``checked`` makes a repeated key in ``dim`` an error when
    the join runs, instead of a silently multiplied fact."""
    return facts.join(unique_by(dim, on) if checked else dim, on=list(on), how="left")


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose evaluation fails if ``keys`` repeat (finding F18).

    A group-by on the keys that every row passes through; NULL keys join
    nothing and are not checked.
    """
    rest = [c for c in df.columns if c not in keys]
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    row = F.min(F.struct(*[F.col(c) for c in rest])) if rest else F.lit(None)
    message = F.concat(F.lit("repeated key: "), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    grouped = df.where(has_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), row.alias("_row"))
    once = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.where(once).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` after a check that ``keys`` do not repeat; raises ValueError at once."""
    if not unique(df, keys).isEmpty():
        raise ValueError(f"duplicate key {list(keys)} in {what}")
    return df


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (J5); never duplicates rows."""
    return df.join(keys.select(*on), on=list(on), how="left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys``."""
    return df.join(keys.select(*on), on=list(on), how="left_anti")
