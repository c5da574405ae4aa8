"""Data-quality checks (Q1-Q5).  Every check returns failing rows or counts;
``run_checks`` evaluates all checks of a table in a single aggregation pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check", "table", "column", "failures"]

# The data tests of the staging and mart models.
NOT_NULL = {
    "stg_bunching_events": ["route_id", "event_time", "vehicle_id_a", "vehicle_id_b"],
    "stg_dim_route_current": ["route_id"],
    "stg_dim_stop_current": ["stop_id"],
    "stg_fact_weather": ["station_id", "observed_at"],
    "stg_road_restrictions": ["restriction_id"],
    "stg_stops_near_restrictions": ["stop_id", "restriction_id"],
    "mart_bunching_events": ["route_id", "event_time"],
    "mart_bunching_hourly": ["route_id", "event_hour"],
}
UNIQUE = {
    "stg_dim_route_current": [["route_id"]],
    "stg_dim_stop_current": [["stop_id"]],
    "stg_road_restrictions": [["restriction_id"]],
}
NO_SELF_PAIRS = ["mart_bunching_events"]


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL (Q1)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (Q2, Q4); a key
    with a NULL is no key and is left to the not-null check.

    A partial (map-side) count per key, so a hot key costs one row per task.
    """
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    return df.where(known).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def no_self_pairs(df: DataFrame, a: str = "vehicle_id_a", b: str = "vehicle_id_b") -> DataFrame:
    """Events pairing a vehicle with itself (Q3); must be empty."""
    return df.where(F.col(a) == F.col(b))


def _table_checks(
    name: str,
    df: DataFrame,
    nn: Iterable[str],
    uq: Iterable[Sequence[str]],
    self_pairs: bool,
) -> DataFrame:
    """All checks of one table: not-null and self-pair failures as conditional
    sums of one scan; each unique check as duplicate-row count of one
    aggregation.  Results are unioned into (check, table, column, failures)."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    sums = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"nn_{i}") for i, c in enumerate(nn)]
    labels = [("not_null", c, f"nn_{i}") for i, c in enumerate(nn)]
    if self_pairs:
        sums.append(F.sum(F.when(F.col("vehicle_id_a") == F.col("vehicle_id_b"), 1).otherwise(0)).alias("self"))
        labels.append(("no_self_bunching", "vehicle_id_a,vehicle_id_b", "self"))
    if sums:
        agg = df.agg(*sums)
        stack = ", ".join(f"'{chk}', '{col}', CAST(coalesce({al}, 0) AS BIGINT)" for chk, col, al in labels)
        parts.append(
            agg.selectExpr(f"stack({len(labels)}, {stack}) AS (check, column, failures)").select(
                "check", F.lit(name).alias("table"), "column", "failures"
            )
        )
    for cols in uq:
        dup = unique(df, cols).agg(F.count(F.lit(1)).alias("failures"))  # repeated keys
        parts.append(
            dup.select(
                F.lit("unique").alias("check"),
                F.lit(name).alias("table"),
                F.lit(",".join(cols)).alias("column"),
                "failures",
            )
        )
    if not parts:
        return spark.createDataFrame([], "check string, table string, column string, failures long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(
    tables: Mapping[str, DataFrame],
    not_null_cols: Mapping[str, Sequence[str]] = NOT_NULL,
    unique_keys: Mapping[str, Sequence[Sequence[str]]] = UNIQUE,
    self_pair_tables: Sequence[str] = NO_SELF_PAIRS,
) -> DataFrame:
    """Every configured check over the given tables (missing tables skipped).

    Output: ``check, table, column, failures``; a passing check has 0.
    """
    out = None
    for name, df in tables.items():
        part = _table_checks(
            name,
            df,
            not_null_cols.get(name, []),
            unique_keys.get(name, []),
            name in self_pair_tables,
        )
        out = part if out is None else out.unionByName(part)
    return out


def with_metrics(df: DataFrame, name: str, **aggs) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics collected during the next action (Q5).

    ``with_metrics(df, "silver", rows=F.count(F.lit(1)))`` -> (df', obs);
    ``obs.get`` is available after ``df'`` has been written or counted once.
    """
    obs = Observation(name)
    if not aggs:
        aggs = {"rows": F.count(F.lit(1))}
    return df.observe(obs, *[c.alias(k) for k, c in aggs.items()]), obs
