"""The small loaders as Spark jobs: GTFS dimensions with SCD2,
road restrictions with their stop pairs, and insert-once weather.

All but weather are versioned tables, read with ``read_snapshot``: the new rows
are staged and checked, then the table's pointer is swapped, so a failed run leaves
what was there.  The two restriction tables are staged both before either changes.
Weather is appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.operators.constraints import check_rows, split_rows
from headway.operators.positions import current, located
from headway.operators.quality import with_metrics
from headway.operators.scd2 import last_row_wins, scd2_apply, scd2_counts_of
from headway.operators.spatial import within_radius
from headway.schemas import (
    DIM_ROUTE_SCHEMA,
    DIM_STOP_SCHEMA,
    FACT_WEATHER_SCHEMA,
    ROUTE_TRACKED,
    ROUTE_TYPES,
    STOP_TRACKED,
    STOP_TYPES,
    TRIP_COLUMNS,
    TRIP_TYPES,
)
from headway.sources.files import read_gtfs_csv, read_restrictions, read_weather, type_gtfs
from headway.sources.inserts import insert_batch
from headway.sources.paths import exists, remove_folder
from headway.sources.tables import full_refresh, insert_if_absent, latest_version, read_snapshot, stage_refresh, write_snapshot, write_table
from headway.sources.versions import commit, drop_versions, stage, staged

# Radius of the stop / restriction pairing, metres.
NEARBY_RADIUS_M = 150.0


def _latest_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    if latest_version(spark, path) is None:
        return spark.createDataFrame([], schema)
    return read_snapshot(spark, path)


def load_dimension(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    key: str,
    tracked: list[str],
    types: dict,
    schema,
    load_ts: str,
    surrogate_key: str,
) -> dict[str, int]:
    """SCD2 load of one GTFS table into a versioned dimension.

    A key listed twice keeps its last row: the last by file name, then by
    position in the file (each multi-line CSV file is one unsplit read, so the
    id rises along it; it is used for ordering only, never stored).  Rows
    without a key are left out.  Returns inserted / expired / unchanged counts,
    from the written versions."""
    raw = type_gtfs(read_gtfs_csv(spark, csv_path, [key, *tracked]), types).where(F.col(key).isNotNull())
    place = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"))
    incoming = last_row_wins(raw.withColumn("_pos", place), key, "_pos").drop("_pos")
    history = _latest_or_empty(spark, table_path, schema)
    new = scd2_apply(history, incoming, key, tracked, load_ts, surrogate_key=surrogate_key)
    before = scd2_counts_of(history, load_ts).first()
    version = write_snapshot(new, table_path)
    after = scd2_counts_of(read_snapshot(spark, table_path, version), load_ts).first()
    opened, closed = after["opened"] - before["opened"], after["closed"] - before["closed"]
    return {"inserted": opened, "expired": closed, "unchanged": before["open"] - closed}


def load_gtfs_dimensions(spark: SparkSession, gtfs_dir: str, out_dir: str, load_ts: str) -> dict[str, dict]:
    """routes.txt / stops.txt -> SCD2 dim_route / dim_stop; trips.txt -> dim_trip
    (full refresh, key trip_id checked unique)."""
    d = gtfs_dir.rstrip("/")
    o = out_dir.rstrip("/")
    out = {
        "dim_route": load_dimension(
            spark, f"{d}/routes.txt", f"{o}/dim_route", "route_id", ROUTE_TRACKED, ROUTE_TYPES,
            DIM_ROUTE_SCHEMA, load_ts, "route_key",
        ),
        "dim_stop": load_dimension(
            spark, f"{d}/stops.txt", f"{o}/dim_stop", "stop_id", STOP_TRACKED, STOP_TYPES,
            DIM_STOP_SCHEMA, load_ts, "stop_key",
        ),
    }
    trips = type_gtfs(read_gtfs_csv(spark, f"{d}/trips.txt", TRIP_COLUMNS), TRIP_TYPES)
    full_refresh(trips.withColumn("loaded_at", F.lit(load_ts).cast("timestamp")), f"{o}/dim_trip", keys=["trip_id"])
    return out


def load_restriction_snapshot(
    spark: SparkSession,
    restrictions_path: str,
    dim_stop: DataFrame,
    out_dir: str,
    load_ts: str,
    radius_m: float = NEARBY_RADIUS_M,
    active_only: bool = False,
    one_doc_per_file: bool = True,
) -> None:
    """Restrictions snapshot (full refresh, key checked) and the stops within
    ``radius_m`` of each located restriction.  ``active_only`` restricts the
    pairing to non-expired restrictions (finding F5; off = reference).  Both
    tables are computed, staged and checked before either changes."""
    o = out_dir.rstrip("/")
    tables = [f"{o}/road_restrictions", f"{o}/stops_near_restrictions"]
    folders = [stage_refresh(read_restrictions(spark, restrictions_path, one_doc_per_file, loaded_at=load_ts), tables[0], ["restriction_id"])]
    try:
        rows = staged(spark, folders[0])
        active = rows.where(~F.col("expired")) if active_only else rows
        stops = located(current(dim_stop), "stop_lat", None)
        pairs = within_radius(stops, located(active), radius_m=radius_m).withColumn(
            "loaded_at", F.lit(load_ts).cast("timestamp")
        )
        folders.append(stage_refresh(pairs, tables[1], ["stop_id", "restriction_id"], allow_empty=True))
    except BaseException:
        for folder in folders:
            remove_folder(spark, folder)
        raise
    commit(spark, list(zip(folders, tables, strict=True)))
    for table in tables:
        drop_versions(spark, table, keep=1)


def load_observations(spark: SparkSession, docs_path: str, table_path: str, load_ts: str, multi_line: bool = True) -> int:
    """Append the observations whose (station, time) is not stored yet; first
    write wins.  Only the new rows are written.  Returns their number."""
    incoming = read_weather(spark, docs_path, multi_line, loaded_at=load_ts)
    if exists(spark, table_path):
        target = spark.read.schema(FACT_WEATHER_SCHEMA).parquet(table_path)
    else:
        target = spark.createDataFrame([], FACT_WEATHER_SCHEMA)
    added = insert_if_absent(target, incoming, ["station_id", "observed_at"])
    added, seen = with_metrics(added.select(*FACT_WEATHER_SCHEMA.names), "observations")
    added.write.mode("append").parquet(table_path)
    return seen.get["rows"]


def load_observations_by_month(
    spark: SparkSession, docs_path: str, table_path: str, load_ts: str, step: int, multi_line: bool = True
) -> int:
    """``load_observations`` into a table kept by month, read with ``parts.read_parts``: a load reads only the months
    and the span of time of its own observations.  ``step`` numbers the loads; one given again changes nothing."""
    incoming = read_weather(spark, docs_path, multi_line, loaded_at=load_ts).select(*FACT_WEATHER_SCHEMA.names)
    return insert_batch(incoming, table_path, ["station_id", "observed_at"], "observed_at", step, "observed_month")


def load_checked(
    rows: DataFrame,
    table_path: str,
    rejects_path: str,
    schema: StructType,
    keys: list[str] | None = None,
    order_by: list[str] | None = None,
    defaults: dict | None = None,
) -> tuple[int, int]:
    """Full refresh with the table's declared types, NOT NULL columns, defaults and key enforced: the rows refused, with
    their reasons, become the reject table.  Both are committed together; their versions."""
    spark = rows.sparkSession
    aside = f"{table_path.rstrip('/')}/_checked-{uuid.uuid4().hex}"
    folders: list[str] = []
    try:
        write_table(check_rows(rows, schema, defaults), aside)
        accepted, rejected = split_rows(spark.read.parquet(aside), keys, order_by)
        for part, path in ((accepted, table_path), (rejected, rejects_path)):
            folders.append(stage(part, path, lambda df, to: write_table(df, to, mode="errorifexists")))
        first, second = commit(spark, [(folders[0], table_path), (folders[1], rejects_path)])
    except BaseException:
        for folder in folders:
            remove_folder(spark, folder)
        raise
    finally:
        remove_folder(spark, aside)
    return first, second
