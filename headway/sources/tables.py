"""Table IO: parquet/any-format read and write, bronze layout, snapshots
(time travel), full refresh, insert-if-absent, CSV export (S5-S10, S16-S25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from headway.operators.joins import anti_join
from headway.operators.quality import unique
from headway.schemas import POSITION_SCHEMA
from headway.sources.paths import remove_folder
from headway.sources.versions import commit, current_version, drop_versions, read_version, stage, staged

#: Rows that one task of a partitioned write sorts, where the number of rows is known.
SORTED_ROWS = 1_000_000


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Scan a table (S5); filters and projections applied later are pushed
    into the scan by Catalyst."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    sort_within: Sequence[str] | None = None,
    compression: str | None = "snappy",
    clustered: bool = False,
    keep_other_partitions: bool = False,
    rows: int | None = None,
) -> None:
    """Batch write.

    With ``partition_by`` rows are rebalanced on it and sorted: the rows of a
    partition value meet in one task, AQE splits a value whose bytes exceed the
    advisory partition size over several, and packs small ones together.  There
    are about as many files as values, plus one for each such split, not tasks
    times values; min/max statistics of ``sort_within`` prune row groups.  Those are
    shuffled, compressed bytes: rows that repeat themselves may be twenty times
    larger where they are sorted.  With ``rows``, the number of rows of ``df``, a
    table of more than ``SORTED_ROWS`` is dealt by ranges of its order instead, a task
    and a file for each so many rows (and a file for each value that ends inside one).
    ``clustered`` says the input is already partitioned upstream (only the local
    sort runs).  An overwrite replaces the whole table;
    ``keep_other_partitions`` replaces only the partition values in ``df``.
    """
    out = df
    if clustered:
        out = out.sortWithinPartitions(*(partition_by or []), *(sort_within or []))
    elif partition_by:
        if rows is not None and rows > SORTED_ROWS:
            ties = F.xxhash64(*[c for c, kind in out.dtypes if "map<" not in kind])  # many rows of one time are split too
            out = out.repartitionByRange(-(-rows // SORTED_ROWS), *partition_by, *(sort_within or []), ties)
        else:
            out = out.hint("rebalance", *partition_by)
        out = out.sortWithinPartitions(*partition_by, *(sort_within or []))
    elif sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.format(fmt).mode(mode)
    if compression and fmt in ("parquet", "orc"):
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if keep_other_partitions else "static")
    w.save(path)


def with_bronze_partitions(positions: DataFrame, time_col: str = "ingest_timestamp") -> DataFrame:
    """Add ``date=YYYY-MM-DD`` and ``hour=HH`` (UTC) from an epoch-seconds column."""
    ts = F.timestamp_seconds(F.col(time_col))
    return positions.withColumn("date", F.date_format(ts, "yyyy-MM-dd")).withColumn(
        "hour", F.date_format(ts, "HH")
    )


def write_bronze(positions: DataFrame, path: str, mode: str = "append") -> None:
    """Bronze parquet (S6): exactly the 16 declared columns, snappy, laid out
    by row time ``date=/hour=``.  An empty input writes no data file."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in POSITION_SCHEMA.fields]
    df = with_bronze_partitions(positions.select(*cols))
    write_table(df, path, mode=mode, partition_by=["date", "hour"], sort_within=["feed_timestamp"])


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType([*POSITION_SCHEMA.fields, StructField("date", StringType()), StructField("hour", IntegerType())])
    return spark.read.schema(schema).parquet(path)


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite as a new version (S9): version n+1 is committed next to the
    older ones, which stay readable; a write that fails leaves no version.  With
    Delta on the classpath use ``fmt="delta"`` and its own ``versionAsOf``
    instead.  Returns the version."""
    return replace_table(df, path, fmt)


def replace_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    sort_within: Sequence[str] | None = None,
    keep: int | None = None,
    rows: int | None = None,
) -> int:
    """Write all of ``df`` as the next version of the table, laid out as by
    ``write_table``, and make it the current one.  Of the versions before it,
    ``keep`` stay (None: all).  Returns its number."""
    spark = df.sparkSession
    folder = stage(df, path, lambda df, to: write_table(df, to, fmt, "errorifexists", partition_by, sort_within, rows=rows))
    version = commit(spark, [(folder, path)])[0]
    if keep is not None:
        drop_versions(spark, path, keep)
    return version


def latest_version(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """The current version, from the pointer and the commit markers (no data is
    read, so an empty version counts); None only where nothing was committed."""
    return current_version(spark, path)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Read one committed version (default: the current one) from its own folder."""
    return read_version(spark, path, version, fmt)


def sql_on_path(spark: SparkSession, path: str, fmt: str = "parquet", query: str = "SELECT * FROM {t}") -> DataFrame:
    """SQL over a path without a catalog entry (S10): ``parquet.`path```."""
    return spark.sql(query.format(t=f"{fmt}.`{path}`"))


def stage_refresh(
    df: DataFrame, path: str, keys: Sequence[str] | None = None, fmt: str = "parquet", allow_empty: bool = False
) -> str:
    """The first half of a full refresh: the new rows, blank text as NULL, staged
    beside the table and checked there (keys unique, not empty unless
    ``allow_empty``).  Nothing of the table changes; returns the staged folder,
    which ``versions.commit`` makes current."""
    spark = df.sparkSession
    out = df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    folder = stage(out, path, lambda rows, to: write_table(rows, to, fmt, "errorifexists"))
    rows = staged(spark, folder, fmt)
    try:
        if not allow_empty and rows.isEmpty():
            raise ValueError(f"no rows for a full refresh of {path}")
        if keys and not unique(rows, keys).isEmpty():
            raise ValueError(f"duplicate key {list(keys)} in full refresh of {path}")
    except BaseException:
        remove_folder(spark, folder)
        raise
    return folder


def full_refresh(
    df: DataFrame,
    path: str,
    keys: Sequence[str] | None = None,
    fmt: str = "parquet",
    allow_empty: bool = False,
    keep: int = 1,
) -> int:
    """Truncate-and-insert as one step (S21): the new rows are staged and checked,
    then the table's pointer is swapped to them; a refresh that fails, at whatever
    point, leaves the old rows.  Read the table with ``read_snapshot``.  ``keep``
    older versions stay for readers that are still on them."""
    spark = df.sparkSession
    version = commit(spark, [(stage_refresh(df, path, keys, fmt, allow_empty), path)])[0]
    drop_versions(spark, path, keep)
    return version


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Rows to append so that ``keys`` stay unique, first write wins.

    In-batch duplicates keep their first row by ``order_by`` (an arrival time
    or position; without one, the smallest by the remaining columns); rows whose
    key already exists in ``target`` are dropped (``left_anti``)."""
    from headway.operators.positions import dedup

    others = [c for c in incoming.columns if c not in keys]
    first = dedup(incoming, keys=keys, order_by=[*(order_by or []), *[c for c in others if c not in (order_by or [])]])
    return anti_join(first, target, keys)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header (S24), a file for each task, or by choice one file:
    its rows go through a one-partition shuffle, so the stages before keep
    their tasks."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
