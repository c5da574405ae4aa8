"""JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Write batch size used for event tables.
JDBC_BATCH_SIZE = 5000


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a table; large tables pass a numeric ``partition_column`` and
    bounds so the read is split over ``num_partitions`` parallel queries."""
    props = dict(props or {})
    if partition_column:
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions or spark.sparkContext.defaultParallelism,
            properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    truncate: bool = True,
    batch_size: int = JDBC_BATCH_SIZE,
    num_partitions: int | None = None,
) -> None:
    """Overwrite that keeps the table object (TRUNCATE instead of DROP), so
    dependent views survive.  ``num_partitions`` caps concurrent connections.
    Driver-specific batching flags go in ``props``."""
    p = {**dict(props or {}), "batchsize": str(batch_size)}
    if truncate:
        p["truncate"] = "true"
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url, table, mode=mode, properties=p)
