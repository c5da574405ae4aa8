"""Insert-if-absent into a table kept by month (S22, J8): what a batch reads of the
table follows the batch, not the table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from headway.operators.joins import anti_join, semi_join
from headway.sources.parts import last_step, put_parts, read_parts
from headway.sources.paths import folders, remove_folder
from headway.sources.tables import insert_if_absent, write_table


def may_hold(spark: SparkSession, path: str, batch: DataFrame, months: Sequence[str], time_col: str, schema: StructType) -> DataFrame:
    """The table's rows that can have a key of ``batch``: of its months, and within its first and last time,
    by which row groups are left out."""
    first, last = batch.agg(F.min(time_col), F.max(time_col)).first()
    rows = read_parts(spark, path, schema, months)
    return rows if first is None else rows.where(F.col(time_col).between(F.lit(first), F.lit(last)))


def insert_batch(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    time_col: str,
    step: int,
    month_col: str = "event_month",
    order_by: Sequence[str] | None = None,
) -> int:
    """Add the rows whose ``keys`` the table does not hold; their number.

    ``time_col`` is one of the keys; its month is the partition.  Of repeated keys in the
    batch the first by ``order_by`` counts (see ``insert_if_absent``), and what is
    stored stays.  The batch is written aside once; of the table only its months and
    its span of time are read, and of those only keys that the batch has pass the
    semi join: Spark broadcasts the batch's keys when they are small, and filters the
    table's rows by a Bloom filter of them before a shuffle otherwise.  NULL keys
    equal nothing stored, so they are added by every batch, once each.  A step given again after its
    commit changes nothing.
    """
    spark, path = incoming.sparkSession, path.rstrip("/")
    if time_col not in keys:
        raise ValueError(f"{time_col} is not one of the keys {list(keys)}")
    if step <= last_step(spark, path):
        return 0
    names = incoming.columns
    schema = StructType([*incoming.schema.fields, StructField(month_col, StringType())])
    aside = f"{path}/_batch-{uuid.uuid4().hex}"
    try:
        firsts = insert_if_absent(spark.createDataFrame([], incoming.schema), incoming, keys, order_by)
        month = F.date_format(time_col, "yyyy-MM").alias(month_col)
        write_table(firsts.select(*names, month), aside, partition_by=[month_col], sort_within=[time_col])
        months = [m for m in folders(spark, aside) if m.startswith(f"{month_col}=")]
        batch = spark.read.schema(schema).parquet(aside)
        seen = semi_join(may_hold(spark, path, batch, months, time_col, schema).select(*keys), batch, keys)
        put_parts(anti_join(batch, seen, keys).select(*schema.names), path, month_col, step, replaces=lambda value: False, sort_within=[time_col])
        return spark.read.schema(schema).parquet(f"{path}/step={step}").count()
    finally:
        remove_folder(spark, aside)
