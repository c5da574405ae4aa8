"""Reading the driver's tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.session import ensure_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` (a file or a folder of files)."""
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
