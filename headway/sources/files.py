"""File readers for raw inputs: GTFS CSV (S13), road-restriction JSON (S14),
weather JSON (S15) and the raw feed archive (S3, S4)."""

from __future__ import annotations

import gzip
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from headway.functions.columns import (
    blank_to_null,
    millis_to_ts,
    repair_json_backslashes,
    to_bool,
    to_double,
    typed,
)
from headway.schemas import CLOSURE_DOC_SCHEMA, FEED_SCHEMA, WEATHER_DOC_SCHEMA

_BOM = "﻿"


def read_gtfs_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A GTFS ``*.txt`` table: header row, every value text, BOM-tolerant.

    Quoted fields may contain commas, doubled quotes and line breaks.  A UTF-8
    byte-order mark in front of the first header name is removed.
    """
    df = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    df = df.toDF(*[c.lstrip(_BOM).strip() for c in df.columns])
    if columns:
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return df


def type_gtfs(df: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    """Blank -> NULL and lenient cast of the text columns to a dimension's types."""
    return df.select(*[typed(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def read_restriction_docs(spark: SparkSession, path: str, one_doc_per_file: bool = True) -> DataFrame:
    """Raw restriction documents as text: whole files, or one document per line."""
    if one_doc_per_file:
        return spark.read.text(path, wholetext=True)
    return spark.read.text(path)


def parse_restrictions(docs: DataFrame, loaded_at=None) -> DataFrame:
    """``{"Closure": [...]}`` text -> road_restrictions rows.

    Lone backslashes are escaped first (valid escapes kept, finding F6);
    epoch-millisecond times become timestamps (falsy -> NULL); coordinates are
    float-if-present; ``planned``/``expired`` are typed booleans (finding F9).
    A document that is no JSON or has no ``Closure`` list raises an error with
    its first characters; blank lines are skipped.
    """
    value = F.col("value")
    listed = F.from_json(repair_json_backslashes(value), CLOSURE_DOC_SCHEMA)["Closure"]
    bad = F.raise_error(F.concat(F.lit("not a restriction document: "), F.substring(value, 1, 120)))
    docs = docs.where(F.trim(F.coalesce(value, F.lit(""))) != "")
    c = docs.select(F.explode(F.when(listed.isNull(), bad.cast(CLOSURE_DOC_SCHEMA["Closure"].dataType)).otherwise(listed)).alias("c")).select("c.*")
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return c.select(
        F.col("id").alias("restriction_id"),
        blank_to_null(F.col("road")).alias("road"),
        blank_to_null(F.col("roadClass")).alias("road_class"),
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"),
        to_bool("planned").alias("planned"),
        to_bool("expired").alias("expired"),
        millis_to_ts("startTime").alias("start_time"),
        millis_to_ts("endTime").alias("end_time"),
        F.col("description"),
        ts.alias("loaded_at"),
    )


def read_restrictions(spark: SparkSession, path: str, one_doc_per_file: bool = True, loaded_at=None) -> DataFrame:
    return parse_restrictions(read_restriction_docs(spark, path, one_doc_per_file), loaded_at)


def parse_weather(docs: DataFrame, value_col: str | None = None, loaded_at=None) -> DataFrame:
    """GeoJSON current-conditions documents -> fact_weather rows.

    Missing objects at any depth give NULL (explicit schema, no inference).
    ``docs`` is either parsed (``properties`` column) or text in ``value_col``.
    """
    if value_col is not None:
        docs = docs.select(F.from_json(F.col(value_col), WEATHER_DOC_SCHEMA).alias("d")).select("d.*")
    p = F.col("properties")
    cc = p["currentConditions"]
    ts = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return docs.select(
        p["identifier"].alias("station_id"),
        p["name"]["en"].alias("station_name"),
        F.to_timestamp(cc["timestamp"]["en"]).alias("observed_at"),
        cc["temperature"]["value"]["en"].alias("temperature_c"),
        cc["condition"]["en"].alias("condition"),
        cc["relativeHumidity"]["value"]["en"].alias("humidity_pct"),
        cc["wind"]["speed"]["value"]["en"].alias("wind_kmh"),
        cc["pressure"]["value"]["en"].alias("pressure_kpa"),
        ts.alias("loaded_at"),
    )


def read_weather(spark: SparkSession, path: str, multi_line: bool = True, loaded_at=None) -> DataFrame:
    """One weather document per file (``multi_line``) or per line."""
    docs = spark.read.schema(WEATHER_DOC_SCHEMA).option("multiLine", multi_line).json(path)
    return parse_weather(docs, loaded_at=loaded_at)


# Archive snapshot time: the file name {yyyyMMdd'T'HHmmss}.<ext>, or a
# snapshot={yyyyMMdd'T'HHmmss} folder as written by ``write_archive``.
ARCHIVE_NAME = r"(?:snapshot=(\d{8}T\d{6})/[^/]+|(\d{8}T\d{6})\.[^/]+)$"


def archive_time(path_col: str = "path"):
    """Snapshot time (UTC) parsed from an archive path."""
    folder = F.regexp_extract(path_col, ARCHIVE_NAME, 1)
    name = F.regexp_extract(path_col, ARCHIVE_NAME, 2)
    return F.to_timestamp(F.when(folder != "", folder).otherwise(name), "yyyyMMdd'T'HHmmss")


def write_archive(feeds: DataFrame, root: str, time_col: str = "file_time", mode: str = "append") -> None:
    """Archive raw snapshots (the collector's raw layer) as gzip JSON below
    ``date=/hour=/snapshot=`` folders, one folder per snapshot time."""
    t = F.col(time_col)
    out = feeds.select(
        "header",
        "entity",
        F.date_format(t, "yyyy-MM-dd").alias("date"),
        F.date_format(t, "HH").alias("hour"),
        F.date_format(t, "yyyyMMdd'T'HHmmss").alias("snapshot"),
    )
    # a snapshot's rows meet in one task, so it becomes one file
    out = out.repartition("date", "hour", "snapshot")
    out.write.mode(mode).partitionBy("date", "hour", "snapshot").option("compression", "gzip").json(root)


def read_archive(spark: SparkSession, root: str, pattern: str = "*.json.gz") -> DataFrame:
    """Raw feed archive (S3): one row per snapshot file with its path, the
    snapshot time parsed from the name (UTC, finding F10) and the feed
    struct.  Files are JSON-encoded ``FeedMessage`` documents (gzip is
    decoded by extension); ordering by time is ``orderBy("file_time")``.
    """
    df = (
        spark.read.schema(FEED_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(root)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    return df.select("path", archive_time("path").alias("file_time"), F.struct("header", "entity").alias("feed"))


def gunzipped(content):
    """Plain bytes of gzip content; other content and NULL as they are."""
    def run(raws: pd.Series) -> pd.Series:
        return raws.map(lambda raw: gzip.decompress(raw) if raw is not None and raw[:2] == b"\x1f\x8b" else raw)

    return F.pandas_udf(run, "binary")(content)


def read_archive_protobuf(spark: SparkSession, root: str, descriptor_file: str, pattern: str = "*.{pb,pb.gz}") -> DataFrame:
    """Protobuf-encoded archive, plain or gzipped, only where the
    ``spark-protobuf`` package is on the classpath (``from_protobuf`` with a
    descriptor set).  A file is one snapshot."""
    from pyspark.sql.protobuf.functions import from_protobuf

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", pattern
    ).load(root)
    return raw.select(
        "path",
        archive_time("path").alias("file_time"),
        from_protobuf(gunzipped("content"), "transit_realtime.FeedMessage", descFilePath=descriptor_file).alias("feed"),
    )


def rebuild_bronze(archive: DataFrame) -> DataFrame:
    """Archive -> position rows (S4): flatten every snapshot with the file
    time as ingest time, then de-duplicate re-delivered snapshots."""
    from headway.operators.positions import dedup, flatten_feed

    rows = flatten_feed(
        archive.select(F.col("feed"), F.unix_seconds(F.col("file_time")).alias("ingest_timestamp")),
        feed_col="feed",
    )
    return dedup(rows)
