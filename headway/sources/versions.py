"""Committed table versions: what a reader sees is always one whole write.

A table is a folder of versions, ``version=0``, ``version=1``, ..., and a small
pointer file that names the current one.  A write goes to a staging folder beside
them first, takes its version's name by a rename once Spark has marked it complete,
and then the pointer is replaced.  A write that fails leaves its staging folder (or
nothing) behind: no reader, and no later write, looks there.  Old versions stay
readable by number until they are dropped.

Two writers cannot take one version: the rename fails for the second, whose write
is then an error.  Readers that started on an old version go on reading it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.sources.paths import exists, folders, read_text, remove_folder, rename_new, replace_text

POINTER, MARKER, SCHEMA = "_current", "_SUCCESS", "_schema.json"


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    names = [n for n in folders(spark, path) if n.startswith("version=")]
    numbers = sorted(int(n.partition("=")[2]) for n in names)
    return [n for n in numbers if exists(spark, f"{version_path(path, n)}/{MARKER}")]


def current_version(spark: SparkSession, path: str) -> int | None:
    """The version that the pointer names; of a table without a pointer the last complete one; None if there is none."""
    pointer = f"{path.rstrip('/')}/{POINTER}"
    if exists(spark, pointer):
        return int(read_text(spark, pointer))
    return max(committed_versions(spark, path), default=None)


def stage(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write ``df`` below ``path`` where no reader looks; the folder.  A failed write is removed and raised."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        write(df, folder)
        if not exists(spark, f"{folder}/{MARKER}"):
            raise RuntimeError(f"{folder} was not marked complete")
        replace_text(spark, f"{folder}/{SCHEMA}", df.schema.json())
    except BaseException:
        remove_folder(spark, folder)
        raise
    return folder


def staged(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """What ``stage`` wrote, with the schema it had."""
    known = f"{folder}/{SCHEMA}"
    reader = spark.read.format(fmt)
    if exists(spark, known):
        reader = reader.schema(StructType.fromJson(json.loads(read_text(spark, known))))
    return reader.load(folder)


def commit(spark: SparkSession, writes: Sequence[tuple[str, str]]) -> list[int]:
    """Make staged folders the current versions of their tables; ``writes`` are (folder, path of the table).

    All folders get their names before the first pointer is replaced, so tables that
    belong together change within a few file operations; their numbers are returned.
    """
    numbers = []
    for folder, path in writes:
        taken = [int(n.partition("=")[2]) for n in folders(spark, path) if n.startswith("version=")]
        numbers.append(max(taken, default=-1) + 1)
        rename_new(spark, folder, version_path(path, numbers[-1]))
    for (_, path), n in zip(writes, numbers, strict=True):
        replace_text(spark, f"{path.rstrip('/')}/{POINTER}", str(n))
    return numbers


def read_version(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The current version, or one by its number; a version that was never completed is no version."""
    if version is None:
        version = current_version(spark, path)
        if version is None:
            raise FileNotFoundError(f"no version of {path}")
    elif not exists(spark, f"{version_path(path, version)}/{MARKER}"):
        raise FileNotFoundError(f"no version {version} of {path}")
    return staged(spark, version_path(path, version), fmt)


def drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Remove the versions before the current one but the last ``keep`` of them, and those that were never completed."""
    now = current_version(spark, path)
    if now is None:
        return
    whole = [n for n in committed_versions(spark, path) if n < now]
    held = set(whole[len(whole) - keep :] if keep else [])
    for name in folders(spark, path):
        if name.startswith("version=") and (n := int(name.partition("=")[2])) < now and n not in held:
            remove_folder(spark, version_path(path, n))
