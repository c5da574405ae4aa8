"""Tables kept in parts: a write replaces, or adds to, only the partition values it holds.

Every write, a step, goes to a folder of its own, ``step=7/event_month=2024-01/``.
A small manifest names the folders that make up each partition value, and replacing
that one file commits the step for all its values at once.  Values that a step does
not hold keep their files.  A step that fails leaves a folder that no reader looks at
and the next attempt overwrites.  Steps are numbered by their writer, so one that is
given again after its commit (a retry) changes nothing.  Several writers, such as
streams, may take turns on a table, each with a name and numbers of its own.

Writes do not overlap: one write at a time.  Folders that a step replaces are removed by the
step after it, so a reader may stay on the manifest before the current one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.sources.paths import exists, folders, read_text, remove_folder, replace_text
from headway.sources.tables import write_table

MANIFEST = "_manifest.json"


def _manifest(spark: SparkSession, path: str) -> dict:
    file = f"{path}/{MANIFEST}"
    return json.loads(read_text(spark, file)) if exists(spark, file) else {"steps": {}, "parts": {}, "replaced": [], "schema": None}


def last_step(spark: SparkSession, path: str, writer: str = "") -> int:
    """Number of the last step that ``writer`` committed; -1 before the first."""
    return _manifest(spark, path.rstrip("/"))["steps"].get(writer, -1)


def step_folder(step: int, writer: str = "") -> str:
    return f"step={step}-{writer}" if writer else f"step={step}"


def part_folders(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The folders, below ``path``, of each partition value (``event_month=2024-01``)."""
    return _manifest(spark, path.rstrip("/"))["parts"]


def read_parts(spark: SparkSession, path: str, schema: StructType | None = None, values: Collection[str] | None = None) -> DataFrame:
    """The table, or only the partition values with the folder names ``values``.

    ``schema`` is what a table without any step reads as; without it, reading one
    is an error.
    """
    path = path.rstrip("/")
    now = _manifest(spark, path)
    if now["schema"] is not None:
        schema = StructType.fromJson(now["schema"])
    if schema is None:
        raise FileNotFoundError(f"no step of {path}")
    found = [f"{path}/{f}" for value, parts in now["parts"].items() if values is None or value in values for f in parts]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found).select(*schema.names)


def put_parts(
    df: DataFrame,
    path: str,
    by: str,
    step: int,
    replaces: Callable[[str], bool] = lambda value: True,
    sort_within: Sequence[str] | None = None,
    clear: Collection[str] = (),
    writer: str = "",
) -> list[str]:
    """Commit ``df`` as step ``step`` of ``writer``: the folder names of the partition values written.

    Values that ``replaces`` says yes to are replaced by their rows in ``df``, the
    others are added to; values in ``clear`` are replaced even where ``df`` has no
    rows of them.  A step that is not above the writer's last one was committed before
    and changes nothing.  ``df`` may read the table itself.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    now = _manifest(spark, path)
    if step <= now["steps"].get(writer, -1):
        return []
    now["steps"][writer] = step
    return _put(df, path, by, step_folder(step, writer), now, replaces, sort_within, clear)


def _put(
    df: DataFrame,
    path: str,
    by: str,
    folder: str,
    now: dict,
    replaces: Callable[[str], bool],
    sort_within: Sequence[str] | None,
    clear: Collection[str] = (),
) -> list[str]:
    spark = df.sparkSession
    write_table(df, f"{path}/{folder}", partition_by=[by], sort_within=sort_within)
    values = [v for v in folders(spark, f"{path}/{folder}") if v.startswith(f"{by}=")]
    parts, replaced = dict(now["parts"]), []
    for value in {*values, *clear}:
        if value in clear or replaces(value):
            replaced += parts.pop(value, [])
    for value in values:
        parts[value] = [*parts.get(value, []), f"{folder}/{value}"]
    new = {"steps": now["steps"], "parts": parts, "replaced": replaced, "schema": df.schema.jsonValue()}
    replace_text(spark, f"{path}/{MANIFEST}", json.dumps(new))
    for old in now["replaced"]:
        remove_folder(spark, f"{path}/{old}")
    return values


def compact_parts(
    spark: SparkSession,
    path: str,
    by: str,
    sort_within: Sequence[str] | None = None,
    folders_over: int = 1,
    but: Collection[str] = (),
) -> list[str]:
    """Rewrite the values, other than ``but``, that more than ``folders_over`` folders make up, each into files that
    follow its volume; their names.

    The rows stay the same; readers see the old files until the new ones are committed,
    and may go on reading them until the next write.
    """
    path = path.rstrip("/")
    now = _manifest(spark, path)
    many = [v for v, parts in now["parts"].items() if len(parts) > folders_over and v not in but]
    if not many:
        return []
    rows = read_parts(spark, path, values=many)
    return _put(rows, path, by, f"step=compact-{uuid.uuid4().hex}", now, lambda value: True, sort_within)
