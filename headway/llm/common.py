"""Shared helpers of the training-data operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import checkpoint_dir, ensure_utc, scratch_path

__all__ = ["checkpoint_dir", "local_or_remote", "read_table", "scratch_path", "written", "word_table"]


#: Bytes of rows that a Python worker is given at a time, in a session that keeps Spark's default.
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the session's Python workers this package, wherever the driver found it (once for an application), and
    rows in batches that keep a worker's memory small however long the texts are."""
    held = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(held) in ("67108864b", "64m", "64MB"):  # Spark's default
        spark.conf.set(held, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent.parent
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(made)  # Spark sends it to the executors


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder that every executor reads."""
    ship_code(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_worker: dict[str, tuple] = {}


def worker_state(kind: str, key, make):
    """What a Python worker keeps from task to task: one thing, of the operator that runs now.

    A worker serves one operator after another; what an earlier one has kept is
    let go, so that a worker's memory is that of its largest operator.
    """
    held = _worker.get(kind)
    if held is None or held[0] != key:
        release_worker()
        _worker[kind] = held = (key, make())
    return held[1]


def release_worker() -> None:
    """Let go what a Python worker has kept of an operator before this one, which keeps nothing itself."""
    if _worker:
        import gc

        import pyarrow as pa

        _worker.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def local_or_remote(uri: str):
    """(pyarrow file system, path) of a folder or file in the shared storage."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that appears under its name only when complete, so that a task that is run again may write it again."""

    def __init__(self, uri: str):
        self.fs, self.path = local_or_remote(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.stream = self.fs.open_output_stream(self.part, compression=None)

    def __enter__(self):
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def make_folder(uri: str) -> None:
    fs, path = local_or_remote(uri)
    fs.create_dir(path, recursive=True)


def word_table(separators: str, lower: bool) -> bytes:
    """A byte table for ``bytes.translate``: separators (all ASCII) become spaces, A-Z lower-case if asked for.

    UTF-8 bytes of other characters are above 127, so word rules that name only
    ASCII characters can be applied to the bytes.
    """
    table = bytearray(range(256))
    for c in separators.encode("ascii"):
        table[c] = 0x20
    if lower:
        for c in range(0x41, 0x5B):
            table[c] += 0x20
    return bytes(table)


#: The separators of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
NOT_ALPHANUMERIC = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def text_bytes(column: str = "text"):
    """The UTF-8 bytes of a text column; null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))
