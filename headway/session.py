"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every job relies on: timestamps are reasoned about in UTC
# (hour-of-day reports are UTC by design) and AQE re-plans joins/shuffles at
# runtime (coalescing small partitions, splitting skewed join partitions).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state (dedup keys) lives in RocksDB: off-heap, spills to local
    # disk and checkpoints incrementally, so state can outgrow executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "headway",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so on a
    cluster the submit-time configuration wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests, one machine) may leave it unset; a private folder
    is made there.  On a cluster executors would not see such a folder, so an
    unset option is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not _one_machine(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="headway-ckpt-"))
        current = sc.getCheckpointDir()
    return current


def _one_machine(master: str) -> bool:
    """``local``, ``local[8]``, but not ``local-cluster[...]``, whose executors are processes of their own."""
    return master == "local" or master.startswith("local[")


_scopes: dict[str, list[str]] = {}


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables made inside the block lie in one folder, which is removed at its end, also after an error.

    Whatever is to last is written inside the block to a path of its own: a
    frame that still reads a scratch table cannot be read after it.  Scopes may
    be nested; threads of one application share the innermost.
    """
    from headway.sources.paths import remove_folder

    folder = scratch_path(spark, "scope")
    scopes = _scopes.setdefault(spark.sparkContext.applicationId, [])
    scopes.append(folder)
    try:
        yield folder
    finally:
        scopes.remove(folder)
        remove_folder(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, or of the current scope, for a written table."""
    scopes = _scopes.get(spark.sparkContext.applicationId)
    base = (scopes[-1] if scopes else checkpoint_dir(spark)).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def local_test_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench (``local[N]``)."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return build_session(
        app="headway-local",
        master=f"local[{cpus}]",
        shuffle_partitions=shuffle_partitions,
        conf={"spark.driver.memory": "8g", "spark.sql.execution.arrow.pyspark.enabled": "true"},
    )
