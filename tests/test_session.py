from types import SimpleNamespace

import pytest

from headway import session
from headway.sources.paths import exists


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=dict)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_the_named_folder_is_used_everywhere():
    made = []
    sc = SimpleNamespace(
        master="yarn",
        getCheckpointDir=lambda: made[-1] if made else None,
        setCheckpointDir=made.append,
        getConf=lambda: {"spark.checkpoint.dir": "hdfs://store/ckpt"},
    )
    assert session.checkpoint_dir(SimpleNamespace(sparkContext=sc)) == "hdfs://store/ckpt"


def test_scratch_tables_end_with_their_scope(spark):
    outside = session.scratch_path(spark, "kept")
    with session.scratch_scope(spark) as outer:
        first = session.scratch_path(spark, "a")
        spark.range(3).write.parquet(first)
        with session.scratch_scope(spark) as inner:
            second = session.scratch_path(spark, "b")
            spark.read.parquet(first).write.parquet(second)
            spark.read.parquet(second).write.parquet(outside)
        assert first.startswith(outer) and second.startswith(inner) and exists(spark, first) and not exists(spark, inner)
    assert not exists(spark, outer) and spark.read.parquet(outside).count() == 3
    with pytest.raises(RuntimeError), session.scratch_scope(spark) as failed:
        spark.range(1).write.parquet(session.scratch_path(spark, "c"))
        raise RuntimeError
    assert not exists(spark, failed) and not session.scratch_path(spark, "d").startswith(failed)
