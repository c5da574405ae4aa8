import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.constraints import check_rows, split_rows
from headway.plans.loaders import load_checked
from headway.sources.parts import last_step, part_folders, read_parts
from headway.sources.tables import read_snapshot

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("part", T.StringType()),
        T.StructField("at", T.TimestampType(), False),
        T.StructField("size", T.IntegerType()),
        T.StructField("kind", T.StringType(), False),
    ]
)
T0 = "2024-01-01 00:00:00"
ROWS = [
    ("1", "a", T0, "5", "x", "more"),
    ("1", "a", T0, "5", "x", "more"),  # a copy
    ("1", "a", T0, "4", "x", "first by size"),
    ("1", None, T0, None, "x", None),  # another key: part is NULL
    ("1", " ", T0, "9", "x", "blank is NULL"),
    ("2", "a", "yesterday", "big", "", None),
    ("2", "a", "yesterday", "big", "", None),
    (None, None, None, None, None, None),
    ("x", "=", T0, "", None, None),
    (" 3 ", "", T0, "07", None, None),
]


def _split(spark, rows=ROWS, **kw):
    raw = spark.createDataFrame(rows, "id string, part string, at string, size string, kind string, extra string")
    checked = check_rows(raw, SCHEMA, {"kind": "none"})
    return [part.collect() for part in split_rows(checked, **kw)]


def test_rows_are_accepted_once_or_refused_with_every_reason(spark):
    accepted, rejected = _split(spark, keys=["id", "part"], order_by=["size"])
    assert sorted((r["id"], r["part"] or "", r["size"] or 0, r["kind"]) for r in accepted) == [(1, "", 0, "x"), (1, "a", 4, "x"), (3, "", 7, "none")]
    got = sorted((str(r["id"]), str(r["size"]), r["reject_reasons"], r["copies"]) for r in rejected)
    assert got == [
        ("1", "5", ["repeated key"], 2),
        ("1", "9", ["repeated key"], 1),
        ("2", "big", ["at is not timestamp", "size is not int"], 2),
        ("None", "None", ["id is null", "at is null"], 1),
        ("x", "", ["id is not bigint"], 1),
    ]
    assert len(accepted) + sum(r["copies"] for r in rejected) == len(ROWS)
    # without a key nothing repeats, and columns of other tables stay with the refused row only
    accepted, rejected = _split(spark)
    assert len(accepted) == 6 and set(rejected[0].asDict()) == {"id", "part", "at", "size", "kind", "extra", "reject_reasons", "copies"}
    assert accepted[0].asDict().keys() == set(SCHEMA.names)
    assert _split(spark, [], keys=["id"]) == [[], []]


def test_copies_of_one_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).cast("string").alias("id"), F.lit(T0).alias("at"), (F.col("id") % 2).alias("size"), F.lit("x").alias("kind")
    )
    accepted, rejected = split_rows(check_rows(rows, SCHEMA), ["id"])
    assert accepted.count() == 2001
    assert sorted((r["size"], r["copies"]) for r in rejected.collect()) == [(0, 499), (1, 500)]


def test_load_commits_both_tables_or_none(spark, tmp_dir):
    table, rejects = (os.path.join(tmp_dir, x) for x in ("t", "r"))
    raw = spark.createDataFrame(ROWS, "id string, part string, at string, size string, kind string, extra string")
    assert load_checked(raw, table, rejects, SCHEMA, ["id", "part"], ["size"], {"kind": "none"}) == (0, 0)
    broken = raw.withColumn("size", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        load_checked(broken, table, rejects, SCHEMA, ["id", "part"])
    assert read_snapshot(spark, table).count() == 3 and read_snapshot(spark, rejects).agg(F.sum("copies")).first()[0] == 7
    assert not [d for d in os.listdir(table) + os.listdir(rejects) if d.startswith("_checked") or d.startswith("_staging")]


def test_stream_files_follow_hours(spark, tmp_dir):
    from headway.schemas import POSITION_SCHEMA
    from headway.streaming.ingest import run_compacted_ingest

    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "out", "ckpt"))

    def send(hour, n):
        row = {f.name: None for f in POSITION_SCHEMA.fields} | {"ingest_timestamp": 1_700_000_000 + hour * 3600 + n, "feed_timestamp": n, "vehicle_id": f"{hour}-{n}"}
        spark.createDataFrame([row], POSITION_SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run(where):
        stream = spark.readStream.schema(POSITION_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        run_compacted_ingest(stream, out, where, "availableNow", compact_over=2).awaitTermination()

    for n in range(5):
        send(0, n)
    run(ckpt)
    assert [len(f) for f in part_folders(spark, out).values()] == [5]  # the hour is open
    send(1, 0)
    run(ckpt)
    assert sorted(len(f) for f in part_folders(spark, out).values()) == [1, 1]
    assert sorted(r["vehicle_id"] for r in read_parts(spark, out).collect()) == [f"0-{n}" for n in range(5)] + ["1-0"]
    assert len(read_parts(spark, out).inputFiles()) == 2 and last_step(spark, out) == -1
    run(os.path.join(tmp_dir, "ckpt2"))  # another query reads all again: nothing of it is taken for a retry
    assert read_parts(spark, out).count() == 12
