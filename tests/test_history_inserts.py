import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.scd2 import scd2_apply, scd2_as_of
from headway.plans.history import load_history, read_as_of, read_history, store_history
from headway.sources.inserts import insert_batch, may_hold
from headway.sources.parts import part_folders, read_parts

HISTORY = "key string, value string, note string, valid_from timestamp, valid_to timestamp, is_current boolean"


def _rows(df):
    return sorted(map(str, df.collect()))


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _history(spark):
    rows = [
        ("a", "1", "x", "2024-01-01", None, True),
        ("a", "0", "x", "2023-01-01", "2024-01-01", False),
        ("b", "1", None, "2024-01-01", None, True),
        ("c", "1", None, "2024-01-01", None, True),
        ("d", "1", None, "2024-01-01", None, None),  # flagged neither way
        (None, "1", None, "2024-01-01", None, True),  # no key
    ]
    df = spark.createDataFrame(rows, "key string, value string, note string, f string, t string, is_current boolean")
    return df.select("key", "value", "note", F.col("f").cast("timestamp").alias("valid_from"), F.col("t").cast("timestamp").alias("valid_to"), "is_current")


def test_loads_equal_scd2_apply_and_leave_closed_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "history")
    store_history(_history(spark), path, "key")
    closed = {f: t for f, t in _files(path).items() if "ended=open" not in f}
    loads = [
        ("2024-02-01 00:00:00", [("a", "2"), ("b", "1"), ("e", "1"), (None, "9")], {"inserted": 2, "expired": 2, "unchanged": 1}),
        ("2024-02-15 00:00:00", [("a", "2"), ("b", "1"), ("e", "1")], {"inserted": 0, "expired": 0, "unchanged": 3}),
        ("2024-03-01 00:00:00", [("a", "3")], {"inserted": 1, "expired": 3, "unchanged": 0}),
        ("2024-03-09 00:00:00", [], {"inserted": 0, "expired": 1, "unchanged": 0}),
        ("2024-04-01 00:00:00", [("a", "4")], {"inserted": 1, "expired": 0, "unchanged": 0}),
    ]
    plain = _history(spark)
    for step, (ts, rows, counts) in enumerate(loads, 1):
        incoming = spark.createDataFrame(rows, "key string, value string")
        assert load_history(incoming, path, "key", ["value"], ts, step) == counts
        plain = spark.createDataFrame(scd2_apply(plain, incoming, "key", ["value"], ts).collect(), HISTORY)
        assert _rows(read_history(spark, path)) == _rows(plain), ts
        assert load_history(incoming, path, "key", ["value"], "2030-01-01 00:00:00", step)["inserted"] == 0  # sent again
    for ts in ("2023-06-01 00:00:00", "2024-02-10 00:00:00", "2024-03-05 00:00:00", "2024-05-01 00:00:00"):
        assert _rows(read_as_of(spark, path, ts)) == _rows(scd2_as_of(plain, ts)), ts
    assert closed.items() <= _files(path).items()
    assert len(part_folders(spark, path)["ended=2024-03"]) == 2
    plan = read_as_of(spark, path, "2024-03-05 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "ended" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_the_first_load_needs_a_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "history")
    schema = T.StructType.fromDDL("id long, " + HISTORY)
    incoming = spark.createDataFrame([("a", "1"), ("b", "")], "key string, value string")
    assert load_history(incoming, path, "key", ["value"], "2024-01-01", 0, schema, surrogate_key="id") == {"inserted": 2, "expired": 0, "unchanged": 0}
    rows = read_history(spark, path)
    assert rows.schema.names == schema.names and rows.where("id is null").isEmpty() and rows.where("value is null").count() == 1


def _batch(spark, rows):
    df = spark.createDataFrame(rows, "station string, at string, value int")
    return df.withColumn("at", F.to_timestamp("at"))


def test_batches_are_inserted_once_and_read_only_their_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "facts")
    first = [("s", f"2024-0{m}-01 00:00:00", m) for m in range(1, 7)] + [("s", "2024-01-01 00:00:00", 0)]
    assert insert_batch(_batch(spark, first), path, ["station", "at"], "at", 0) == 6
    before = _files(path)
    second = [("s", "2024-02-01 00:00:00", 9), ("s", "2024-02-01 00:00:01", 7), ("t", "2024-03-01 00:00:00", 8), (None, "2024-03-01 00:00:00", 5), ("u", None, 1)]
    assert insert_batch(_batch(spark, second), path, ["station", "at"], "at", 1) == 4
    assert insert_batch(_batch(spark, second), path, ["station", "at"], "at", 1) == 0
    assert before.items() <= _files(path).items() and not [d for d in os.listdir(path) if d.startswith("_batch")]
    got = {(r["station"], str(r["at"]), r["value"]) for r in read_parts(spark, path).collect()}
    assert len(got) == 10 and ("s", "2024-02-01 00:00:00", 2) in got and ("s", "2024-01-01 00:00:00", 0) in got
    batch = _batch(spark, second)
    rows = may_hold(spark, path, batch, ["event_month=2024-02", "event_month=2024-03"], "at", read_parts(spark, path).schema)
    assert {f.split("event_month=")[1][:7] for f in rows.inputFiles()} == {"2024-02", "2024-03"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThanOrEqual(at" in plan
    assert insert_batch(_batch(spark, []), path, ["station", "at"], "at", 2) == 0
