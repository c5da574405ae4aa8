import os

from pyspark.sql import functions as F

from headway.operators.topk import keep_top_k, top_k
from headway.schemas import POSITION_COLUMNS
from headway.sources.tables import read_bronze, write_bronze


def test_top_k_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k string, v int")
    assert [r["k"] for r in top_k(df, ["-v"], 3, ["k"]).collect()] == ["c", "a", "b"]


def test_keep_top_k_keeps_all_rows_of_the_top_keys(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 5), ("c", 2), ("c", 2), (None, 9)], "k string, n int"
    )
    got = sorted((r["k"], r["n"]) for r in keep_top_k(df, "k", "n", k=2).collect())
    # NULL has the largest total but never matches a key in the semi join
    assert got == [("b", 5)]
    got3 = sorted((r["k"] or "", r["n"]) for r in keep_top_k(df, "k", "n", k=3).collect())
    assert got3 == [("b", 5), ("c", 2), ("c", 2)]


def test_read_bronze_schema_with_partitions(spark, tmp_dir):
    pos = spark.createDataFrame([(1786582800, 1786582805, "e", "7")], "feed_timestamp long, ingest_timestamp long, entity_id string, vehicle_id string")
    pos = pos.select(*[F.col(c) if c in pos.columns else F.lit(None).alias(c) for c in POSITION_COLUMNS])
    path = os.path.join(tmp_dir, "bronze")
    write_bronze(pos, path)
    back = read_bronze(spark, path)
    assert back.columns == [*POSITION_COLUMNS, "date", "hour"]
    r = back.first()
    assert (r["vehicle_id"], r["date"], r["hour"]) == ("7", "2026-08-13", 1)
