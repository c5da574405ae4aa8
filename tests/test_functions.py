import datetime as dt
import json

from pyspark.sql import functions as F

from headway.functions.columns import (
    OCCUPANCY_STATUS,
    VEHICLE_STOP_STATUS,
    differs,
    enum_name,
    millis_to_ts,
    mode_label,
    repair_json_backslashes,
    round_half_up,
    severity_label,
    to_bool,
    to_double,
)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_repair_lone_backslash_becomes_valid_json(spark):
    raw = '{"description":"Water \\ Sewer"}'
    with_bad = raw.replace("\\\\", "\\")
    fixed = one(spark, repair_json_backslashes(F.col("v")), with_bad)
    assert json.loads(fixed)["description"] == "Water \\ Sewer"


def test_repair_keeps_valid_escapes_pairwise(spark):
    # An escaped backslash followed by a letter must stay valid (not become three).
    text = '{"a":"x\\\\S","b":"q\\"u","c":"\\u0041\\n"}'
    assert json.loads(text)["a"] == "x\\S"
    fixed = one(spark, repair_json_backslashes(F.col("v")), text)
    assert json.loads(fixed) == json.loads(text)


def test_millis_to_ts_falsy_is_null(spark):
    assert one(spark, millis_to_ts(F.col("v")), "") is None
    assert one(spark, millis_to_ts(F.col("v")), None) is None
    assert one(spark, millis_to_ts(F.col("v")), "0") is None
    got = one(spark, millis_to_ts(F.col("v")), "1700000000000")
    assert got.replace(tzinfo=None) == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_to_bool_is_typed(spark):
    for v, want in [("true", True), ("1", True), ("false", False), ("0", False), ("", False), (None, False)]:
        assert one(spark, to_bool(F.col("v")), v) is want


def test_to_double_float_if_present(spark):
    assert one(spark, to_double(F.col("v")), "") is None
    assert one(spark, to_double(F.col("v")), "43.650000") == 43.65
    assert one(spark, to_double(F.col("v")), "abc") is None


def test_differs_normalises_blank_zero_and_numbers(spark):
    rows = [("", None, "string"), ("0", "0", "int"), ("43.65", "43.650000", "double"), ("King", "King Streetcar", "string")]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a string, b string")
    got = [
        df.select(differs(F.col("a"), F.col("b"), t).alias("d")).collect()[i]["d"] for i, (_, _, t) in enumerate(rows)
    ]
    assert got == [False, False, False, True]
    # An int column compared to the same value as text.
    df2 = spark.createDataFrame([(0, "0")], "a int, b string")
    assert df2.select(differs("a", "b", "int").alias("d")).first()["d"] is False


def test_enum_name_numbers_and_names(spark):
    df = spark.createDataFrame([("1",), ("STOPPED_AT",), (None,)], "v string")
    got = [r["n"] for r in df.select(enum_name("v", VEHICLE_STOP_STATUS).alias("n")).collect()]
    assert got == ["STOPPED_AT", "STOPPED_AT", None]
    assert one(spark, enum_name(F.col("v"), OCCUPANCY_STATUS), "1") == "MANY_SEATS_AVAILABLE"


def test_round_half_up_and_labels(spark):
    assert one(spark, round_half_up(F.col("v"), 0), 2.5, "v double") == 3.0
    assert one(spark, round_half_up(F.col("v"), 1), -0.25, "v double") == -0.3
    got = spark.createDataFrame([(0,), (1,), (3,), (None,)], "v int").select(
        mode_label("v").alias("m"), severity_label("v").alias("s")
    ).collect()
    assert [r["m"] for r in got] == ["Streetcar", "Subway", "Bus", "Other"]
    assert [r["s"] for r in got] == ["Same stop", "One stop apart", "3", None]
