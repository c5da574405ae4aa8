from pyspark.sql import functions as F

from headway.operators.scd2 import last_row_wins, scd2_apply, scd2_as_of, scd2_counts, scd2_diff, scd2_join_as_of

TRACKED = ["route_short_name", "route_long_name", "route_type"]
CUR = "route_id string, route_short_name string, route_long_name string, route_type int"
INC = "route_id string, route_short_name string, route_long_name string, route_type string"


def classes(df):
    return {r["route_id"]: r["change"] for r in df.collect()}


def test_diff_new_same_changed_zero_missing(spark):
    current = spark.createDataFrame(
        [("504", "504", "King", 0), ("501", "501", "Queen", 0), ("999", "999", "Gone", 3), ("10", "10", "", 3)], CUR
    )
    incoming = spark.createDataFrame(
        [
            ("504", "504", "King Streetcar", "0"),  # changed
            ("501", "501", "Queen", "0"),  # 0 vs "0": same
            ("700", "700", "New", "3"),  # new
            ("10", "10", None, "3"),  # "" vs NULL: same
        ],
        INC,
    )
    d = scd2_diff(current, incoming, "route_id", TRACKED)
    assert classes(d) == {"504": "changed", "501": "same", "700": "new", "999": "missing", "10": "same"}
    c = scd2_counts(d).first()
    assert (c["inserted"], c["expired"], c["unchanged"]) == (2, 2, 2)
    assert d.where("route_id = '504'").first()["route_type"] == 0  # typed like the dimension


def _history(spark):
    return spark.createDataFrame(
        [
            ("504", "504", "King", 0, "2024-01-01", None, True),
            ("999", "999", "Gone", 3, "2024-01-01", None, True),
            ("999", "999", "Older", 3, "2023-01-01", "2024-01-01", False),
        ],
        CUR + ", valid_from string, valid_to string, is_current boolean",
    ).select(
        "*",
    ).withColumn("valid_from", F.to_timestamp("valid_from")).withColumn("valid_to", F.to_timestamp("valid_to"))


def test_apply_closes_and_opens_without_gap_and_is_idempotent(spark):
    hist = _history(spark)
    inc = spark.createDataFrame([("504", "504", "King Streetcar", "0"), ("888", "888", "Eight", "3")], INC)
    out = scd2_apply(hist, inc, "route_id", TRACKED, "2024-06-01 00:00:00")
    rows = sorted(out.collect(), key=lambda r: (r["route_id"], r["valid_from"]))
    by = [(r["route_id"], r["route_long_name"], r["is_current"]) for r in rows]
    assert by == [
        ("504", "King", False),
        ("504", "King Streetcar", True),
        ("888", "Eight", True),
        ("999", "Older", False),
        ("999", "Gone", False),
    ]
    king_old, king_new = rows[0], rows[1]
    assert king_old["valid_to"] == king_new["valid_from"]  # half-open, no gap
    # Re-applying the same load changes nothing.
    again = scd2_apply(out, inc, "route_id", TRACKED, "2024-07-01 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    # A key that disappeared and re-appears gets a new open row.
    back = scd2_apply(out, spark.createDataFrame([("999", "999", "Gone", "3")], INC), "route_id", TRACKED, "2024-08-01")
    assert back.where("route_id = '999' AND is_current").count() == 1


def test_as_of_and_join_as_of(spark):
    hist = _history(spark)
    at = {r["route_id"]: r["route_long_name"] for r in scd2_as_of(hist, "2023-06-01").collect()}
    assert at == {"999": "Older"}
    facts = spark.createDataFrame([("999", "2023-06-01"), ("999", "2024-02-01"), ("1", "2024-02-01")], "route_id string, t string")
    got = sorted(
        (r["route_id"], r["t"], r["route_long_name"])
        for r in scd2_join_as_of(facts, hist, "route_id", "t", ["route_long_name"]).collect()
    )
    assert got == [("1", "2024-02-01", None), ("999", "2023-06-01", "Older"), ("999", "2024-02-01", "Gone")]


def test_last_row_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, pos int, v string")
    assert sorted((r["k"], r["v"]) for r in last_row_wins(df, "k", "pos").collect()) == [("a", "z"), ("b", "q")]


def test_rows_that_no_key_names_are_carried_through(spark):
    cols = "k string, v string, valid_from timestamp, valid_to timestamp, is_current boolean"
    history = spark.createDataFrame(
        [("a", "1", None, None, True), ("a", "0", None, None, None), (None, "x", None, None, True), ("b", "2", None, None, False)], cols
    )
    incoming = spark.createDataFrame([("a", "9"), (None, "y")], "k string, v string")
    out = scd2_apply(history, incoming, "k", ["v"], "2024-01-01 00:00:00").collect()
    got = sorted((str(r["k"]), r["v"], r["is_current"], r["valid_to"] is not None) for r in out)
    assert got == [
        ("None", "x", True, False),
        ("a", "0", None, False),
        ("a", "1", False, True),
        ("a", "9", True, False),
        ("b", "2", False, False),
    ]
