import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E
from headway.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "bunching_events" in df.columns


def test_every_query_has_an_oracle_except_non_sql():
    missing = set(catalog.all_queries()) - set(E.oracle_sql())
    assert missing == set(), missing


def test_sample_queries_match_oracle_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in ("events", "customer", "supplier", "part", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("bunching_events", "mart_bunching_hourly", "scd2_diff", "stops_near_restrictions", "report_by_mode"):
        s = sorted(tuple(map(str, r)) for r in E.queries()[name](spark, SF).collect())
        cur = con.execute(E.oracle_sql()[name])
        d = sorted(tuple(map(str, r)) for r in cur.fetchall())
        assert len(s) == len(d), name
