import datetime as dt
import random


from headway.operators.nearest import nearest_join

T0 = dt.datetime(2024, 1, 1)


def brute(left, right, tol=None, keyed=False):
    out = {}
    for lid, lt, lk in left:
        cands = [(abs((rt - lt).total_seconds()), rt, rid) for rid, rt, rk in right if (not keyed or rk == lk)]
        if not cands:
            out[lid] = None
            continue
        d, rt, rid = min(cands)
        out[lid] = None if (tol is not None and d > tol) else rid
    return out


def run(spark, left, right, **kw):
    l_df = spark.createDataFrame(left, "lid int, lt timestamp, k string")
    r_df = spark.createDataFrame(right, "rid int, rt timestamp, k string")
    by = ["k"] if kw.pop("keyed", False) else None
    got = nearest_join(l_df, r_df, "lt", "rt", by=by, right_cols=["rid"], tie_cols=["rt", "rid"], **kw)
    return {r["lid"]: r["rid"] for r in got.collect()}


def test_matches_brute_force_random(spark):
    rnd = random.Random(3)
    right = [(i, T0 + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), rnd.choice("ab")) for i in range(60)]
    left = [(i, T0 + dt.timedelta(seconds=rnd.randint(-86400, 7 * 86400)), rnd.choice("abc")) for i in range(400)]
    assert run(spark, left, right) == brute(left, right)
    assert run(spark, left, right, keyed=True) == brute(left, right, keyed=True)
    assert run(spark, left, right, tolerance_seconds=3600) == brute(left, right, tol=3600)
    assert run(spark, left, right, tolerance_seconds=3600, small_rows=0) == brute(left, right, tol=3600)
    for slices in (1, 2, 50):
        assert run(spark, left, right, keyed=True, slices=slices, small_rows=0) == brute(left, right, keyed=True)
        assert run(spark, left, right, slices=slices, small_rows=0) == brute(left, right)


def test_exact_tie_goes_to_earlier_and_duplicate_times(spark):
    right = [(1, T0, "a"), (2, T0 + dt.timedelta(seconds=10), "a"), (3, T0 + dt.timedelta(seconds=10), "a")]
    left = [(1, T0 + dt.timedelta(seconds=5), "a"), (2, T0 + dt.timedelta(seconds=9), "a")]
    assert run(spark, left, right) == {1: 1, 2: 2}


def test_empty_right_gives_nulls(spark):
    left = [(1, T0, "a")]
    assert run(spark, left, []) == {1: None}
    assert run(spark, left, [], keyed=True) == {1: None}


def test_crowded_times_are_exact(spark):
    rnd = random.Random(5)
    # a third of the observations crowd into one minute, the rest spread over days
    right = [(i, T0 + dt.timedelta(seconds=3600 + rnd.random() * 60), rnd.choice("ab")) for i in range(40)]
    right += [(100 + i, T0 + dt.timedelta(seconds=rnd.randint(0, 4 * 86400)), rnd.choice("ab")) for i in range(80)]
    left = [(i, T0 + dt.timedelta(seconds=3550 + rnd.random() * 160), rnd.choice("ab")) for i in range(150)]
    left += [(1000 + i, T0 + dt.timedelta(seconds=rnd.randint(-3600, 5 * 86400)), rnd.choice("ab")) for i in range(150)]
    want, want_k = brute(left, right), brute(left, right, keyed=True)
    for kw in ({}, {"slices": 1, "small_rows": 0}, {"slices": 9, "small_rows": 0}, {"small_rows": 0}):
        assert run(spark, left, right, **kw) == want
        assert run(spark, left, right, keyed=True, **kw) == want_k


def test_null_times_and_keys_and_repeated_rows(spark):
    right = [(1, T0, "a"), (2, None, "a"), (3, T0, None), (4, T0, "a"), (5, T0 + dt.timedelta(days=9), "b")]
    left = [(1, T0, "a"), (2, None, "a"), (3, T0, None), (4, T0 + dt.timedelta(days=2), "b"), (5, T0, "z")]
    for bound in (0, 100):
        assert run(spark, left, right, keyed=True, small_rows=bound) == {1: 1, 2: None, 3: None, 4: 5, 5: None}
        assert run(spark, left, right, small_rows=bound)[2] is None


def test_a_burst_with_an_old_outlier_is_cut_evenly(spark):
    # slices follow the points, not the span: one observation 50 years earlier changes little
    from headway.operators.nearest import _in_slices
    from pyspark.sql import functions as F

    burst = spark.range(4000).select((F.lit(1_700_000_000_000_000) + F.col("id") * 4000).alias("_t"))
    old = spark.createDataFrame([(1_000_000,)], "_t long")
    sizes = [r["count"] for r in _in_slices(burst.unionByName(old), [], 8).groupBy("_s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 800
