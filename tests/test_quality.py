from headway.operators.quality import no_self_pairs, not_null, run_checks, unique, with_metrics
from pyspark.sql import functions as F


def test_checks_report_failures(spark):
    routes = spark.createDataFrame([("504",), ("504",), ("504",), (None,), (None,)], "route_id string")
    mart = spark.createDataFrame(
        [("504", "a", "a", 1), ("504", "a", "b", 2), (None, "c", "d", None)],
        "route_id string, vehicle_id_a string, vehicle_id_b string, event_time int",
    )
    out = {
        (r["check"], r["table"], r["column"]): r["failures"]
        for r in run_checks({"stg_dim_route_current": routes, "mart_bunching_events": mart}).collect()
    }
    assert out[("not_null", "stg_dim_route_current", "route_id")] == 2
    assert out[("unique", "stg_dim_route_current", "route_id")] == 1  # keys, not rows; NULL is no key
    assert out[("not_null", "mart_bunching_events", "route_id")] == 1
    assert out[("not_null", "mart_bunching_events", "event_time")] == 1
    assert out[("no_self_bunching", "mart_bunching_events", "vehicle_id_a,vehicle_id_b")] == 1
    assert no_self_pairs(mart).count() == 1 and not_null(mart, ["route_id"]).count() == 1
    assert unique(routes, ["route_id"]).count() == 1


def test_metrics_observed_on_write(spark):
    df, obs = with_metrics(spark.range(10), "m", rows=F.count(F.lit(1)), top=F.max("id"))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "top": 9}
