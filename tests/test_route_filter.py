"""The route filter: shapes, trips and stop times narrowed before they are profiled."""

from conftest import rows
from pickwise.operators import variants as V

TRIPS = "bundle string, route_id string, trip_id string, service_id string, trip_headsign string, direction_id int, shape_id string"
TIMES = "bundle string, trip_id string, stop_sequence int, stop_id string, departure_time string"
STOPS = "bundle string, stop_id string, stop_name string, stop_lat double, stop_lon double"
DAYS = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"


def tables(spark):
    trips = [("a", "R1", "t1", "S", "H", 0, "x"), ("a", "R2", "t2", "S", "H", 0, "x"), ("a", "R2", "t0", "S", "G", 0, "x"),
             ("a", "R2", "t3", "S", "H", 0, "y"), ("a", "R1", "t4", "S", "H", 0, None), ("b", "R2", "t5", "S", "H", 0, "x"),
             ("b", "R1", "t6", "S", "H", None, "z"), ("a", None, "t7", "S", "H", 0, "x")]
    times = [(b, t, n, f"s{n}", "08:00:00") for b, _, t, *_ in trips for n in (1, 2, 3)]
    stops = [(b, f"s{n}", f"Stop {n}", 40.5 + n / 100, -74.0 + n / 90) for b in "ab" for n in (1, 2, 3)]
    return (spark.createDataFrame(trips, TRIPS), spark.createDataFrame(times, TIMES), spark.createDataFrame(stops, STOPS),
            spark.createDataFrame([("a", "S", 1, 1, 1, 1, 1, 0, 0)], f"bundle string, service_id string, {DAYS}"))


def test_filtered_metrics_are_the_rows_of_all(spark):
    t = tables(spark)
    whole = V.variant_metrics(*t)
    for wanted in (["R1"], "^R1$", ["R1", "R2"], ["R9"], [], "R"):
        got = V.variant_metrics(*t, route_filter=wanted)
        assert rows(got, *whole.columns) == rows(V.of_routes(whole, wanted))
    # a shape's trips on other routes, or on none, still count
    assert rows(V.variant_metrics(*t, route_filter=["R1"]), "bundle", "shape_id", "trip_count", "first_trip") == [("a", "x", 4, "t0"), ("b", "z", 1, "t6")]


def test_only_wanted_shapes_reach_the_profile(spark):
    trips, times, _, _ = tables(spark)
    kept, st = V.reduce_to_routes(trips, times, ["R1"])
    assert rows(kept, "bundle", "trip_id") == [("a", "t0"), ("a", "t1"), ("a", "t2"), ("a", "t7"), ("b", "t6")]
    assert (st.count(), times.count()) == (15, 24)
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan and "Aggregate" not in plan
