"""Null keys left out on request, exact integer division, and first arrivals without a sort of stop_times."""

import datetime

from conftest import SMALL, rows
from pickwise.functions.dates import idiv
from pickwise.operators import routes
from pickwise.operators.trips import trip_profile


def test_integer_division_is_exact(spark):
    big = [(9_007_199_254_740_993, ), (-7, ), (7, ), (None, ), (9_223_372_036_854_775_807, )]
    df = spark.createDataFrame(big, "n long")
    assert [r[0] for r in df.select(idiv("n", 2)).collect()] == [4_503_599_627_370_496, -3, 3, None, 4_611_686_018_427_387_903]
    assert "div" in df.select(idiv("n", 10))._jdf.queryExecution().optimizedPlan().toString()


def test_literal_summary_leaves_out_null_keys(spark):
    day = datetime.date(2024, 1, 3)
    trips = [("a", "R1", "t1", 0), ("a", "R2", "t2", 0), ("a", "R3", "t3", 0), ("a", "R1", "t4", None), ("a", None, "t5", 1)]
    t = spark.createDataFrame([(*r, "S", "x") for r in trips], "bundle string, route_id string, trip_id string, direction_id int, service_id string, shape_id string")
    st = spark.createDataFrame([(b, i, 1, "s", "08:00:00") for b, _, i, _ in trips], "bundle string, trip_id string, stop_sequence int, stop_id string, arrival_time string")
    named = spark.createDataFrame([("a", "R1", "1", "One"), ("a", "R3", "3", None)], "bundle string, route_id string, route_short_name string, route_long_name string")
    services = spark.createDataFrame([("a", day, "Weekday", "S")], "bundle string, service_date date, daytype string, service_id string")

    def summary(**kw):
        return rows(routes.route_summary(t, st, named, None, None, services=services, **kw), "route_id", "total_trips")

    assert summary() == [("R1", 2), ("R2", 1), ("R3", 1), (None, 1)]
    assert summary(literal=True) == [("R1", 1)]


def test_first_arrival_text(spark):
    st = spark.createDataFrame(
        [("a", "t1", 2, "s", "08:05:00"), ("a", "t1", 1, "s", None), ("a", "t1", 3, "s", "8:1"), ("a", "t2", 1, "s", None), ("a", "t3", 5, "s", "noon"),
         ("a", "t4", 0, "s", ""), ("a", None, 1, "s", "25:00:00"), ("b", "t1", 1, "s", "08:05:00"), ("a", "t5", None, "s", "09:00:00")],
        "bundle string, trip_id string, stop_sequence int, stop_id string, arrival_time string")
    got = rows(trip_profile(st, with_text=True), "bundle", "trip_id", "first_arrival", "first_min")
    assert got == sorted([("a", "t1", "08:05:00", 485), ("a", "t2", None, None), ("a", "t3", "noon", None), ("a", "t4", "", None),
                          ("a", None, "25:00:00", 1500), ("b", "t1", "08:05:00", 485), ("a", "t5", None, None)], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert trip_profile(st.limit(0), with_text=True).count() == 0


def test_first_arrivals_sort_nothing(spark):
    from pickwise.plans.catalog import REGISTRY
    plan = REGISTRY["trip_first_departure"][0](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1
