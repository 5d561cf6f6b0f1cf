"""Counts of what loading loses or multiplies."""

from pyspark.sql import Observation

from conftest import rows
from pickwise.operators import quality as Q
from pickwise.sources.tables import bundle_trips

TRIPS = [("a", "R1", "t1"), ("a", "R2", "t2"), ("a", "R3", "t3"), ("a", None, "t4"), ("a", "R9", "t5"), ("b", "R1", "t1"), ("c", "R1", "t1")]
ROUTES = [("a", "R1", "X"), ("a", "R1", "X"), ("a", "R2", "X"), ("a", "R2", "Y"), ("a", "R2", None), ("a", "R3", None), ("b", "R1", "X"), ("a", None, "X")]
TIMES = [("a", "t1", 1, "s1"), ("a", "t1", 1, "s2"), ("a", "t1", 2, "s9"), ("a", "t2", None, "s1"), ("a", "t2", None, "s1"),
         ("a", "t8", 1, "s1"), ("a", None, 1, None), ("b", "t1", 1, "s1"), ("d", "t1", 3, "s1"), ("d", "t1", 3, "s1")]
STOPS = [("a", "s1", "One"), ("a", "s2", "Two"), ("a", "s2", "Two again"), ("b", "s1", "One")]


def tables(spark):
    return (spark.createDataFrame(TRIPS, "bundle string, route_id string, trip_id string"), spark.createDataFrame(ROUTES, "bundle string, route_id string, agency_id string"),
            spark.createDataFrame(TIMES, "bundle string, trip_id string, stop_sequence int, stop_id string"), spark.createDataFrame(STOPS, "bundle string, stop_id string, stop_name string"))


def test_counts_of_a_feed_with_every_fault(spark):
    got = {(r.bundle, r.check_name): r.n_rows for r in Q.quality_counts(*tables(spark)).collect()}
    assert set(got) == {(b, c) for b in "abcd" for c in Q.CHECKS}
    assert {k: v for k, v in got.items() if v} == {
        ("a", "trips_without_route"): 2, ("a", "trips_doubled_by_agency"): 2, ("a", "trips_without_stop_times"): 3,
        ("a", "stop_times_without_trip"): 2, ("a", "stop_times_without_stop"): 2, ("a", "doubled_sequences"): 1,
        ("c", "trips_without_route"): 1, ("c", "trips_without_stop_times"): 1,
        ("d", "stop_times_without_trip"): 2, ("d", "stop_times_without_stop"): 2, ("d", "doubled_sequences"): 1}


def test_counts_come_with_the_work(spark):
    trips, routes, times, _ = tables(spark)
    seen, timed = Observation(), Observation()
    got = rows(Q.watched_trips(trips, routes, seen))
    assert got == rows(bundle_trips(trips, routes).select("bundle", "route_id", "trip_id", "agency_id"))
    assert seen.get == {"trips": 7, "trips_without_route": 3, "trips_doubled_by_agency": 2}
    assert rows(Q.watched_stop_times(times, trips, timed)) == sorted(
        [t for t in TIMES if (t[0], t[1]) in {(b, i) for b, _, i in TRIPS}], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert timed.get == {"stop_times": 10, "stop_times_without_trip": 4}


def test_empty_tables_count_nothing(spark):
    trips, routes, times, stops = (t.limit(0) for t in tables(spark))
    seen = Observation()
    assert Q.quality_counts(trips, routes, times, stops).count() == 0
    assert Q.watched_trips(trips, routes, seen).collect() == []
    assert seen.get == {"trips": 0, "trips_without_route": 0, "trips_doubled_by_agency": 0}
