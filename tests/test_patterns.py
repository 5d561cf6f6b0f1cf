"""The pattern dictionary: folding, exact verification, plans."""

from pyspark.sql import functions as F

from conftest import rows
from pickwise.operators import patterns as P
from pickwise.operators.stops import stop_list
from pickwise.operators.trips import trip_profile

SCHEMA = "bundle string, trip_id string, stop_sequence int, stop_id string, arrival_time string"


def times(spark, trips):
    return spark.createDataFrame([(b, t, s, stop, f"{8 + (s or 0) % 3:02d}:00:00") for (b, t), stops in trips.items() for s, stop in stops], SCHEMA)


WAYS = {
    ("a", "t1"): [(1, "x"), (2, "y"), (3, "x")], ("a", "t2"): [(3, "x"), (1, "x"), (2, "y")],  # one way, in another row order
    ("a", "t3"): [(1, "y"), (2, "x"), (3, "x")],  # the same stops in another order
    ("a", "t4"): [(1, "x"), (2, "y")], ("b", "t1"): [(1, "x"), (2, "y"), (3, "x")],  # a part; another bundle
    ("a", "t5"): [(1, "x"), (1, "x"), (2, "y")],  # a doubled row
    ("a", "t6"): [(1, None), (None, "x")], ("a", "t7"): [(1, None), (None, "x")], ("a", "t8"): [(1, "x"), (None, None)],
    ("a", None): [(1, "x"), (2, "y")],
}


def test_trips_fold_to_their_ways(spark):
    p = P.fold(times(spark, WAYS))
    by = {}
    for r in p.trips.collect():
        by.setdefault((r.bundle, r.print_a, r.print_b, r.stop_rows), set()).add(r.trip_id)
    assert sorted(map(lambda s: sorted(map(str, s)), by.values())) == [["None", "t4"], ["t1"], ["t1", "t2"], ["t3"], ["t5"], ["t6", "t7"], ["t8"]]
    spelled = {}
    for r in p.stops.collect():
        spelled.setdefault((r.bundle, r.print_a, r.print_b, r.stop_rows), []).append((r.stop_sequence, r.stop_id))
    assert {k: sorted(v, key=str) for k, v in spelled.items()} == {k: sorted(WAYS[k[0], min(s, key=str)], key=str) for k, s in by.items()}
    assert P.verify(p, times(spark, WAYS)).count() == 0
    assert rows(p.sizes(), "bundle", "n_trips", "n_patterns", "n_stop_times", "n_pattern_rows", "most_trips") == [("a", 9, 6, 22, 15, 2), ("b", 1, 1, 3, 3, 1)]


def test_verification_finds_what_is_not_its_pattern(spark):
    st = times(spark, WAYS)
    p = P.fold(st)
    changed = dict(WAYS)
    changed["a", "t2"] = [(1, "x"), (2, "z"), (3, "x")]
    changed["a", "t7"] = [(1, None), (1, None)]
    assert rows(P.verify(p, times(spark, changed))) == [("a", "t2"), ("a", "t7")]


def test_profile_is_that_of_trips(spark):
    st = times(spark, WAYS)
    want = trip_profile(st)
    assert rows(P.trip_patterns(st), *want.columns) == rows(want, *want.columns)


def test_stop_list_is_the_same(spark):
    st = times(spark, WAYS)
    trips = spark.createDataFrame([("a", "t1", "R1", 0), ("a", "t2", "R2", None), ("a", "t3", "R1", 0), ("b", "t1", None, 1), ("a", "t9", "R9", 0)], "bundle string, trip_id string, route_id string, direction_id int")
    stops = spark.createDataFrame([("a", "x", "X"), ("a", "x", "A"), ("a", "y", None), ("b", "x", "B")], "bundle string, stop_id string, stop_name string")
    assert rows(P.stop_list_of_patterns(trips, P.fold(st), stops)) == rows(stop_list(trips, st, stops))
    assert P.fold(st.limit(0)).stops.count() == 0 and P.stop_list_of_patterns(trips, P.fold(st.limit(0)), stops).count() == 0


def test_folding_sorts_nothing_and_moves_a_row_a_trip(spark):
    st = spark.range(0, 4000, 1, 4).select(F.lit("a").alias("bundle"), F.concat(F.lit("t"), (F.col("id") / 40).cast("int")).alias("trip_id"),
                                           (F.col("id") % 40).cast("int").alias("stop_sequence"), F.concat(F.lit("s"), F.col("id") % 40).alias("stop_id"), F.lit("08:00:00").alias("arrival_time"))
    plan = P.trip_patterns(st)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    p = P.fold(st)
    assert (p.trips.count(), p.trips.select(*P.PATTERN).distinct().count(), p.stops.count()) == (100, 1, 40)
