"""Variant metrics, main variant, type rules, projection and similarity."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F

from conftest import rows
from pickwise.functions import similarity as S
from pickwise.functions.geo import project_xy
from pickwise.operators import matching, variants

TRIPS = "bundle string, route_id string, trip_id string, service_id string, trip_headsign string, " \
        "direction_id int, block_id string, shape_id string"
ST = "bundle string, trip_id string, stop_id string, arrival_time string, departure_time string, stop_sequence int"
CAL = "bundle string, service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, " \
      "saturday int, sunday int, start_date int, end_date int"


def test_projection_matches_definition(spark):
    df = spark.createDataFrame([(-74.0, 40.0 + 10 / 60), (-73.9857, 40.7484)], "lon double, lat double")
    x, y = project_xy("lon", "lat")
    got = [(round(a, 2), round(b, 2)) for a, b in df.select(x, y).collect()]
    assert got == [(984250.0, 0.0), (988212.24, 211939.28)]


def _fixture(spark):
    trips = spark.createDataFrame([
        ("b", "R1", "T2", "WK", "Downtown", 0, None, "A"),
        ("b", "R1", "T1", "WK", "Downtown", 0, None, "A"),      # first trip of A is T1 (smallest id, Q20)
        ("b", "R1", "T3", "WK", "Downtown", 0, None, "A"),
        ("b", "R1", "T4", "WK", "Downtown Ltd", 0, None, "L"),
        ("b", "R1", "T5", "WK", "Downtown Ltd", 0, None, "L"),
        ("b", "R1", "T6", "WK", "Downtown Ltd", 0, None, "L"),
        ("b", "R1", "T7", "WK", None, 0, None, "O"),             # one trip: other/unknown
        ("b", "R1", "T8", "SA", "Downtown", 0, None, "W"),       # weekend-only shape
        ("b", "R1", "T9", "WK", "Downtown", 0, None, "S"),
        ("b", "R1", "TA", "WK", "Downtown", 0, None, "S"),
        ("b", "R1", "TB", "WK", "Downtown", 0, None, "S"),
        ("b", "R1", "TC", "WK", "x", 0, None, None)], TRIPS)     # no shape: not a variant
    pts = {"s1": (40.60, -74.00), "s2": (40.61, -74.00), "s3": (40.62, -74.00), "s4": (40.63, -74.00),
           "s5": (40.64, -74.00)}
    stops = spark.createDataFrame([("b", k, k.upper(), la, lo) for k, (la, lo) in pts.items()],
                                  "bundle string, stop_id string, stop_name string, stop_lat double, stop_lon double")
    st = []
    for t, seq_stops, dep in [("T1", ["s1", "s2", "s3", "s4", "s5"], "10:00:00"), ("T2", ["s1"], "07:30:00"),
                              ("T3", ["s1"], "07:30:00"), ("T4", ["s1", "s5"], "11:00:00"),
                              ("T7", ["s1", "s2"], "12:00:00"), ("T8", ["s1", "s2", "s3"], "12:00:00"),
                              ("T9", ["s1", "s2", "s3", "s4"], "07:15:00"), ("TA", ["s1"], "14:30:00"),
                              ("TB", ["s1"], "31:00:00")]:
        for i, s in enumerate(seq_stops, start=1):
            st.append(("b", t, s, dep, dep, i))
    cal = spark.createDataFrame([("b", "WK", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231),
                                 ("b", "SA", 0, 0, 0, 0, 0, 1, 0, 20240101, 20241231)], CAL)
    return trips, spark.createDataFrame(st, ST), stops, cal


def test_variant_metrics_and_types(spark):
    trips, st, stops, cal = _fixture(spark)
    vt = variants.variant_type(variants.main_variant(variants.variant_metrics(trips, st, stops, cal)))
    got = {r.shape_id: r for r in vt.collect()}
    assert set(got) == {"A", "L", "O", "W", "S"}
    a = got["A"]
    assert (a.trip_count, a.stop_count, a.start_stop, a.end_stop, a.inferred_variant_type) == (3, 5, "S1", "S5", "main")
    assert got["L"].inferred_variant_type == "limited"           # headsign word and 60 % fewer stops
    assert got["O"].inferred_variant_type == "other/unknown"     # <= 2 trips
    assert got["W"].daytype == "weekend" and got["W"].inferred_variant_type == "main"
    s = got["S"]
    assert s.school is True and s.inferred_variant_type == "school"   # 07:15, 14:30, 31:00 -> 07:00 (hour mod 24)
    assert a.length_ft > 0 and abs(a.length_ft - 4 * got["L"].length_ft / 4) < 1e-6


def test_school_vacuous_and_missing_coordinates(spark):
    trips = spark.createDataFrame([("b", "R", "T1", "WK", "h", 0, None, "Z")], TRIPS)
    st = spark.createDataFrame([("b", "T1", "s1", "10:00:00", "10:00:00", 2), ("b", "T1", "s2", "10:05:00", "10:05:00", 3)], ST)
    stops = spark.createDataFrame([("b", "s1", "A", 40.6, -74.0), ("b", "s2", "B", None, -74.0)],
                                  "bundle string, stop_id string, stop_name string, stop_lat double, stop_lon double")
    cal = spark.createDataFrame([], CAL)
    r = variants.variant_metrics(trips, st, stops, cal).collect()[0]
    assert r.school is True            # no stop_sequence == 1 row: vacuously true (Q21)
    assert r.length_ft is None         # missing coordinate -> null length
    assert r.daytype == "weekday"      # no calendar row
    main = variants.main_variant(variants.variant_metrics(trips, st, stops, cal)).collect()[0]
    assert main.score == 0.6 * 1 + 0.1 * 2   # null length counts 0 (Q22)


def test_main_tie_goes_to_smallest_shape(spark):
    df = spark.createDataFrame([("b", "R", "weekday", 0, s, 5, 10, 100.0) for s in ["B", "A", "C"]],
                               "bundle string, route_id string, daytype string, direction_id int, shape_id string, "
                               "trip_count long, stop_count long, length_ft double")
    m = variants.main_variant(df).select("main_shape_id").distinct().collect()
    assert [r[0] for r in m] == ["A"]   # Q23


def test_exactly_one_main_per_group(spark):
    from pickwise.plans.catalog import REGISTRY
    from conftest import SMALL
    vt = REGISTRY["variant_table"][0](spark, SMALL)
    bad = (vt.groupBy("bundle", "route_id", "daytype", "direction_id")
           .agg(F.sum(F.when(F.col("inferred_variant_type") == "main", 1).otherwise(0)).alias("m"))
           .where("m != 1").count())
    assert bad == 0


def test_similarity_components(spark):
    df = spark.createDataFrame([
        (["a", "b"], ["b", "c"], None, None, None, None, " Main ", "main", 10, 20),
        ([], [], "x", "y", "x", "y", None, "main", 0, 0),
        (["a"], [], "x", "y", "x", "z", "A", "B", None, 3)],
        "a array<string>, b array<string>, sa string, ea string, sb string, eb string, ha string, hb string, "
        "ta int, tb int")
    got = df.select(S.sim_stop_set("a", "b"), S.sim_start_end("sa", "ea", "sb", "eb"),
                    S.sim_headsign("ha", "hb"), S.sim_ratio("ta", "tb")).collect()
    assert [tuple(r) for r in got] == [(1 / 3, 1.0, 1.0, 0.5), (1.0, 1.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0)]


SEG = "array<struct<a:struct<lon:double,lat:double>,b:struct<lon:double,lat:double>,len:double>>"


def test_shape_overlap(spark):
    s1 = [((0.0, 0.0), (1.0, 0.0), 1.0), ((1.0, 0.0), (2.0, 0.0), 1.0)]
    s2 = [((1.0, 0.0), (2.0, 0.0), 1.0), ((2.0, 0.0), (2.0, 3.0), 3.0)]
    df = spark.createDataFrame([(s1, s2), (s1, None), (s1, s1)], f"x {SEG}, y {SEG}")
    got = [r[0] for r in df.select(S.sim_shape("x", "y")).collect()]
    assert got == [1.0 / 5.0, 0.0, 1.0]   # shared 1 / (2 + 4 - 1)


@settings(max_examples=15, deadline=None)
@given(st_.lists(st_.sampled_from("abcdef"), max_size=5), st_.lists(st_.sampled_from("abcdef"), max_size=5),
       st_.integers(0, 50), st_.integers(0, 50))
def test_similarity_bounded_and_symmetric(spark, a, b, ta, tb):
    df = spark.createDataFrame([(sorted(set(a)), sorted(set(b)), ta, tb)], "a array<string>, b array<string>, ta int, tb int")
    r = df.select(S.sim_stop_set("a", "b"), S.sim_stop_set("b", "a"), S.sim_ratio("ta", "tb"),
                  S.sim_ratio("tb", "ta")).collect()[0]
    assert 0.0 <= r[0] <= 1.0 and r[0] == r[1]
    assert 0.0 <= r[2] <= 1.0 and r[2] == r[3]


def test_matches_cover_both_sides(spark):
    vt = spark.createDataFrame([
        ("a", "R", 0, "weekday", "A1", ["s1", "s2"], None, "s1", "s2", "H", 5, 100.0, 2),
        ("a", "R", 0, "weekday", "A2", ["s3"], None, "s3", "s3", "H", 1, None, 1),
        ("b", "R", 0, "weekday", "B1", ["s1", "s2"], None, "s1", "s2", "H", 5, 100.0, 2),
        ("b", "Q", 0, "weekday", "B9", ["s1"], None, "s1", "s1", "H", 1, 1.0, 1)],
        f"bundle string, route_id string, direction_id int, daytype string, shape_id string, stop_ids array<string>, "
        f"segments {SEG}, start_stop string, end_stop string, headsign string, trip_count long, length_ft double, "
        f"stop_count long")
    m = rows(matching.variant_matches(vt, "a", "b"), "shape_id_a", "shape_id_b", "status")
    assert m == [("A1", "B1", "matched"), ("A2", "B1", "matched"), (None, "B9", "added")]
    p = matching.variant_pairs(vt, "a", "b", version=1).where("shape_id_a = 'A1'").collect()[0]
    assert abs(p.score - 1.0) < 1e-12   # identical variants score 1 (v1)


def test_duplicate_stop_rows_do_not_inflate_pattern(spark):
    trips, st, stops, cal = _fixture(spark)
    dup = stops.unionByName(stops.where("stop_id = 's1'").withColumn("stop_name", F.lit("ZZZ")))
    a = {r.shape_id: r for r in variants.variant_metrics(trips, st, dup, cal).collect()}["A"]
    assert (a.stop_count, a.start_stop) == (5, "S1")


def test_variant_table_parameters(spark):
    trips, st, stops, cal = _fixture(spark)
    svc = spark.createDataFrame([("b", dt.date(2024, 1, 10), "Weekday", "WK"), ("b", dt.date(2024, 1, 13), "Saturday", "SA")],
                                "bundle string, service_date date, daytype string, service_id string")
    base = {r.shape_id: r.inferred_variant_type for r in
            variants.variant_table(trips, st, stops, cal, None, services=svc).collect()}
    assert base["S"] == "school"
    no_school = {r.shape_id: r.inferred_variant_type for r in variants.variant_table(
        trips, st, stops, cal, None, services=svc, school_windows=[(0, 1)], words=()).collect()}
    assert no_school["S"] != "school"
    stops_first = variants.variant_table(trips, st, stops, cal, None, services=svc,
                                         main_weights={"trips": 0.0, "length": 0.0, "stops": 1.0})
    assert {r.main_shape_id for r in stops_first.where("daytype = 'weekday'").collect()} == {"A"}
