"""Hourly schedule, route summary and stop lists: hand fixtures for Q5-Q17, Q32, Q35."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from pickwise.functions.clock import clock_minutes, period_label
from pickwise.operators import routes, schedule, stops

D = dt.date(2024, 1, 10)
TRIPS = "bundle string, route_id string, trip_id string, service_id string, trip_headsign string, " \
        "direction_id int, block_id string, shape_id string"
ST = "bundle string, trip_id string, stop_id string, arrival_time string, departure_time string, " \
     "stop_sequence int"


def _svc(spark):
    return spark.createDataFrame([("b", D, "Weekday", "S")], "bundle string, service_date date, daytype string, service_id string")


def _trips(spark, rws):
    return spark.createDataFrame([("b", r, t, "S", "H", d, None, sh) for r, t, d, sh in rws], TRIPS)


def _st(spark, rws):
    return spark.createDataFrame([("b", *r) for r in rws], ST)


def test_clock_parsing_and_periods(spark):
    df = spark.createDataFrame([("07:05:59",), ("25:10:00",), ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(clock_minutes("t")).collect()]
    assert got == [425, 1510, None, None]  # seconds ignored (Q7), hours past 24 kept
    m = spark.createDataFrame([(0,), (239,), (240,), (539,), (899,), (1139,), (1259,), (1260,), (-5,)], "m int")
    assert [r[0] for r in m.select(period_label("m")).collect()] == [
        "Overnight", "Overnight", "Early Morning", "AM", "Midday", "PM", "Evening", "Late Evening", "Late Evening"]


def test_schedule_grid_midnight_and_nulls(spark):
    trips = _trips(spark, [("R1", "T1", 0, "A"), ("R1", "T2", 0, "A"), ("R1", "T3", 0, "A"), ("R1", "T4", 0, "A"),
                           ("R1", "T5", 0, "A")])
    st = _st(spark, [
        ("T1", "s1", "06:00:00", "06:00:00", 1), ("T1", "s2", "06:30:00", "06:30:00", 2),
        ("T2", "s1", "06:10:00", "06:10:00", 1), ("T2", "s2", "06:20:00", "06:20:00", 2),
        ("T2", "s3", "06:50:00", "06:50:00", 3),
        ("T3", "s1", "23:50:00", "23:50:00", 1), ("T3", "s2", "24:10:00", "24:10:00", 2),  # ends >= 24:00: dropped (Q6)
        ("T4", "s1", None, "07:00:00", 1), ("T4", "s2", "07:30:00", "07:30:00", 2),         # null origin arrival (Q35)
        ("T5", "s1", "24:30:00", "24:30:00", 1)])                                          # starts after midnight
    out = schedule.schedule(trips, st, None, None, services=_svc(spark))
    got = {r.hour: (r.frequency, r.avg_running_time, r.flag) for r in out.collect()}
    assert len(got) == 24 and out.count() == 24
    assert got[6] == (2, 35.0, False)
    assert got[7] == (None, None, None)      # empty hour is null, not 0 (Q8)
    assert got[23] == (None, None, None)


def test_runtime_flag_mean_vs_median(spark):
    trips = _trips(spark, [("R", f"T{i}", 1, "A") for i in range(3)])
    st = _st(spark, [(f"T{i}", "a", "08:00:00", "08:00:00", 1) for i in range(3)]
             + [("T0", "b", "08:10:00", "", 2), ("T1", "b", "08:10:00", "", 2), ("T2", "b", "09:00:00", "", 2)])
    h = schedule.hourly_service(schedule.trip_runtimes(
        trips.join(_svc(spark), ["bundle", "service_id"]), schedule.trip_endpoints(st)))
    r = h.collect()[0]
    assert (r.frequency, r.avg_running_time, r.flag) == (3, 10.0, True)  # mean 26.7 vs median 10


def test_compare_schedules_daytype_vs_literal_day(spark):
    s = spark.createDataFrame([
        ("a", "Weekday", dt.date(2024, 1, 10), "R", 0, 6, 1, 5.0, False),   # Wednesday
        ("b", "Weekday", dt.date(2024, 1, 9), "R", 0, 6, 2, 6.0, False)],   # Tuesday
        "bundle string, daytype string, service_date date, route_id string, direction_id int, hour int, "
        "frequency long, avg_running_time double, flag boolean")
    assert schedule.compare_schedules(s, "a", "b").count() == 1            # pairs on daytype (Q5 fixed)
    assert schedule.compare_schedules(s, "a", "b", literal=True).count() == 2


def test_route_summary_first_nonnull_rounding_and_names(spark):
    trips = _trips(spark, [("R1", "T1", 0, "A"), ("R1", "T2", 0, "B"), ("R1", "T3", 1, None), ("R9", "T4", 0, "C")])
    st = _st(spark, [("T1", "x", None, "", 1), ("T1", "y", "05:00:00", "", 2),   # first non-null (Q10)
                     ("T2", "x", "04:30:00", "", 1), ("T3", "x", "13:00:00", "", 1),
                     ("T4", "x", "25:00:00", "", 1)])                              # >= 24:00 -> dropped
    rts = spark.createDataFrame([("b", "R1", "A1", "1", "Route One")],
                                "bundle string, route_id string, agency_id string, route_short_name string, route_long_name string")
    out = routes.route_summary(trips, st, rts, None, None, services=_svc(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.route_id, r.route_long_name, r.early_morning, r.midday, r.overnight) == ("R1", "Route One", 1.0, 0.2, None)
    assert (r.total_trips, r.total_variants) == (3, 2)   # variants: distinct non-null shapes per direction, summed


def test_half_even_frequency(spark):
    counts = spark.createDataFrame([(1, 3, 1)], "overnight long, pm long, am long")
    per = [("Overnight", 0, 240, 4), ("PM", 900, 1140, 4), ("AM", 360, 540, 3)]
    r = routes.route_frequencies(counts, per).collect()[0]
    assert (r.overnight, r.pm, r.am) == (0.2, 0.8, 0.3)  # 0.25 -> 0.2, 0.75 -> 0.8 (Q12)


def test_route_without_name_is_kept(spark):
    trips = _trips(spark, [("RX", "T1", 0, "A")])
    st = _st(spark, [("T1", "x", "08:00:00", "", 1)])
    rts = spark.createDataFrame([], "bundle string, route_id string, agency_id string, route_short_name string, route_long_name string")
    out = routes.route_summary(trips, st, rts, None, None, services=_svc(spark)).collect()
    assert [(r.route_id, r.route_long_name, r.am) for r in out] == [("RX", None, 0.3)]   # Q11


def test_stop_list_and_null_safe_compare(spark):
    trips = _trips(spark, [("R1", "T1", 0, "A")])
    st = _st(spark, [("T1", "s1", "", "", 1), ("T1", "s2", "", "", 2), ("T1", "s9", "", "", 3),  # s9 not in stops
                     ("TX", "s1", "", "", 1)])                                                   # orphan trip
    stp = spark.createDataFrame([("b", "s1", "Main St"), ("b", "s1", "Alpha"), ("b", "s2", "Second")],
                                "bundle string, stop_id string, stop_name string")
    sl = stops.stop_list(trips, st, stp)
    assert rows(sl, "route_id", "direction_id", "stop_id", "stop_name") == [
        ("R1", 0, "s1", "Alpha"), ("R1", 0, "s2", "Second"), (None, None, "s1", "Alpha")]
    other = sl.where(F.col("stop_id") != "s2").withColumn("bundle", F.lit("c"))
    cmp = stops.compare_stop_lists(sl.unionByName(other), "b", "c")
    assert rows(cmp, "route_id", "stop_id", "change") == [
        ("R1", "s1", "kept"), ("R1", "s2", "removed"), (None, "s1", "kept")]   # null keys pair (Q15)
