"""Calendar resolution and representative days: hand fixtures for Q1-Q5."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from pickwise.operators import service

CAL_COLS = "bundle string, service_id string, monday int, tuesday int, wednesday int, thursday int, " \
           "friday int, saturday int, sunday int, start_date int, end_date int"


def _cal(spark, rws):
    return spark.createDataFrame(rws, CAL_COLS)


def test_q1_day_clamp_fixed_and_literal(spark):
    cal = _cal(spark, [("b", "S", 1, 1, 1, 1, 1, 0, 0, 19960131, 19960231),
                       ("b", "T", 1, 1, 1, 1, 1, 0, 0, 20000430, 20000331),
                       ("b", "U", 1, 1, 1, 1, 1, 0, 0, 20010131, 20010229)])
    fixed = rows(service.calendar_dates_fixed(cal), "service_id", "start_date", "end_date")
    assert fixed == [("S", dt.date(1996, 1, 31), dt.date(1996, 2, 29)),
                     ("T", dt.date(2000, 4, 30), dt.date(2000, 3, 31)),
                     ("U", dt.date(2001, 1, 31), dt.date(2001, 2, 28))]
    lit = rows(service.calendar_dates_fixed(cal, literal=True), "service_id", "start_date", "end_date")
    # Feb first (-> 28 even in a leap year), then every day > 29 of a year divisible by 4 -> 29.
    assert lit == [("S", dt.date(1996, 1, 29), dt.date(1996, 2, 28)),
                   ("T", dt.date(2000, 4, 29), dt.date(2000, 3, 29)),
                   ("U", dt.date(2001, 1, 31), dt.date(2001, 2, 28))]


def _days(spark, dates):
    return spark.createDataFrame([("b", d) for d in dates], "bundle string, service_date date") \
        .withColumns({"pick_year": F.lit(2024), "pick_name": F.lit("x"), "sched_type": F.lit("s"),
                      "manual": F.lit(False)})


def test_q2_added_service_duplicates_signature_unless_dedupe(spark):
    # Monday 2024-01-08: S1 scheduled and also added -> "S1,S1" (two rows).
    cal = _cal(spark, [("b", "S1", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)])
    cd = spark.createDataFrame([("b", "S1", 20240108, 1)], "bundle string, service_id string, date int, exception_type int")
    bd = _days(spark, [dt.date(2024, 1, 8), dt.date(2024, 1, 9)])
    sig = dict((r.service_date, r.schedule) for r in service.daily_signature(
        service.daily_services(bd, cal, cd)).collect())
    assert sig[dt.date(2024, 1, 8)] == "S1,S1"
    assert sig[dt.date(2024, 1, 9)] == "S1"
    sig2 = dict((r.service_date, r.schedule) for r in service.daily_signature(
        service.daily_services(bd, cal, cd, dedupe=True)).collect())
    assert sig2[dt.date(2024, 1, 8)] == "S1"


def test_removed_and_q4_added_outside_bundle_dates(spark):
    cal = _cal(spark, [("b", "S1", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231),
                       ("b", "S3", 0, 0, 0, 0, 0, 1, 0, 20240101, 20241231)])
    cd = spark.createDataFrame([("b", "S1", 20240110, 2), ("b", "S3", 20240120, 1)],
                               "bundle string, service_id string, date int, exception_type int")
    bd = _days(spark, [dt.date(2024, 1, 10), dt.date(2024, 1, 13)])
    got = rows(service.daily_services(bd, cal, cd), "service_date", "service_id", "daytype")
    # Jan 10: S1 removed; Jan 13 (Sat): S3; Jan 20: added although not a bundle date.
    assert got == [(dt.date(2024, 1, 13), "S3", "Saturday"), (dt.date(2024, 1, 20), "S3", "Saturday")]
    only = rows(service.daily_services(bd, cal, cd, only_bundle_dates=True), "service_date", "service_id")
    assert only == [(dt.date(2024, 1, 13), "S3")]


def test_representative_day_most_frequent_then_earliest(spark):
    # Weekdays: Mon-Thu run S2 only (4 days) ... Friday also S1; most frequent signature wins.
    cal = _cal(spark, [("b", "S1", 0, 0, 0, 0, 1, 0, 0, 20240101, 20241231),
                       ("b", "S2", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)])
    cd = spark.createDataFrame([], "bundle string, service_id string, date int, exception_type int")
    bd = _days(spark, [dt.date(2024, 1, d) for d in range(1, 8)])
    got = rows(service.representative_days(bd, cal, cd), "daytype", "service_date")
    assert got == [("Weekday", dt.date(2024, 1, 1))]
    ranked = service.representative_days(bd, cal, cd, ranked=True)
    labels = {r.service_date: r.schedule_variation for r in ranked.collect()}
    assert labels[dt.date(2024, 1, 5)] == "Weekday-1"  # "S1,S2" sorts before "S2"
    assert labels[dt.date(2024, 1, 1)] == "Weekday-2"


def test_active_services_is_a_set_and_compares_raw_ints(spark):
    # Raw int ranges: 20240231 is not clamped here.
    cal = _cal(spark, [("b", "S1", 1, 1, 1, 1, 1, 0, 0, 20240101, 20240231)])
    cd = spark.createDataFrame([("b", "S1", 20240229, 1)], "bundle string, service_id string, date int, exception_type int")
    dates = spark.createDataFrame([("b", dt.date(2024, 2, 29), "Weekday")], "bundle string, service_date date, daytype string")
    assert rows(service.active_services(cal, cd, dates), "service_id") == [("S1",)]


def test_weekday_is_an_equi_join_key(spark):
    cal = _cal(spark, [("b", "S1", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)])
    cd = spark.createDataFrame([], "bundle string, service_id string, date int, exception_type int")
    bd = _days(spark, [dt.date(2024, 1, 1)])
    plan = service.daily_services(bd, cal, cd)._jdf.queryExecution().executedPlan().toString()
    assert "dow" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fixed_clamp_always_gives_a_valid_date(spark):
    import calendar as pycal
    import random

    rnd = random.Random(7)
    rws = [(rnd.randint(1990, 2030), rnd.randint(1, 12), rnd.randint(1, 31)) for _ in range(200)]
    ints = [("b", f"S{i}", 1, 1, 1, 1, 1, 0, 0, y * 10000 + m * 100 + d, y * 10000 + m * 100 + d)
            for i, (y, m, d) in enumerate(rws)]
    got = {r.service_id: r.start_date for r in service.calendar_dates_fixed(_cal(spark, ints)).collect()}
    for i, (y, m, d) in enumerate(rws):
        assert got[f"S{i}"] == dt.date(y, m, min(d, pycal.monthrange(y, m)[1]))
