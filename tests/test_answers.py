"""Cases the star tables don't hold: feeds of different headers, null keys, repeated stops, integer ids."""

import datetime

from pyspark.sql import functions as F

from conftest import SMALL
from pickwise.operators import routes, schedule, service, variants
from pickwise.sources.gtfs_text import read_gtfs_table


def test_feeds_with_different_headers(spark, tmp_path):
    feeds = {
        "a": "stop_id,stop_name,stop_lat,stop_lon\nS1,One,40.5,-74.0\n",
        "b x": "stop_lon,stop_name,stop_id,stop_lat\n-73.5,Two,S2,41.5\n",
        "c": "stop_name,stop_id\nThree,S3\n",
    }
    for name, text in feeds.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "stops.txt").write_text(text)
    got = {r.bundle: (r.stop_id, r.stop_name, r.stop_lat, r.stop_lon) for r in read_gtfs_table(spark, str(tmp_path), "stops").collect()}
    assert got == {"a": ("S1", "One", 40.5, -74.0), "b x": ("S2", "Two", 41.5, -73.5), "c": ("S3", "Three", None, None)}


def test_null_keys_pair(spark):
    day = datetime.date(2024, 1, 3)
    rows = [(b, "Weekday", day, "R", None, 7, 3, 10.0, False) for b in ("a", "b")]
    sched = spark.createDataFrame(rows, "bundle string, daytype string, service_date date, route_id string, direction_id int, hour int, frequency long, avg_running_time double, flag boolean")
    got = schedule.compare_schedules(sched, "a", "b").collect()
    assert len(got) == 1 and got[0].frequency_b1 == got[0].frequency_b2 == 3
    summary = spark.createDataFrame([(b, "Weekday", None, 5) for b in ("a", "b")], "bundle string, daytype string, route_id string, trips int")
    got = routes.compare_route_summaries(summary, "a", "b").collect()
    assert len(got) == 1 and got[0].trips_b1 == got[0].trips_b2 == 5


def test_repeated_stop_keeps_one_listed_point(spark):
    stats = spark.createDataFrame([("p", "s", "t")], "bundle string, shape_id string, first_trip string")
    times = spark.createDataFrame([("p", "t", 1, "x"), ("p", "t", 2, "y")], "bundle string, trip_id string, stop_sequence int, stop_id string")
    one = spark.createDataFrame([("p", "x", "X", 40.6, -73.9), ("p", "y", "Y", 40.8, -73.8)], "bundle string, stop_id string, stop_name string, stop_lat double, stop_lon double")
    again = one.unionByName(spark.createDataFrame([("p", "x", "X", 40.7, -74.0), ("p", "x", "X", None, -75.0)], one.schema))
    want = variants.variant_stop_pattern(stats, times, one).first()
    assert variants.variant_stop_pattern(stats, times, again).first() == want


def test_signature_orders_ids_by_their_type(spark):
    daily = spark.createDataFrame([("p", datetime.date(2024, 1, 3), "Weekday", i) for i in (10, 2)], "bundle string, service_date date, daytype string, service_id int")
    assert service.daily_signature(daily).first().schedule == "2,10"


def test_fixture_meets_every_ridership_rule(spark):
    from pickwise.functions.rules import first_match
    from pickwise.operators.ridership import OVERRIDE_RULES, RENAME_RULES
    from pickwise.sources.star_fixture import star_to_gtfs

    rows = star_to_gtfs(spark, SMALL).ridership.where("gtfsid IS NULL OR gtfsid <> '0'")
    for rules, some in ((OVERRIDE_RULES, rows), (RENAME_RULES, rows.where("gtfsid IS NULL"))):
        at = {id(r): n for n, r in enumerate(rules)}
        met = some.select(first_match(rules, lambda r: F.lit(at[id(r)])).alias("n")).where("n IS NOT NULL").distinct()
        assert {r["n"] for r in met.collect()} == set(range(len(rules)))
