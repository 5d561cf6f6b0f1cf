"""Ridership id repair (Q18, Q19, rule order), GTFS text reading, report and plan checks."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL, rows
from pickwise.operators import ridership as R
from pickwise.plans.report import report, write_report
from pickwise.sources.gtfs_text import read_gtfs_feeds

RID = ("gtfsid string, ridership_run_id string, run_year string, run_month string, weekend int, hour int, "
       "route_name string, route string, dir string, stop_name string, lookup string, milepost double, ons double, "
       "offs double, volume double, md_trips double, capacity double, vc double")


def _rid(spark, rws):
    full = [(g, "r", y, m, 0, 8, rn, r, d, s, "", mp, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0) for g, y, m, rn, r, d, s, mp in rws]
    return spark.createDataFrame(full, RID)


def test_override_rules_first_match_and_milepost(spark):
    df = _rid(spark, [
        ("X", "2024", "10", "Q_0_N..N63R_3999", "Q", "N", "86 St", 1.0822099447250366),
        ("X", "2024", "10", "Q_0_N..N63R_3999", "Q", "N", "86 St", 17.645967483520508),
        ("X", "2024", "10", "Q_0_N..N63R_3999", "Q", "N", "86 St", 5.0),
        ("X", "2024", "10", "other", "Q", "S", "86 St (2 Av)", 1.0),
        ("X", "2024", "10", "other", "R", "S", "86 St (2 Av)", 1.0),
        ("X", "2024", "10", "M..S96St", "M", "S", "86 St", 1.0),
        ("X", "2024", "10", "other", "FX", "N", "Queens Plaza", 1.0)])
    got = [r.gtfsid for r in R.ridership_overrides(df).orderBy("milepost", "route", "route_name").collect()]
    assert sorted(got) == sorted(["N10N", "Q04N", "X", "Q04S", "Q04S", "Q04S", "G21N"])


def test_rename_rules_route_conditions_and_null_route(spark):
    df = spark.createDataFrame([
        ("Franklin Av", "3", "N"), ("Franklin Av", "A", "N"), ("Newkirk Av", "B", "S"), ("Newkirk Av", "5", "S"),
        ("36 St (4 Av)", "R", "N"), ("36 St (4 Av)", "D", "N"), ("36 St (4 Av)", None, "N"), ("4 Av", "F", "N")],
        "stop_name string, route string, dir string")
    got = {(r.stop_name, r.route): r.fixed_stop_name for r in R.rename_stops(df).collect()}
    assert got[("Franklin Av", "3")] == "Franklin Av-Medgar Evers College"
    assert got[("Franklin Av", "A")] == "Franklin Av"
    assert got[("Newkirk Av", "B")] == "Newkirk Plaza"
    assert got[("Newkirk Av", "5")] == "Newkirk Av-Little Haiti"
    assert got[("36 St (4 Av)", "R")] == "36 St (4 Av)"
    assert got[("36 St (4 Av)", "D")] == "36 St"
    assert got[("36 St (4 Av)", None)] == "36 St (4 Av)"      # != on a null route is unknown
    assert got[("4 Av", "F")] == "4 Av-9 St"


def test_fill_ids_default_keeps_rows_literal_fans_out(spark):
    df = _rid(spark, [
        ("A1N", "2024", "10", "rn", "A", "N", "Main", 1.0),
        ("A2N", "2024", "10", "rn", "A", "N", "Main", 1.0),   # second id for the same key (Q19)
        (None, "2024", "3", "rn", "A", "N", "Main", 1.0),      # repaired by exact match
        (None, "2024", "3", "rn", "A", "N", "Broadway Jct", 1.0),
        ("BJN", "2024", "10", "rn", "A", "N", "Broadway Junction", 1.0),
        ("0", "2024", "3", "rn", "A", "N", "Main", 1.0),       # bad run
        (None, "2024", "3", "rn", "A", "S", "Nowhere", 1.0)])
    out = R.fill_ids(df)
    assert out.count() == 6                                      # only the bad run is dropped
    got = rows(out.where(F.col("gtfsid").isNull()), "stop_name", "final_gtfsid")
    assert got == [("Broadway Jct", "BJN"), ("Main", "A1N"), ("Nowhere", None)]
    lit = R.fill_ids(df, literal=True)
    # gtfsid <> '0' drops the null ids too (Q18), so nothing is left to repair
    assert lit.count() == 3 and lit.where(F.col("gtfsid").isNull()).count() == 0
    # the reference ids are not unique per key: literal ids multiply a match (Q19)
    pre = R.ridership_overrides(df)
    missing = R.missing_ids(pre)
    assert R.match_ids(missing, R.reference_ids(pre, literal=True)).where(F.col("stop_name") == "Main").count() == 2
    assert R.match_ids(missing, R.reference_ids(pre)).where(F.col("stop_name") == "Main").count() == 1


def test_extra_rename_rule_table(spark):
    df = spark.createDataFrame([("Foo (Local)", "R1", "N"), ("Foo (Local)", "R2", "N")], "stop_name string, route string, dir string")
    rules = spark.createDataFrame([(2, "Foo (Local)", None, None, "Foo"), (1, "Foo (Local)", ["R1"], None, "Foo One")],
                                  "priority int, stop_name string, routes_in array<string>, routes_not_in array<string>, new_name string")
    got = {r.route: r.fixed_stop_name for r in R.rename_stops(df, extra_rules=rules).collect()}
    assert got == {"R1": "Foo One", "R2": "Foo"}


def test_read_gtfs_text_binds_by_name(spark, tmp_path):
    b = tmp_path / "pick1"
    b.mkdir()
    (b / "stops.txt").write_text("stop_lon,stop_name,stop_id,stop_lat\n-74.0,Main St,s1,40.5\n-74.1,Bad,s2,north\n")
    (b / "calendar.txt").write_text(
        "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"
        "WK,1,1,1,1,1,0,0,20240101,20240331\n")
    t = read_gtfs_feeds(spark, str(tmp_path), names=["stops", "calendar"])
    s = rows(t.stops, "bundle", "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type")
    assert s == [("pick1", "s1", "Main St", 40.5, -74.0, None), ("pick1", "s2", "Bad", None, -74.1, None)]
    c = t.calendar.collect()[0]
    assert (c.bundle, c.start_date, c.monday) == ("pick1", 20240101, 1)


def test_report_parts(spark, tmp_path):
    from pickwise.plans.catalog import _t
    parts = report(_t(spark, SMALL), "pick_a", "pick_b")
    assert set(parts) == {"route_summary", "stop_list", "schedule"}
    con = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    sql = E.oracle_sql()["compare_stop_lists"]
    added = con.execute(f"SELECT count(*) FROM ({sql}) WHERE change = 'added'").fetchall()[0][0]
    assert parts["stop_list"].where(F.col("change") == "added").count() == added > 0
    write_report(parts, str(tmp_path / "out"), fmt="csv")
    assert (tmp_path / "out" / "schedule").exists()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_bundle_tables_projects_and_filters(spark):
    from pickwise.plans.catalog import _t
    from pickwise.sources.tables import COLUMNS, bundle_tables

    t = bundle_tables(_t(spark, SMALL), ["pick_b"])
    assert t.stop_times.select("bundle").distinct().collect()[0][0] == "pick_b"
    assert t.trips.columns == [c for c in COLUMNS["trips"] if c in t.trips.columns]
    assert "agency_id" in t.routes.columns and t.ridership is not None


def test_read_gtfs_text_bundle_with_space(spark, tmp_path):
    b = tmp_path / "June pick"
    b.mkdir()
    (b / "trips.txt").write_text("trip_id,route_id,service_id,direction_id\nT1,R1,WK,1\n")
    t = read_gtfs_feeds(spark, str(tmp_path), names=["trips"])
    r = t.trips.collect()[0]
    assert (r.bundle, r.trip_id, r.direction_id, r.shape_id) == ("June pick", "T1", 1, None)
