"""Tables made of the star tables: stop times counted by order, tables stored when asked for."""

import datetime
import os

import pytest
from conftest import rows
from pickwise.plans import catalog
from pickwise.sources.star_fixture import star_to_gtfs
from pickwise.sources.tables import GtfsTables, load_tables, write_tables

DAY = datetime.datetime(2000, 2, 4)


@pytest.fixture
def stars(spark, tmp_path):
    """Orders with three, two (listed twice), one and no lines; lines of no order; a part listed twice."""
    def put(name, values, schema):
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("nation", [(0, "N0"), (1, "N1"), (None, "N9")], "n_nationkey int, n_name string")
    put("customer", [(1, 0), (2, 1), (3, None)], "c_custkey long, c_nationkey int")
    put("orders", [(10, 1, DAY, "1-URGENT"), (11, 2, DAY, "5-LOW"), (11, 2, DAY, "5-LOW"), (12, 1, None, None), (13, 2, DAY, "2-HIGH"), (14, 3, DAY, "2-HIGH"), (None, 1, DAY, "2-HIGH")],
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string")
    line = lambda order, n, price=1.0: (order, n, 5, 6, 7.0, price, 0.1, 0.2, DAY)
    put("lineitem", [line(10, 1), line(10, 1), line(10, None), line(11, 2, None), line(11, 1), line(12, 4), line(None, 1), line(14, 1), line(99, 1)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp")
    put("part", [(k, f"p{k}") for k in range(40)] + [(3, "p3")], "p_partkey long, p_name string")
    return str(tmp_path)


def test_a_visit_for_each_line_of_an_order(spark, stars):
    made = star_to_gtfs(spark, stars)
    plan = made.stop_times._jdf.queryExecution().executedPlan().toString()
    assert "count(1)" in plan and "Window" not in plan and "l_quantity" not in plan  # lines are counted, not sorted
    assert rows(made.stop_times, "trip_id", "stop_sequence") == sorted([("T10", 1), ("T10", 2), ("T10", 3), *[("T11", 1), ("T11", 2)] * 2, ("T12", 1)])
    assert made.ridership.count() >= 8  # of the lines' own values


def test_a_query_stores_the_tables_it_reads_alone(spark, stars):
    got = catalog.q_bundle_trips(spark, stars)
    assert {r.trip_id for r in got.collect()} == {"T10", "T11", "T12", "T13", None}
    t = catalog._t(spark, stars)
    assert sorted(os.listdir(t._root)) == ["routes", "trips"]
    assert t.shapes is None and t.stop_times.count() == 8
    assert "ridership" not in os.listdir(t._root)
    assert sorted(n for n, _ in t.items()) == sorted(n for n, _ in star_to_gtfs(spark, stars).items()) and "ridership" in os.listdir(t._root)
    assert t.for_bundles(["pick_b"]).stop_times.count() == 4
    with pytest.raises(AttributeError):
        t.fares


def test_rows_are_not_sorted_by_bundle_and_many_bundles_come_back(spark, tmp_path):
    at = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(at)
    df = spark.range(3000).selectExpr("concat('b', id % 30) as bundle", "concat('t', id) as trip_id")
    write_tables(GtfsTables(trips=df), str(tmp_path))
    assert spark.conf.get(at) == was
    assert rows(load_tables(spark, str(tmp_path)).trips, "bundle", "trip_id") == rows(df)
    write_tables(GtfsTables(), str(tmp_path))
