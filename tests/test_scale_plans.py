"""Plan properties the 100 TB design relies on (checked on stored, bundle-partitioned tables)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pickwise.operators import ridership, schedule, service, stops
from pickwise.plans.materialize import materialize
from pickwise.sources.star_fixture import star_to_gtfs
from pickwise.sources.tables import load_tables, write_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bundles"))
    write_tables(star_to_gtfs(spark, SMALL), root, files=4)
    return load_tables(spark, root)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bundle_filter_prunes_partitions_and_columns(spark, stored):
    t = stored.for_bundles(["pick_a"])
    plan = _plan(stops.stop_list(t.trips, t.stop_times, t.stops))
    assert "PartitionFilters: [isnotnull(bundle" in plan or "PartitionFilters: [bundle" in plan
    st_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "stop_times" in ln][0]
    assert "arrival_time" not in st_scan            # only the columns the operator reads


def test_stop_times_aggregated_before_its_only_shuffle(spark, stored):
    t = stored
    days = service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)
    svc = materialize(service.active_services(t.calendar, t.calendar_dates, days))
    plan = _plan(schedule.schedule(t.trips, t.stop_times, t.calendar, t.calendar_dates, services=svc))
    # every exchange above the stop_times scan follows a partial aggregate on (bundle, trip_id)
    assert "partial_min_by" in plan and "partial_max_by" in plan
    assert plan.count("hashpartitioning(bundle") >= 1
    assert "SortMergeJoin" not in plan or "stop_sequence" not in plan.split("SortMergeJoin")[0]


def test_fill_ids_never_shuffles_ridership(spark, stored):
    out = ridership.fill_ids(stored.ridership, "2000", ("9", "10", "11", "12"))
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan
    # the only exchange is the broadcast of the lookup: no hash repartitioning of ridership rows
    assert "hashpartitioning(stop_name" not in plan


def test_broadcast_is_decided_by_the_bytes_stored(spark):
    small = materialize(spark.range(1000).withColumn("k", F.col("id") % 7))
    big = materialize(spark.range(100000).withColumn("k", F.col("id") % 7))
    assert "BroadcastHashJoin" in _plan(big.join(small, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000b")
    try:
        assert "BroadcastHashJoin" not in _plan(big.join(small, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _sorts_before_first_exchange(plan: str, table: str) -> list[str]:
    """Sort and SortAggregate lines between the scans of ``table`` and the exchange above each."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and f"/{table}" in line:
            for above in reversed(lines[:i]):
                if "Exchange" in above:
                    break
                if "Sort" in above and "SortMergeJoin" not in above:
                    found.append(above)
    return found


def test_big_tables_are_not_sorted_before_their_first_exchange(spark, stored):
    t = stored
    pre = ridership.ridership_overrides(t.ridership)
    good = ridership.reference_ids(pre, "2000", ("9", "10", "11", "12"))
    assert _sorts_before_first_exchange(_plan(good), "ridership") == []
    assert _sorts_before_first_exchange(_plan(stops.stop_list(t.trips, t.stop_times, t.stops)), "stop_times") == []
    sched = schedule.schedule(t.trips, t.stop_times, t.calendar, t.calendar_dates,
                              services=materialize(service.active_services(
                                  t.calendar, t.calendar_dates,
                                  service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates))))
    assert _sorts_before_first_exchange(_plan(sched), "stop_times") == []


def test_registered_queries_scan_stored_tables(spark):
    from pickwise.plans.catalog import REGISTRY
    plan = _plan(REGISTRY["stop_list"][0](spark, SMALL))
    assert "ExistingRDD" not in plan and "FileScan parquet" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "/stop_times" in ln][0]
    assert "departure_time" not in scan


def test_no_localcheckpoint_anywhere():
    import pathlib
    src = "\n".join(p.read_text() for p in pathlib.Path(__file__).parents[1].joinpath("pickwise").rglob("*.py"))
    assert not re.search(r"localCheckpoint\(", src)


def test_bucketed_layout_removes_the_trip_shuffle(spark, tmp_path):
    from pickwise.operators.trips import trip_profile
    from pickwise.sources.tables import load_catalog_tables, save_bucketed_tables

    save_bucketed_tables(star_to_gtfs(spark, SMALL), str(tmp_path / "cat"), prefix="bkt", buckets=4)
    t = load_catalog_tables(spark, prefix="bkt")
    plan = _plan(trip_profile(t.stop_times))
    assert "Exchange" not in plan                      # aggregate on (bundle, trip_id) over trip_id buckets
    joined = _plan(t.trips.join(trip_profile(t.stop_times), ["bundle", "trip_id"]))
    assert "hashpartitioning" not in joined and "Exchange" not in joined.replace("BroadcastExchange", "")
    got = trip_profile(t.stop_times).count()
    assert got == t.stop_times.select("bundle", "trip_id").distinct().count()
