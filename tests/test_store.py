"""The bundle store: writes of several bundles, repeated, broken and old ones."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pickwise.sources import store
from pickwise.sources import tables as T
from pickwise.sources.tables import GtfsTables


def tables(spark, bundle, n, **more):
    trips = spark.range(n).select(F.lit(bundle).alias("bundle"), F.concat(F.lit("T"), "id").alias("trip_id"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("shape_id"))
    routes = spark.createDataFrame([(bundle, "R1", None)], "bundle string, route_id string, agency_id string")
    return GtfsTables(trips=trips, routes=routes, **more)


def snapshot(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/*/bundle=*/**/*.parquet", recursive=True)}


def sizes(spark, root, *args):
    return {r.bundle: r["count"] for r in store.load_bundles(spark, root, *args).trips.groupBy("bundle").count().collect()}


def test_plain_layout_keeps_other_bundles(spark, tmp_path):
    root = f"{tmp_path}/plain"
    T.write_tables(tables(spark, "june", 5), root)
    before = snapshot(root)
    T.write_tables(tables(spark, "july", 7), root)
    T.write_tables(tables(spark, "july", 4), root)
    assert {r.bundle: r["count"] for r in T.load_tables(spark, root).trips.groupBy("bundle").count().collect()} == {"june": 5, "july": 4}
    assert before.items() <= snapshot(root).items()


def test_bundles_written_one_after_the_other(spark, tmp_path):
    root = f"{tmp_path}/s"
    assert store.manifests(spark, root) == [] and list(store.load_bundles(spark, root).items()) == []
    store.write_bundle(tables(spark, "2025", 5), root, "2025")
    before = snapshot(root)
    store.write_bundle(tables(spark, "07", 7), root, "07")
    store.write_bundle(tables(spark, "07", 4), root, "07")
    assert sizes(spark, root) == {"2025": 5, "07": 4} and sizes(spark, root, ["07"]) == {"07": 4} and sizes(spark, root, ["other"] + ["2025"]) == {"2025": 5}
    assert before.items() <= snapshot(root).items()
    assert [(m["bundle"], m["number"]) for m in store.manifests(spark, root)] == [("07", 2), ("2025", 1)]
    assert all(r.intact for r in store.verify(spark, root).collect())


def test_a_broken_write_leaves_the_old_state(spark, tmp_path):
    root = f"{tmp_path}/s"
    store.write_bundle(tables(spark, "a", 5), root, "a")
    before = snapshot(root)
    bad = tables(spark, "a", 9)
    bad = GtfsTables(trips=bad.trips, routes=bad.routes.withColumn("route_id", F.raise_error(F.lit("broken feed")).cast("string")))
    with pytest.raises(Exception, match="broken feed"):
        store.write_bundle(bad, root, "a")
    assert sizes(spark, root) == {"a": 5} and before.items() <= snapshot(root).items()
    gone = store.vacuum(spark, root)
    assert gone and sizes(spark, root) == {"a": 5} and snapshot(root) == before


def test_vacuum_drops_replaced_versions_alone(spark, tmp_path):
    root = f"{tmp_path}/s"
    for n in (3, 4, 5):
        store.write_bundle(tables(spark, "odd name=1", n), root, "odd name=1")
    store.write_bundle(tables(spark, "b", 2), root, "b")
    assert len(store.vacuum(spark, root)) == 4 and store.vacuum(spark, root) == []
    assert sizes(spark, root) == {"odd name=1": 5, "b": 2}


def test_damage_shows(spark, tmp_path):
    root = f"{tmp_path}/s"
    m = store.write_bundle(tables(spark, "a", 5), root, "a")
    spark.range(5).select(F.lit("Z").alias("trip_id"), F.lit("x").alias("shape_id")).write.mode("overwrite").parquet(f"{root}/trips/bundle=a/version={m['version']}")
    assert {r.table_name: (r.n_rows, r.intact) for r in store.verify(spark, root).collect()} == {"trips": (5, False), "routes": (1, True)}


def test_tables_may_differ_between_bundles(spark, tmp_path):
    root = f"{tmp_path}/s"
    store.write_bundle(tables(spark, "a", 3), root, "a")
    extra = GtfsTables(trips=tables(spark, "b", 2).trips.withColumn("block_id", F.lit("B")), stops=spark.createDataFrame([], "bundle string, stop_id string"))
    store.write_bundle(extra, root, "b")
    t = store.load_bundles(spark, root)
    assert {(r.bundle, r.block_id) for r in t.trips.collect()} == {("a", None), ("b", "B")}
    assert t.stops.count() == 0 and t.stops.columns == ["stop_id", "bundle"] and t.calendar is None
    store.write_bundle(GtfsTables(trips=tables(spark, "c", 2).trips.withColumn("shape_id", F.lit(1))), root, "c")
    with pytest.raises(ValueError, match="shape_id"):
        store.load_bundles(spark, root)


def test_only_the_versions_that_count_are_read(spark, tmp_path):
    root = f"{tmp_path}/s"
    for n in (3, 4):
        store.write_bundle(tables(spark, "a", n), root, "a")
        store.write_bundle(tables(spark, "b", n), root, "b")
    trips = store.load_bundles(spark, root, ["a"]).trips
    assert "PartitionFilters: [" in trips._jdf.queryExecution().executedPlan().toString()
    read = {r.f for r in trips.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and all("bundle=a" in f and store.manifests(spark, root, ["a"])[0]["version"] in f for f in read)
