"""Properties from the test strategy, on the sf0.001 fixture."""

from pyspark.sql import functions as F

from conftest import SMALL
from pickwise.operators import matching, ridership, schedule, service, stops
from pickwise.plans.catalog import REGISTRY, _services, _t, _variant_table


def test_fill_ids_keeps_every_row(spark):
    t = _t(spark, SMALL)
    kept = t.ridership.where(F.col("gtfsid").isNull() | (F.col("gtfsid") != "0")).count()
    assert REGISTRY["fill_ids"][0](spark, SMALL).count() == kept


def test_grid_has_24_rows_per_key(spark):
    s = REGISTRY["schedule"][0](spark, SMALL)
    per_key = s.groupBy("bundle", "daytype", "service_date", "route_id", "direction_id").agg(
        F.count("*").alias("n"), F.countDistinct("hour").alias("h"))
    assert per_key.where((F.col("n") != 24) | (F.col("h") != 24)).count() == 0


def test_no_removed_service_unless_added(spark):
    t = _t(spark, SMALL)
    svc = _services(spark, SMALL).withColumn(
        "date", (F.year("service_date") * 10000 + F.month("service_date") * 100 + F.dayofmonth("service_date")).cast("int"))
    cd = t.calendar_dates
    removed = cd.where("exception_type = 2").select("bundle", "service_id", "date")
    added = cd.where("exception_type = 1").select("bundle", "service_id", "date")
    bad = svc.join(removed, ["bundle", "service_id", "date"]).join(added, ["bundle", "service_id", "date"], "left_anti")
    assert bad.count() == 0


def test_full_outer_key_set_is_union(spark):
    t = _t(spark, SMALL)
    sl = stops.stop_list(t.trips, t.stop_times, t.stops)
    cmp = stops.compare_stop_lists(sl, "pick_a", "pick_b")
    keys = ["route_id", "direction_id", "stop_id"]
    union = sl.select(*keys).distinct()
    assert cmp.count() == union.count()
    assert cmp.select(*keys).exceptAll(union).count() == 0


def test_variant_scores_itself_one(spark):
    vt = _variant_table(spark, SMALL)
    me = vt.where("bundle = 'pick_a'")
    twin = me.withColumn("bundle", F.lit("twin"))
    pairs = matching.variant_pairs(me.unionByName(twin), "pick_a", "twin", version=2).where("shape_id_a = shape_id_b")
    eligible = (F.col("score") < 1 - 1e-9)
    # every variant with a headsign, trips, a length, stops and a line scores 1 against itself
    meta = me.select(F.col("shape_id").alias("shape_id_a"), "route_id", F.col("headsign").alias("hs"),
                     F.col("length_ft").alias("lf"), F.col("segments").alias("sg"))
    full = pairs.join(meta, ["shape_id_a", "route_id"])
    full = full.where(F.col("hs").isNotNull() & F.col("lf").isNotNull() & (F.size("sg") > 0))
    assert full.count() > 0 and full.where(eligible).count() == 0
    assert pairs.where((F.col("score") < 0) | (F.col("score") > 1 + 1e-9)).count() == 0
