"""Counts of what joins of a feed lose or multiply (Q31, Q32).

Trips whose route is not listed drop out of the loader's join, routes of two
agencies double their trips, stop times without a trip are never read, and a
stop sequence listed twice doubles the ends of a trip. ``watched_trips`` and
``watched_stop_times`` count these in the pass that does the work: the counts
are metrics of an ``Observation`` and are there once an action has run.
``quality_counts`` is the same as a table, for any number of bundles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

CHECKS = {
    "trips_without_route": "trips that the join with their route's agency drops",
    "trips_doubled_by_agency": "rows that routes of several agencies add to the trips",
    "trips_without_stop_times": "trips that no stop time names",
    "stop_times_without_trip": "stop times whose trip is not listed",
    "stop_times_without_stop": "stop times whose stop is not listed",
    "doubled_sequences": "stop times beyond the first of a trip's stop sequence",
}


def _count(test) -> Column:
    """How often ``test`` holds (0 without rows)."""
    return F.count(F.when(test, F.lit(1)))


def _agencies(routes: DataFrame) -> DataFrame:
    """Per listed route its distinct agencies; null counts as one."""
    return routes.groupBy("bundle", "route_id").agg(F.collect_set(F.struct("agency_id")).alias("_agencies"))


def watched_trips(trips: DataFrame, routes: DataFrame, seen: Observation) -> DataFrame:
    """``tables.bundle_trips`` (C01) that also counts, in its own pass, the
    ``trips`` read, ``trips_without_route`` and ``trips_doubled_by_agency``.

    A null bundle or route is a route that is not listed; an empty table counts
    zeros. Each route's agencies are one array of its distinct agencies, so the
    trips meet one row a route and are multiplied after they were counted.
    """
    met = trips.join(_agencies(routes), ["bundle", "route_id"], "left")
    n = F.coalesce(F.size("_agencies"), F.lit(0))
    lost = F.col("_agencies").isNull()
    met = met.observe(seen, F.count(F.lit(1)).alias("trips"), _count(lost).alias("trips_without_route"),
                      F.coalesce(F.sum(F.when(~lost, n - 1)), F.lit(0)).alias("trips_doubled_by_agency"))
    return met.withColumn("_agency", F.explode("_agencies")).select("bundle", "route_id", *[c for c in trips.columns if c not in ("bundle", "route_id")], F.col("_agency.agency_id"))


def watched_stop_times(stop_times: DataFrame, trips: DataFrame, seen: Observation) -> DataFrame:
    """Stop times of listed trips; counts in its own pass the ``stop_times``
    read and the ``stop_times_without_trip``. A trip listed twice keeps its stop
    times once."""
    listed = trips.select("bundle", "trip_id").distinct().withColumn("_listed", F.lit(True))
    met = stop_times.join(listed, ["bundle", "trip_id"], "left")
    met = met.observe(seen, F.count(F.lit(1)).alias("stop_times"), _count(F.col("_listed").isNull()).alias("stop_times_without_trip"))
    return met.where("_listed").select(*stop_times.columns)


def quality_counts(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """(bundle, check_name, n_rows): one row per bundle that has trips or stop
    times and check of ``CHECKS``; zero where all is well.

    stop_times is folded to one row per (trip, stop sequence, stop) and then
    per trip by partial aggregates before it meets other tables.
    """
    route = _agencies(routes).select("bundle", "route_id", F.size("_agencies").alias("n_agencies"))
    listed = trips.groupBy("bundle", "trip_id").agg(F.lit(True).alias("listed"))
    known = stops.groupBy("bundle", "stop_id").agg(F.lit(True).alias("known"))
    places = stop_times.groupBy("bundle", "trip_id", "stop_sequence").agg(F.count(F.lit(1)).alias("n"))
    timed = places.groupBy("bundle", "trip_id").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("stop_sequence").isNotNull(), F.col("n") - 1)).alias("doubled"))
    named = stop_times.groupBy("bundle", "stop_id").agg(F.count(F.lit(1)).alias("n"))

    def rows(df: DataFrame, **counts) -> DataFrame:
        found = df.groupBy("bundle").agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in counts.items()])
        return found.select("bundle", F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("n_rows")) for k in counts])).alias("x")).select("bundle", "x.*")

    parts = [
        rows(trips.join(route, ["bundle", "route_id"], "left"),
             trips_without_route=_count(F.col("n_agencies").isNull()), trips_doubled_by_agency=F.sum(F.col("n_agencies") - 1)),
        rows(trips.join(timed.select("bundle", "trip_id", "n"), ["bundle", "trip_id"], "left"), trips_without_stop_times=_count(F.col("n").isNull())),
        rows(timed.join(listed, ["bundle", "trip_id"], "left"), stop_times_without_trip=F.sum(F.when(F.col("listed").isNull(), F.col("n"))),
             doubled_sequences=F.sum("doubled")),
        rows(named.join(known, ["bundle", "stop_id"], "left"), stop_times_without_stop=F.sum(F.when(F.col("known").isNull(), F.col("n")))),
    ]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # a bundle without trips has no row of the trip checks: it gets zeros
    zeros = found.select("bundle").distinct().select("bundle", F.explode(F.array(*[F.lit(c) for c in CHECKS])).alias("check_name"), F.lit(0).cast("long").alias("n_rows"))
    return found.unionByName(zeros).groupBy("bundle", "check_name").agg(F.sum("n_rows").alias("n_rows"))
