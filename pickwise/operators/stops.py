"""Stop lists per route and direction, and their difference between bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["route_id", "direction_id", "stop_id"]


def stop_list(trips: DataFrame, stop_times: DataFrame, stops: DataFrame,
              profile: DataFrame | None = None) -> DataFrame:
    """C20: distinct (bundle, route, direction, stop) with the stop's name.

    stop_times LEFT JOIN trips INNER JOIN stops: stop times of unknown trips
    stay with a null route and direction; stops missing from ``stops`` drop
    out. A stop listed under two names takes the smallest. Keys are made
    distinct by hash before they meet the names, so stop_times rows are
    neither sorted nor carry text other than ids. With ``profile``
    (``trip_profile(with_stops=True)``) each trip's distinct stop set is used
    instead of its stop_times rows.
    """
    if profile is not None:
        st = profile.select("bundle", "trip_id", F.explode("stop_ids").alias("stop_id"))
    else:
        st = stop_times.select("bundle", "trip_id", "stop_id")
    t = trips.select("bundle", "trip_id", "route_id", "direction_id")
    names = stops.groupBy("bundle", "stop_id").agg(F.min("stop_name").alias("stop_name"))
    listed = st.join(t, ["bundle", "trip_id"], "left").select("bundle", *KEY).distinct()
    return listed.join(names, ["bundle", "stop_id"]).select("bundle", *KEY, "stop_name")


def compare_stop_lists(stops_listed: DataFrame, bundle_a: str, bundle_b: str) -> DataFrame:
    """Full outer join of two stop lists on (route, direction, stop).

    Null route/direction keys match each other (null-safe). ``change`` is
    ``added`` (only in bundle_b), ``removed`` (only in bundle_a) or ``kept``.
    """
    def side(bundle, sfx):
        return stops_listed.where(F.col("bundle") == bundle).select(
            *[F.col(k).alias(f"{k}_{sfx}") for k in KEY], F.col("stop_name").alias(f"stop_name_{sfx}"))

    a, b = side(bundle_a, "b1"), side(bundle_b, "b2")
    cond = None
    for k in KEY:
        c = a[f"{k}_b1"].eqNullSafe(b[f"{k}_b2"])
        cond = c if cond is None else cond & c
    j = a.join(b, cond, "full")
    in_a, in_b = F.col("stop_id_b1").isNotNull(), F.col("stop_id_b2").isNotNull()
    return j.select(
        *[F.coalesce(f"{k}_b1", f"{k}_b2").alias(k) for k in KEY],
        "stop_id_b1", "stop_name_b1", "stop_id_b2", "stop_name_b2",
        F.when(in_a & in_b, F.lit("kept")).when(in_b, F.lit("added")).otherwise(F.lit("removed")).alias("change"))
