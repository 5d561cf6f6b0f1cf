"""Route variants (shapes): profile, main variant and inferred type.

Every metric is an aggregate keyed by (bundle, shape_id), so they are joined
on one key; the main variant is a window over (bundle, route, daytype,
direction); the type is one searched CASE. Stop patterns are read only for
each shape's first trip (smallest trip_id) and only first-stop rows are read
for the school test, so stop_times is filtered by small join sides instead of
being shuffled whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.clock import SCHOOL_WINDOWS, clock_seconds_of_day, in_windows
from pickwise.functions.dates import WEEKDAY_COLUMNS, WEEKEND_COLUMNS
from pickwise.functions.geo import project_xy
from pickwise.operators.service import active_services, filter_bundle
from pickwise.plans.materialize import materialize

# Main-variant score weights (trip count, length in thousands
# of feet, stop count), type thresholds and the headsign words that mark a
# limited-stop variant.
MAIN_WEIGHTS = {"trips": 0.6, "length": 0.3, "stops": 0.1}
LIMITED_STOP_SHARE = 0.4
SHORT_SHARE = 0.15
OTHER_MAX_TRIPS = 2
LIMITED_WORDS = ("limited", "ltd")

SHAPE_KEY = ["bundle", "shape_id"]
GROUP_KEY = ["bundle", "route_id", "daytype", "direction_id"]


def of_routes(df: DataFrame, route_filter=None) -> DataFrame:
    """Rows of the wanted routes: None (all), a list of route ids, or a regular expression."""
    if route_filter is None:
        return df
    if isinstance(route_filter, str):
        return df.where(F.col("route_id").rlike(route_filter))
    return df.where(F.col("route_id").isin(list(route_filter)))


def variants(trips: DataFrame, route_filter=None) -> DataFrame:
    """Distinct (bundle, route_id, shape_id) with a shape.

    ``route_filter``: None, a list of route ids, or a regular expression.
    """
    t = of_routes(trips.where(F.col("shape_id").isNotNull()), route_filter)
    return t.select("bundle", "route_id", "shape_id").distinct()


def reduce_to_routes(trips: DataFrame, stop_times: DataFrame, route_filter) -> tuple[DataFrame, DataFrame]:
    """The trips and stop times that profiling the wanted routes' shapes needs.

    Routes to shapes to trips to stop times, a semi-join each. A shape's
    numbers count its trips on any route, so trips of other routes on the
    wanted shapes stay. Both reduced keys are stored first (a job each): the
    planner then knows their bytes, broadcasts small ones and filters the
    stop_times scan by them before anything is aggregated or moved.
    """
    shapes = materialize(variants(trips, route_filter).select(*SHAPE_KEY).distinct())
    kept = materialize(trips.join(shapes, SHAPE_KEY, "left_semi"))
    return kept, stop_times.join(kept.select("bundle", "trip_id"), ["bundle", "trip_id"], "left_semi")


def first_stop_in_windows(stop_times: DataFrame, windows=SCHOOL_WINDOWS) -> DataFrame:
    """Per trip: are all its ``stop_sequence == 1`` departures inside the
    windows (seconds of day, hour modulo 24)? Only first-stop rows are read."""
    return (stop_times.where(F.col("stop_sequence") == 1)
            .select("bundle", "trip_id", in_windows(clock_seconds_of_day("departure_time"), windows).alias("ok"))
            .groupBy("bundle", "trip_id").agg(F.bool_and("ok").alias("ok")))


def variant_trip_stats(trips: DataFrame, calendar: DataFrame, first_stop_ok: DataFrame | None = None) -> DataFrame:
    """Per (bundle, shape), one aggregate over the trips.

    Trip count (over all routes using the shape), first trip (smallest id)
    with its headsign and direction, daytype, school flag and the routes
    listing the shape. Daytype is ``weekend`` when the shape's services run on
    Saturday or Sunday and never Monday-Friday, else ``weekday`` (also with no
    calendar row). School: every first departure in the school windows; no
    first-stop row at all counts as true.
    """
    flags = (calendar.groupBy("bundle", "service_id")
             .agg(F.max(F.greatest(*[F.col(c) for c in WEEKDAY_COLUMNS])).alias("wk"),
                  F.max(F.greatest(*[F.col(c) for c in WEEKEND_COLUMNS])).alias("we")))
    t = trips.where(F.col("shape_id").isNotNull()).join(flags, ["bundle", "service_id"], "left")
    if first_stop_ok is not None:
        t = t.join(first_stop_ok, ["bundle", "trip_id"], "left")
    else:
        t = t.withColumn("ok", F.lit(None).cast("boolean"))
    g = (t.groupBy(*SHAPE_KEY)
         .agg(F.count(F.lit(1)).alias("trip_count"),
              F.min("trip_id").alias("first_trip"),
              F.min_by("trip_headsign", "trip_id").alias("headsign"),
              F.min_by("direction_id", "trip_id").alias("direction_id"),
              F.max("wk").alias("wk"), F.max("we").alias("we"),
              F.coalesce(F.bool_and("ok"), F.lit(True)).alias("school"),
              F.collect_set("route_id").alias("route_ids")))
    weekend = (F.coalesce(F.col("wk"), F.lit(0)) == 0) & (F.coalesce(F.col("we"), F.lit(0)) == 1)
    return g.withColumn("daytype", F.when(weekend, F.lit("weekend")).otherwise(F.lit("weekday"))).drop("wk", "we")


def _polyline_length(pts, x: str, y: str):
    """Sum of consecutive point distances of an ordered array of structs."""
    n = F.size(pts)
    a = F.slice(pts, 1, F.greatest(n - 1, F.lit(0)))
    b = F.slice(pts, 2, F.greatest(n - 1, F.lit(0)))
    seg = F.zip_with(a, b, lambda p, q: F.sqrt(F.pow(q[x] - p[x], 2) + F.pow(q[y] - p[y], 2)))
    return F.aggregate(seg, F.lit(0.0), lambda acc, s: acc + s)


def _segments(pts):
    """Undirected stop-to-stop segments in degrees (endpoints ordered), distinct."""
    n = F.size(pts)
    a = F.slice(pts, 1, F.greatest(n - 1, F.lit(0)))
    b = F.slice(pts, 2, F.greatest(n - 1, F.lit(0)))

    def seg(p, q):
        p1 = F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))
        q1 = F.struct(q["lon"].alias("lon"), q["lat"].alias("lat"))
        lo, hi = F.least(p1, q1), F.greatest(p1, q1)
        return F.struct(lo.alias("a"), hi.alias("b"),
                        F.sqrt(F.pow(q["lon"] - p["lon"], 2) + F.pow(q["lat"] - p["lat"], 2)).alias("len"))

    return F.array_distinct(F.zip_with(a, b, seg))


def variant_stop_pattern(stats: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """C31, C33, C34 (X1-X3): the first trip's stops of each shape.

    ``stop_names``: ordered names (the id when unnamed); ``stop_count`` keeps
    repeats; ``stop_ids``: distinct ids (sorted); ``start_stop``/``end_stop``;
    ``length_ft``: polyline through the stops in US survey feet, null when a
    coordinate is missing or there are fewer than two stops; ``segments``:
    distinct undirected segments in degrees (for shape similarity). A stop id
    listed twice in ``stops`` counts once (smallest name and coordinates).
    """
    first = stats.select("bundle", F.col("shape_id"), F.col("first_trip").alias("trip_id"))
    st = stop_times.select("bundle", "trip_id", "stop_sequence", "stop_id")
    # both coordinates from one row
    point = F.when(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull(), F.struct("stop_lat", "stop_lon"))
    s = stops.groupBy("bundle", "stop_id").agg(F.min("stop_name").alias("stop_name"),
                                               F.min(point).alias("at"))
    s = s.select("bundle", "stop_id", "stop_name", "at.stop_lat", "at.stop_lon")
    rows = st.join(first, ["bundle", "trip_id"]).join(s, ["bundle", "stop_id"], "left")
    x, y = project_xy("stop_lon", "stop_lat")
    pt = F.struct(F.col("stop_sequence").alias("seq"), F.col("stop_id").alias("stop_id"),
                  F.coalesce("stop_name", "stop_id").alias("name"),
                  F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"),
                  x.alias("x"), y.alias("y"))
    g = (rows.groupBy(*SHAPE_KEY)
         .agg(F.array_sort(F.collect_list(pt)).alias("pts"),
              F.max(F.col("stop_lat").isNull() | F.col("stop_lon").isNull()).alias("missing_xy")))
    pts = F.col("pts")
    complete = ~F.col("missing_xy") & (F.size(pts) >= 2)
    return g.select(
        *SHAPE_KEY,
        F.transform(pts, lambda p: p["name"]).alias("stop_names"),
        F.size(pts).cast("long").alias("stop_count"),
        F.array_sort(F.array_distinct(F.transform(pts, lambda p: p["stop_id"]))).alias("stop_ids"),
        F.element_at(pts, 1)["name"].alias("start_stop"),
        F.element_at(pts, -1)["name"].alias("end_stop"),
        F.when(complete, _polyline_length(pts, "x", "y")).alias("length_ft"),
        F.when(complete, _segments(pts)).alias("segments"),
    )


def variant_school(trips: DataFrame, stop_times: DataFrame, windows=SCHOOL_WINDOWS) -> DataFrame:
    """C36 on its own: (bundle, shape_id, school)."""
    ok = first_stop_in_windows(stop_times, windows)
    t = trips.where(F.col("shape_id").isNotNull()).select("bundle", "trip_id", "shape_id")
    return (t.join(ok, ["bundle", "trip_id"], "left").groupBy(*SHAPE_KEY)
            .agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("school")))


def main_variant(vt: DataFrame, weights=MAIN_WEIGHTS) -> DataFrame:
    """Mark the main variant of each (bundle, route, daytype, direction):
    highest 0.6*trips + 0.3*length/1000 + 0.1*stops, smallest shape_id on a tie."""
    score = (F.lit(weights["trips"]) * F.col("trip_count")
             + F.lit(weights["length"]) * F.coalesce(F.col("length_ft"), F.lit(0.0)) / 1000
             + F.lit(weights["stops"]) * F.col("stop_count"))
    w = Window.partitionBy(*GROUP_KEY).orderBy(F.col("score").desc(), F.col("shape_id"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (vt.withColumn("score", score)
            .withColumns({"main_shape_id": F.first("shape_id").over(whole),
                          "main_stop_count": F.first("stop_count").over(whole),
                          "main_length_ft": F.first("length_ft").over(whole)}))


def variant_type(vt: DataFrame, limited_share: float = LIMITED_STOP_SHARE, short_share: float = SHORT_SHARE,
                 other_max_trips: int = OTHER_MAX_TRIPS, words=LIMITED_WORDS) -> DataFrame:
    """Ordered rules, first match wins: main; few trips -> other/unknown;
    many fewer stops or a limited word in the headsign -> limited; weekday and
    school hours -> school; fewer stops and shorter -> short; else branch."""
    stop_drop = (F.col("main_stop_count") - F.col("stop_count")) / F.nullif(F.col("main_stop_count"), F.lit(0))
    len_drop = (F.col("main_length_ft") - F.col("length_ft")) / F.nullif(F.col("main_length_ft"), F.lit(0.0))
    head = F.lower(F.col("headsign"))
    word = None
    for wd in words:
        c = head.contains(wd)
        word = c if word is None else word | c
    t = (F.when(F.col("shape_id") == F.col("main_shape_id"), F.lit("main"))
         .when(F.col("trip_count") <= other_max_trips, F.lit("other/unknown"))
         .when((stop_drop > limited_share) | word, F.lit("limited"))
         .when((F.col("daytype") == "weekday") & F.col("school"), F.lit("school"))
         .when((stop_drop > short_share) & (len_drop > short_share), F.lit("short"))
         .otherwise(F.lit("branch")))
    return vt.withColumn("inferred_variant_type", t)


def variant_metrics(trips: DataFrame, stop_times: DataFrame, stops: DataFrame, calendar: DataFrame,
                    route_filter=None, school_windows=SCHOOL_WINDOWS) -> DataFrame:
    """All per-variant metrics (C29-C36) for already date-filtered trips.

    The trips are read once: one aggregate per shape carries every trip
    metric and the routes listing the shape; only the shapes' first trips
    meet stop_times for the stop pattern. The per-shape table is stored first
    (a job), so the planner knows its size in bytes and broadcasts a small one
    into the stop_times join. A ``route_filter`` narrows trips and stop times
    before anything is profiled (``reduce_to_routes``).
    """
    if route_filter is not None:
        trips, stop_times = reduce_to_routes(trips, stop_times, route_filter)
    stats = materialize(variant_trip_stats(trips, calendar, first_stop_in_windows(stop_times, school_windows)))
    pattern = variant_stop_pattern(stats, stop_times, stops)
    per_shape = (stats.join(pattern, SHAPE_KEY, "left")
                 .withColumn("stop_count", F.coalesce("stop_count", F.lit(0).cast("long"))))
    return of_routes(per_shape.withColumn("route_id", F.explode("route_ids")).drop("route_ids"), route_filter)


def variant_table(trips: DataFrame, stop_times: DataFrame, stops: DataFrame, calendar: DataFrame,
                  calendar_dates: DataFrame, dates: DataFrame | None = None, route_filter=None,
                  services: DataFrame | None = None,
                  school_windows=SCHOOL_WINDOWS, main_weights=MAIN_WEIGHTS, **type_kw) -> DataFrame:
    """Every variant of every route and bundle with metrics and type.

    Trips are those running on any of ``dates`` (e.g. the representative
    days); pass ``services`` (``active_services`` output) to reuse it.
    ``school_windows``, ``main_weights`` and the ``variant_type`` keywords
    (``limited_share``, ``short_share``, ``other_max_trips``, ``words``) are
    parameters with the reference's values as defaults.
    """
    if services is None:
        services = active_services(calendar, calendar_dates, dates)
    kept_trips, _ = filter_bundle(trips, stop_times, services)
    vt = variant_metrics(kept_trips, stop_times, stops, calendar, route_filter, school_windows)
    out = variant_type(main_variant(vt, main_weights), **type_kw)
    return out.withColumn("daytype_direction",
                          F.concat_ws("_", F.col("daytype"), F.coalesce(F.col("direction_id").cast("string"),
                                                                       F.lit("None"))))
