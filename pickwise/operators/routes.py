"""Trips per time-of-day period and route, and the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.joins import null_safe_full_join
from pickwise.functions.clock import PERIODS, period_column_name, period_label
from pickwise.operators.service import active_services, trips_on_dates
from pickwise.operators.trips import trip_profile

DAY_KEY = ["bundle", "daytype", "service_date"]
PERIOD_COLUMNS = [period_column_name(p[0]) for p in PERIODS]
TOTAL_COLUMNS = ["total_trips", "total_variants"]


def trip_first_departure(stop_times: DataFrame, profile: DataFrame | None = None,
                         with_text: bool = False) -> DataFrame:
    """C22 (part): first non-null arrival of each trip in sequence order, in
    minutes (and as text with ``with_text``)."""
    p = profile if profile is not None else trip_profile(stop_times, with_text=with_text)
    cols = ["bundle", "trip_id"] + (["first_arrival"] if with_text else [])
    return p.select(*cols, F.col("first_min").alias("minutes"))


def trip_period(df: DataFrame, minutes: str = "minutes", periods=PERIODS) -> DataFrame:
    """Label each row with its time-of-day period."""
    return df.withColumn("period", period_label(minutes, periods))


def trip_times(trips_dated: DataFrame, first_departure: DataFrame, max_minute: int = 1440) -> DataFrame:
    """Trips of each date with their first departure, before ``max_minute``."""
    t = trips_dated.select(*DAY_KEY, "trip_id", "route_id", "direction_id", "shape_id")
    return (t.join(first_departure, ["bundle", "trip_id"])
            .where(F.col("minutes") < max_minute))


def route_period_counts(times: DataFrame, periods=PERIODS) -> DataFrame:
    """C24 + C25: per route and direction, trips in each period (wide, zero
    filled), total trips and distinct shapes (nulls not counted).

    The pivot is a fixed list of conditional counts, so no extra job is run
    to discover the period values and absent periods still get a column.
    """
    labelled = trip_period(times, "minutes", periods)
    counts = [F.count(F.when(F.col("period") == p[0], 1)).alias(period_column_name(p[0])) for p in periods]
    # distinct shapes as the size of a per-group set (bounded by the route's
    # variants): one aggregate, no Expand and no second shuffle
    return (labelled.groupBy(*DAY_KEY, "route_id", "direction_id")
            .agg(*counts, F.count("trip_id").alias("total_trips"),
                 F.size(F.collect_set("shape_id")).cast("long").alias("total_variants")))


def route_frequencies(counts: DataFrame, periods=PERIODS) -> DataFrame:
    """Trips per hour of each period, half-even rounded to one decimal;
    a period without trips is null rather than 0."""
    cols = {}
    for name, _, _, hours in periods:
        c = period_column_name(name)
        cols[c] = F.bround(F.nullif(F.col(c), F.lit(0)) / hours, 1)
    return counts.withColumns(cols)


def route_names(routes: DataFrame) -> DataFrame:
    return routes.groupBy("bundle", "route_id").agg(F.min("route_short_name").alias("route_short_name"),
                                                    F.min("route_long_name").alias("route_long_name"))


def route_summary(trips: DataFrame, stop_times: DataFrame, routes: DataFrame, calendar: DataFrame,
                  calendar_dates: DataFrame, dates: DataFrame | None = None, max_minute: int = 1440,
                  periods=PERIODS, services: DataFrame | None = None,
                  profile: DataFrame | None = None, literal: bool = False) -> DataFrame:
    """Per route, the busier direction's frequency in each period and the
    sum of both directions' totals. Routes without a routes row keep a null
    name instead of vanishing; names are attached after grouping. Pass
    ``services`` (``active_services`` output) to reuse it. ``literal=True``
    drops what has a null among route, long name and direction, as a grouping
    on these three that leaves out nulls does (Q11)."""
    if services is None:
        services = active_services(calendar, calendar_dates, dates)
    times = trip_times(trips_on_dates(trips, services), trip_first_departure(stop_times, profile), max_minute)
    freq = route_frequencies(route_period_counts(times, periods), periods)
    if literal:
        freq = freq.where(F.col("route_id").isNotNull() & F.col("direction_id").isNotNull())
    pcols = [period_column_name(p[0]) for p in periods]
    rolled = (freq.groupBy(*DAY_KEY, "route_id")
              .agg(*[F.max(c).alias(c) for c in pcols],
                   *[F.sum(c).cast("long").alias(c) for c in TOTAL_COLUMNS]))
    names = route_names(routes)
    named = (rolled.join(names.where(F.col("route_long_name").isNotNull()), ["bundle", "route_id"]) if literal
             else rolled.join(names, ["bundle", "route_id"], "left"))
    return (named
            .select(*DAY_KEY, "route_id", "route_short_name", "route_long_name", *pcols, *TOTAL_COLUMNS))


def compare_route_summaries(summary: DataFrame, bundle_a: str, bundle_b: str) -> DataFrame:
    """Full outer join on (daytype, route_id); every other column is
    suffixed ``_b1`` / ``_b2``."""
    key = ["daytype", "route_id"]
    vals = [c for c in summary.columns if c not in key + ["bundle"]]

    def side(bundle, sfx):
        return summary.where(F.col("bundle") == bundle).select(*key, *[F.col(v).alias(f"{v}_{sfx}") for v in vals])

    return null_safe_full_join(side(bundle_a, "b1"), side(bundle_b, "b2"), key)
