"""Hourly frequency and running time per route and direction.

One lazy plan keyed by (bundle, daytype, service_date): no loop over dates
or bundles. Boundaries: the per-trip aggregate of stop_times (shuffle on
trip), the hourly group (shuffle on route/direction/hour) and, for the
comparison, one full outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.joins import null_safe_full_join
from pickwise.functions.clock import clock_part
from pickwise.operators.service import active_services, trips_on_dates
from pickwise.operators.trips import trip_profile

DAY_KEY = ["bundle", "daytype", "service_date"]
GROUP_KEY = DAY_KEY + ["route_id", "direction_id"]


def clock_parts(df: DataFrame, col: str = "arrival_time") -> DataFrame:
    """Add ``hour`` (mod 24), ``minute`` and ``time_in_minutes`` for a clock column."""
    h, m = clock_part(col, 0), clock_part(col, 1)
    return df.withColumns({"time_in_minutes": h * 60 + m, "hour": h % 24, "minute": m})


def trip_endpoints(stop_times: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """start/end minutes of each trip (origin = min, destination = max stop_sequence)."""
    p = profile if profile is not None else trip_profile(stop_times)
    return p.select("bundle", "trip_id", "start_min", "end_min")


def trip_runtimes(trips_dated: DataFrame, endpoints: DataFrame, max_minute: int = 1440) -> DataFrame:
    """C14: duration and start hour per trip and date; keeps 0 <= start and end < max_minute.

    Trips that pass midnight (end >= 24:00) are dropped, while the start hour
    is taken modulo 24.
    """
    t = trips_dated.select(*DAY_KEY, "trip_id", "route_id", "direction_id")
    return (t.join(endpoints, ["bundle", "trip_id"])
            .where((F.col("start_min") >= 0) & (F.col("end_min") < max_minute))
            .select(*GROUP_KEY, "trip_id", "start_min", "end_min",
                    (F.col("end_min") - F.col("start_min")).alias("duration_min"),
                    ((F.col("start_min") - F.col("start_min") % 60) / 60 % 24).cast("int").alias("hour")))


def hourly_service(runtimes: DataFrame, threshold: float = 1.0) -> DataFrame:
    """C15 + C16: trips per hour, median running time, and a flag when
    |median - mean| exceeds ``threshold`` minutes."""
    g = (runtimes.groupBy(*GROUP_KEY, "hour")
         .agg(F.count("trip_id").alias("frequency"),
              F.median("duration_min").alias("avg_running_time"),
              F.avg("duration_min").alias("mean_running_time")))
    return g.withColumn("flag", F.abs(F.col("avg_running_time") - F.col("mean_running_time")) > threshold)


def hourly_grid(hourly: DataFrame) -> DataFrame:
    """C17: 24 rows for every route/direction running that day; empty hours are null.

    The hours of each route/direction are gathered into a small map (at most
    24 entries) and the 0-23 grid is generated from it, so the result needs
    no self-join and no second pass over the trips.
    """
    val = F.struct("frequency", "avg_running_time", "flag")
    per_key = hourly.groupBy(*GROUP_KEY).agg(F.map_from_entries(F.collect_list(F.struct("hour", val))).alias("by_hour"))
    grid = per_key.select(*GROUP_KEY, "by_hour", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    cell = F.try_element_at(F.col("by_hour"), F.col("hour"))
    return grid.select(*GROUP_KEY, "hour", cell["frequency"].alias("frequency"),
                       cell["avg_running_time"].alias("avg_running_time"), cell["flag"].alias("flag"))


def schedule(trips: DataFrame, stop_times: DataFrame, calendar: DataFrame, calendar_dates: DataFrame,
             dates: DataFrame | None = None, max_minute: int = 1440, threshold: float = 1.0,
             services: DataFrame | None = None, profile: DataFrame | None = None) -> DataFrame:
    """Hourly schedule of every (bundle, date) in ``dates``.

    ``dates`` has (bundle, service_date, daytype), e.g. ``representative_days``;
    or pass ``services`` (``active_services`` output) to reuse it, and
    ``profile`` (a materialized ``trip_profile``) to skip the stop_times shuffle.
    """
    if services is None:
        services = active_services(calendar, calendar_dates, dates)
    runtimes = trip_runtimes(trips_on_dates(trips, services), trip_endpoints(stop_times, profile), max_minute)
    return hourly_grid(hourly_service(runtimes, threshold))


def compare_schedules(sched: DataFrame, bundle_a: str, bundle_b: str, literal: bool = False) -> DataFrame:
    """The two bundles' hourly schedules side by side (full outer join).

    Rows pair on (daytype, route_id, direction_id, hour), null keys with null keys. ``literal=True``
    pairs on the weekday name instead, so e.g. a Wednesday and a Tuesday
    never meet.
    """
    day = F.lower(F.date_format("service_date", "EEEE")) if literal else F.col("daytype")
    key = ["day", "route_id", "direction_id", "hour"]
    vals = ["service_date", "frequency", "avg_running_time", "flag"]

    def side(bundle, sfx):
        s = sched.where(F.col("bundle") == bundle).withColumn("day", day)
        return s.select(*key, *[F.col(v).alias(f"{v}_{sfx}") for v in vals])

    return null_safe_full_join(side(bundle_a, "b1"), side(bundle_b, "b2"), key)
