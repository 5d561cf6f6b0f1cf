"""Which services run on which date, and the representative days.

The weekday test of the calendar is an OR of seven (day, flag) pairs. Written
as a join condition it cannot become a join key, so every date would meet
every service of its bundle. Instead the seven flags are unpivoted once into
(service, weekday) rows and the weekday becomes an equi-join key; only the
date range remains a residual filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.dates import (DAY_COLUMNS, clamp_day, date_from_parts, date_to_int,
                                      day_of, daytype, int_to_date, month_of, weekday_name,
                                      year_of)


def calendar_dates_fixed(calendar: DataFrame, literal: bool = False) -> DataFrame:
    """Calendar with ``start_date``/``end_date`` as valid dates.

    Impossible days (Feb 31, Apr 31) are clamped; ``literal=True`` keeps the
    original clamp order (see ``clamp_day``).
    """
    out = calendar
    for col in ("start_date", "end_date"):
        y, m, d = year_of(col), month_of(col), day_of(col)
        out = out.withColumn(col, date_from_parts(y, m, clamp_day(y, m, d, literal)))
    return out


def service_exceptions(calendar_dates: DataFrame) -> DataFrame:
    """Calendar exceptions with the exception date and its weekday name."""
    d = int_to_date("date")
    return calendar_dates.select("bundle", "service_id", "date", "exception_type",
                                 d.alias("service_date"), weekday_name(d).alias("day_of_week"))


def _service_weekdays(calendar: DataFrame) -> DataFrame:
    """(bundle, service_id, start_date, end_date, dow 0=Mon..6=Sun) per set flag."""
    dows = F.array(*[F.when(F.col(c) == 1, F.lit(i)) for i, c in enumerate(DAY_COLUMNS)])
    return calendar.select("bundle", "service_id", "start_date", "end_date",
                           F.explode(F.array_compact(dows)).alias("dow"))


def daily_services(bundle_dates: DataFrame, calendar: DataFrame, calendar_dates: DataFrame,
                   dedupe: bool = False, only_bundle_dates: bool = False,
                   literal: bool = False) -> DataFrame:
    """One row per (bundle, date, service) running that day.

    Scheduled services (range + weekday) minus removed exceptions, plus added
    exceptions. Added exceptions are appended without dedupe (a service both
    scheduled and added then appears twice) unless ``dedupe=True``; they are
    taken from every exception date of the selected bundles unless
    ``only_bundle_dates=True``.
    """
    dates = bundle_dates.select("bundle", "service_date",
                                F.weekday("service_date").alias("dow"))
    cal = _service_weekdays(calendar_dates_fixed(calendar, literal))
    scheduled = (dates.join(cal, ["bundle", "dow"])
                 .where(F.col("service_date").between(F.col("start_date"), F.col("end_date")))
                 .select("bundle", "service_date", "service_id"))
    exc = service_exceptions(calendar_dates).join(
        bundle_dates.select("bundle").distinct(), "bundle", "left_semi")
    removed = exc.where(F.col("exception_type") == 2).select("bundle", "service_date", "service_id")
    added = exc.where(F.col("exception_type") == 1).select("bundle", "service_date", "service_id")
    if only_bundle_dates:
        added = added.join(bundle_dates.select("bundle", "service_date"), ["bundle", "service_date"], "left_semi")
    kept = scheduled.join(removed, ["bundle", "service_date", "service_id"], "left_anti")
    out = kept.unionByName(added)
    if dedupe:
        out = out.distinct()
    return out.select("bundle", "service_date", weekday_name("service_date").alias("day_of_week"),
                      daytype("service_date").alias("daytype"), "service_id")


def daily_signature(daily: DataFrame) -> DataFrame:
    """The comma-joined service ids of each day (its schedule), in the order of the ids' own type."""
    return (daily.groupBy("bundle", "service_date", "daytype")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("service_id")), lambda x: x.cast("string")), ",")
                 .alias("schedule")))


def schedule_variations(signatures: DataFrame) -> DataFrame:
    """How many days share each schedule, and a label like ``Weekday-2``.

    Both come from one window partitioned by (bundle, daytype) and ordered by
    schedule: the frequency is a count over the peers with the same schedule
    (a value-range frame), so one shuffle serves the count, the label and the
    later ranking.
    """
    rank = Window.partitionBy("bundle", "daytype").orderBy("schedule")
    freq = rank.rangeBetween(Window.currentRow, Window.currentRow)
    return signatures.select(
        "bundle", "service_date", "schedule", "daytype",
        F.count("service_date").over(freq).alias("sched_var_frequency"),
        F.concat("daytype", F.lit("-"), F.dense_rank().over(rank).cast("string")).alias("schedule_variation"))


def ranked_days(variations: DataFrame) -> DataFrame:
    """One row per day with its rank inside (bundle, daytype): most frequent
    schedule first, earliest date on a tie."""
    w = Window.partitionBy("bundle", "daytype").orderBy(F.col("sched_var_frequency").desc(), "service_date")
    return variations.withColumn("ranking_by_freq", F.row_number().over(w))


def representative_days(bundle_dates: DataFrame, calendar: DataFrame, calendar_dates: DataFrame,
                        ranked: bool = False, dedupe: bool = False,
                        only_bundle_dates: bool = False, literal: bool = False) -> DataFrame:
    """The most representative Weekday, Saturday and Sunday of each bundle.

    Returns (bundle, service_date, daytype); ``ranked=True`` returns the
    ranked one-row-per-day table instead.
    """
    daily = daily_services(bundle_dates, calendar, calendar_dates, dedupe, only_bundle_dates, literal)
    r = ranked_days(schedule_variations(daily_signature(daily)))
    if ranked:
        return r
    return r.where(F.col("ranking_by_freq") == 1).select("bundle", "service_date", "daytype")


def active_services(calendar: DataFrame, calendar_dates: DataFrame, dates: DataFrame) -> DataFrame:
    """Distinct services running on each given (bundle, service_date, daytype).

    ``dates`` is a DataFrame (e.g. the output of ``representative_days``), so
    all dates of all bundles resolve in one join. Calendar ranges compare as
    raw yyyymmdd integers here (no clamping), as the per-date filter does.

    Scheduled services (keyed by weekday) and added exceptions (keyed by
    date) form one rule table, and each date meets it once through two keys;
    removals apply to scheduled rows only (a removed-and-added service runs).
    """
    dow = F.weekday("service_date")
    d = dates.select("bundle", "service_date", "daytype", date_to_int("service_date").alias("date_int"),
                     F.explode(F.array(F.struct(F.lit("dow").alias("kind"), dow.alias("key")),
                                       F.struct(F.lit("date").alias("kind"), date_to_int("service_date").alias("key"))))
                     .alias("k"))
    d = d.select("bundle", "service_date", "daytype", "date_int", "k.kind", "k.key")
    sched = _service_weekdays(calendar).select("bundle", F.lit("dow").alias("kind"), F.col("dow").alias("key"),
                                               "service_id", "start_date", "end_date")
    added = (calendar_dates.where(F.col("exception_type") == 1)
             .select("bundle", F.lit("date").alias("kind"), F.col("date").alias("key"), "service_id",
                     F.lit(None).cast("int").alias("start_date"), F.lit(None).cast("int").alias("end_date")))
    in_range = (F.col("start_date") <= F.col("date_int")) & (F.col("end_date") >= F.col("date_int"))
    hits = (d.join(sched.unionByName(added), ["bundle", "kind", "key"])
            .where((F.col("kind") == "date") | in_range))
    removed = (calendar_dates.where(F.col("exception_type") == 2)
               .select("bundle", F.col("date").alias("date_int"), "service_id", F.lit(True).alias("removed"))
               .distinct())
    return (hits.join(removed, ["bundle", "date_int", "service_id"], "left")
            .where((F.col("kind") == "date") | F.col("removed").isNull())
            .select("bundle", "service_date", "daytype", "service_id").distinct())


def trips_on_dates(trips: DataFrame, services: DataFrame) -> DataFrame:
    """Trips of the active services, one row per (trip, date), carrying daytype."""
    return trips.join(services, ["bundle", "service_id"])


def filter_bundle(trips: DataFrame, stop_times: DataFrame, services: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C11: trips running on any of the dates (distinct) and their stop times."""
    kept = trips.join(services.select("bundle", "service_id").distinct(), ["bundle", "service_id"], "left_semi")
    st = stop_times.join(kept.select("bundle", "trip_id"), ["bundle", "trip_id"], "left_semi")
    return kept, st
