"""The three-part comparison report of two bundles (C55, IO7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pickwise.operators import routes, schedule, service, stops
from pickwise.operators.patterns import fold, stop_list_of_patterns
from pickwise.operators.trips import trip_profile
from pickwise.plans.materialize import materialize
from pickwise.sources.sinks import with_bundle_titles, write_dataset
from pickwise.sources.tables import GtfsTables


def report(tables: GtfsTables, bundle_a: str, bundle_b: str, dates: DataFrame | None = None,
           literal_days: bool = False, folded: bool = False) -> dict[str, DataFrame]:
    """Route summary, stop list and hourly frequency + running time of two
    bundles side by side. ``dates`` defaults to each bundle's representative
    Weekday, Saturday and Sunday. ``folded``: the stop list reads the pattern
    dictionary; worth it where many trips share a sequence of stops, as published
    schedules do. The result is the same."""
    t = tables.for_bundles([bundle_a, bundle_b])
    if dates is None:
        dates = service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)
    # Reused by the parts and so stored once: the services (small) and the
    # fixed-width profile of each trip. The stop list reads stop_times itself.
    services = materialize(service.active_services(t.calendar, t.calendar_dates, dates))
    patterns = fold(t.stop_times) if folded else None
    profile = patterns.trips if folded else materialize(trip_profile(t.stop_times))
    summary = routes.route_summary(t.trips, t.stop_times, t.routes, t.calendar, t.calendar_dates,
                                   services=services, profile=profile)
    sched = schedule.schedule(t.trips, t.stop_times, t.calendar, t.calendar_dates,
                              services=services, profile=profile)
    listed = stop_list_of_patterns(t.trips, patterns, t.stops) if folded else stops.stop_list(t.trips, t.stop_times, t.stops)
    return {
        "route_summary": with_bundle_titles(routes.compare_route_summaries(summary, bundle_a, bundle_b), bundle_a, bundle_b),
        "stop_list": with_bundle_titles(stops.compare_stop_lists(listed, bundle_a, bundle_b), bundle_a, bundle_b),
        "schedule": with_bundle_titles(schedule.compare_schedules(sched, bundle_a, bundle_b, literal_days),
                                       bundle_a, bundle_b),
    }


# Sort order of each report part at the sink.
REPORT_ORDER = {
    "route_summary": ["route_id", "daytype"],
    "stop_list": ["route_id", "direction_id", "stop_id"],
    "schedule": ["day", "route_id", "direction_id", "hour"],
}


def write_report(parts: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """Write each part as its own dataset ``root/<part>``."""
    for name, df in parts.items():
        write_dataset(df, f"{root}/{name}", fmt=fmt, order_by=REPORT_ORDER.get(name),
                      fill_empty=(fmt == "csv"))
