"""Registered queries: one per operator, each paired with a DuckDB oracle.

Every query derives the GTFS-shaped bundle tables from the star tables at
``sf_dir`` (``star_to_gtfs``) and runs one operator over all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pickwise.functions.rule_table import rule_table
from pickwise.operators import matching, overlap, patterns, quality, ridership, routes, schedule, service, stops, variants
from pickwise.plans import oracle_sql as O
from pickwise.plans.materialize import materialize, scratch_folder
from pickwise.plans.report import report
from pickwise.session import session_key
from pickwise.sources import gtfs_text, sinks, store
from pickwise.sources import tables as T
from pickwise.sources.star_fixture import fixture_override_rules, fixture_rename_rules, star_to_gtfs

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


class StoredTables:
    """The GTFS tables derived from ``sf_dir``, each an attribute: stored as Parquet
    partitioned by bundle when a query first asks for it, so that a query waits for
    the tables it reads alone. Every query scans what was stored."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._root = spark, scratch_folder(spark, "bundles")
        self._made = star_to_gtfs(spark, sf_dir)

    def only(self, names) -> T.GtfsTables:
        """These tables; those not yet stored are written together."""
        made = {n: df for n in names if (df := getattr(self._made, n)) is not None}
        missing = {n: df for n, df in made.items() if n not in vars(self)}
        T.write_tables(T.GtfsTables(**missing), self._root)
        for name, df in T.load_tables(self._spark, self._root, names=list(missing)).items() if missing else ():
            setattr(self, name, df)
        return T.GtfsTables(**{n: getattr(self, n) for n in made})

    def all(self) -> T.GtfsTables:
        return self.only(T.TABLE_NAMES)

    def items(self):
        return self.all().items()

    def for_bundles(self, bundles) -> T.GtfsTables:
        return self.all().for_bundles(bundles)

    def __getattr__(self, name: str) -> DataFrame | None:
        if name not in T.TABLE_NAMES:
            raise AttributeError(name)
        return getattr(self.only([name]), name)


_FIXTURES: dict[tuple[str, str], StoredTables] = {}


def _t(spark, sf_dir):
    """The tables derived from ``sf_dir``, stored once per session."""
    key = (session_key(spark), sf_dir)
    if key not in _FIXTURES:
        _FIXTURES[key] = StoredTables(spark, sf_dir)
    return _FIXTURES[key]


_SERVICES: dict[tuple[str, str], DataFrame] = {}


def _services(spark, sf_dir):
    """Services of the representative days (tiny, reused by every operator)."""
    key = (session_key(spark), sf_dir)
    if key not in _SERVICES:
        t = _t(spark, sf_dir)
        _SERVICES[key] = materialize(service.active_services(t.calendar, t.calendar_dates, _days(t)))
    return _SERVICES[key]


# ---- bundle loading (C01-C02) ------------------------------------------------

@register("bundle_trips", O.BUNDLE_TRIPS)
def q_bundle_trips(spark, sf_dir):
    t = _t(spark, sf_dir)
    return T.bundle_trips(t.trips, t.routes).select(
        "bundle", "route_id", "trip_id", "service_id", "trip_headsign", "direction_id", "shape_id", "agency_id")


@register("bundle_stops", O.BUNDLE_STOPS)
def q_bundle_stops(spark, sf_dir):
    t = _t(spark, sf_dir)
    return T.bundle_stops(t.stops, t.shape_reference)


@register("bundle_tables", O.BUNDLE_TABLES)
def q_bundle_tables(spark, sf_dir):
    return T.bundle_tables(_t(spark, sf_dir).only(T.COLUMNS), ["pick_a"]).stop_times


# ---- the bundle store --------------------------------------------------------

@register("store_two_bundles", O.STORE_TWO_BUNDLES)
def q_store_two_bundles(spark, sf_dir):
    """pick_b, a first pick_a without its odd services, then pick_a as it is, each
    written to the store; what the store then holds, checked against its manifests."""
    t = _t(spark, sf_dir).all()
    root = scratch_folder(spark, "store")
    store.write_bundle(t, root, "pick_b")
    store.write_bundle(replace(t, trips=t.trips.where("service_id not in ('S1', 'S3', 'S5')"), ridership=None), root, "pick_a")
    store.write_bundle(t, root, "pick_a")
    return store.verify(spark, root)


@register("store_trips_by_service", O.STORE_TRIPS_BY_SERVICE)
def q_store_trips_by_service(spark, sf_dir):
    """Trips and stop times a service of a store in which pick_a was written before
    pick_b and only pick_b is asked for."""
    t = _t(spark, sf_dir).all()
    root = scratch_folder(spark, "store")
    store.write_bundles(t, root, ["pick_a", "pick_b"])
    b = store.load_bundles(spark, root, ["pick_b"], ["trips", "stop_times"])
    return (b.trips.join(b.stop_times, ["bundle", "trip_id"]).groupBy("bundle", "service_id")
            .agg(F.count_distinct("trip_id").alias("n_trips"), F.count(F.lit(1)).alias("n_stop_times")))


# ---- text feeds ------------------------------------------------------------------

def _feeds(spark, sf_dir):
    """The fixture written as text feeds and read back. pick_b lists its columns in
    another order, has no calendar_dates, and every fortieth order's first stop
    time is malformed in one of four ways."""
    t = _t(spark, sf_dir).only(gtfs_text.TEXT_SCHEMAS)
    root = scratch_folder(spark, "feeds")
    gtfs_text.write_feed(t, root, "pick_a")
    backwards = {n: [c for c in reversed(cols) if c in df.columns] for n, cols in gtfs_text.TEXT_SCHEMAS.items() if (df := getattr(t, n)) is not None}
    others = [n for n in gtfs_text.TEXT_SCHEMAS if n not in ("calendar_dates", "stop_times")]
    gtfs_text.write_feed(t, root, "pick_b", others, backwards)
    fault = F.when(F.col("stop_sequence") == 1, F.substring("trip_id", 2, 20).cast("long") % 40).otherwise(-1)
    fields = {"trip_id": F.when(fault == 13, F.lit("")).otherwise(F.col("trip_id")),
              "stop_sequence": F.when(fault == 11, F.lit("first")).otherwise(F.col("stop_sequence").cast("string"))}
    line = F.concat_ws(",", *[F.coalesce(fields.get(c, F.col(c).cast("string")), F.lit("")) for c in backwards["stop_times"]])
    line = F.when(fault == 3, F.concat(line, F.lit(",9"))).when(fault == 7, F.substring_index(line, ",", 3)).otherwise(line)
    # one text column under the header's name, so that nothing is quoted
    rows = t.stop_times.where("bundle = 'pick_b'").select(line.alias(",".join(backwards["stop_times"])))
    rows.write.option("header", True).option("sep", "\u0001").csv(f"{root}/pick_b/stop_times.txt")
    return gtfs_text.read_feeds(spark, root)


@register("feed_tables", O.FEED_TABLES)
def q_feed_tables(spark, sf_dir):
    sizes = [df.groupBy("bundle").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                      F.count_distinct(gtfs_text.TEXT_KEYS[name][0]).alias("n_keys"))
             for name, df in _feeds(spark, sf_dir).tables.items()]
    return reduce(DataFrame.unionByName, sizes).select("bundle", "table_name", "n_rows", "n_keys")


@register("feed_stop_times", O.FEED_STOP_TIMES)
def q_feed_stop_times(spark, sf_dir):
    return _feeds(spark, sf_dir).tables.stop_times.select("bundle", "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence", "timepoint")


@register("feed_quarantine", O.FEED_QUARANTINE)
def q_feed_quarantine(spark, sf_dir):
    return _feeds(spark, sf_dir).quarantine.groupBy("bundle", "table_name", "reason", "column_name").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- what loading loses or multiplies (Q31, Q32) ----------------------------------

def _faulty(spark, sf_dir):
    """The fixture with routes of two agencies and repeated routes, doubled stop
    sequences at unknown stops, and a bundle of trips alone."""
    t = _t(spark, sf_dir)
    nk = F.substring("route_id", 2, 20).cast("long")
    routes = t.routes.select("bundle", "route_id", "agency_id")
    routes = routes.unionByName(routes.where(nk % 5 == 3).withColumn("agency_id", F.lit("AG9"))).unionByName(routes.where(nk % 4 == 3))
    ok = F.substring("trip_id", 2, 20).cast("long")
    times = t.stop_times.select("bundle", "trip_id", "stop_sequence", "stop_id")
    times = times.unionByName(times.where((ok % 53 == 0) & (F.col("stop_sequence") <= 2)).withColumn("stop_id", F.lit("ST0")))
    trips = t.trips.select("bundle", "route_id", "trip_id")
    alone = trips.where(ok % 31 == 0).withColumns({"bundle": F.lit("pick_c"), "trip_id": F.concat(F.lit("U"), "trip_id")})
    return trips.unionByName(alone), routes, times, t.stops


@register("quality_counts", O.QUALITY_COUNTS)
def q_quality_counts(spark, sf_dir):
    return quality.quality_counts(*_faulty(spark, sf_dir))


@register("load_losses", O.LOAD_LOSSES)
def q_load_losses(spark, sf_dir):
    """Counts that come with writing the loaded trips and stop times, without a job of their own."""
    trips, routes, times, _ = _faulty(spark, sf_dir)
    of_trips, of_times = Observation(), Observation()
    materialize(quality.watched_trips(trips, routes, of_trips))
    materialize(quality.watched_stop_times(times, trips, of_times))
    return spark.createDataFrame(list((of_trips.get | of_times.get).items()), "metric string, n_rows long")


# ---- service calendar and representative days (C04-C09) ----------------------

@register("calendar_dates_fixed", O.calendar_fixed(literal=False))
def q_calendar_fixed(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.calendar_dates_fixed(t.calendar).select("bundle", "service_id", "start_date", "end_date")


@register("calendar_dates_fixed_literal", O.calendar_fixed(literal=True))
def q_calendar_fixed_literal(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.calendar_dates_fixed(t.calendar, literal=True).select("bundle", "service_id", "start_date", "end_date")


@register("service_exceptions", O.SERVICE_EXCEPTIONS)
def q_service_exceptions(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.service_exceptions(t.calendar_dates)


@register("daily_services", O.daily_services())
def q_daily_services(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.daily_services(t.bundle_dates, t.calendar, t.calendar_dates)


@register("daily_services_dedupe", O.daily_services(dedupe=True, only_bundle_dates=True))
def q_daily_services_dedupe(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.daily_services(t.bundle_dates, t.calendar, t.calendar_dates, dedupe=True, only_bundle_dates=True)


@register("daily_signature", O.daily_signature())
def q_daily_signature(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.daily_signature(service.daily_services(t.bundle_dates, t.calendar, t.calendar_dates))


@register("schedule_variations", O.schedule_variations(ranked=True))
def q_schedule_variations(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates, ranked=True)


@register("schedule_variations_literal", O.schedule_variations(ranked=True, literal=True))
def q_schedule_variations_literal(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates, ranked=True, literal=True)


@register("representative_days", O.schedule_variations(ranked=False))
def q_representative_days(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)


@register("active_services", O.ACTIVE_SERVICES)
def q_active_services(spark, sf_dir):
    t = _t(spark, sf_dir)
    days = service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)
    return service.active_services(t.calendar, t.calendar_dates, days)


@register("filter_bundle_trips", O.FILTER_BUNDLE_TRIPS)
def q_filter_bundle_trips(spark, sf_dir):
    t = _t(spark, sf_dir)
    days = service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)
    trips, st = service.filter_bundle(t.trips, t.stop_times,
                                      service.active_services(t.calendar, t.calendar_dates, days))
    per_trip = st.groupBy("bundle", "trip_id").agg(F.count("*").alias("stop_rows"))
    return trips.join(per_trip, ["bundle", "trip_id"], "left").select(
        "bundle", "trip_id", "route_id", "service_id", "shape_id", F.coalesce("stop_rows", F.lit(0)).alias("stop_rows"))


# ---- schedule (C12-C19) --------------------------------------------------------

def _days(t):
    return service.representative_days(t.bundle_dates, t.calendar, t.calendar_dates)


def _schedule(spark, sf_dir):
    t = _t(spark, sf_dir)
    return schedule.schedule(t.trips, t.stop_times, t.calendar, t.calendar_dates,
                             services=_services(spark, sf_dir))


@register("clock_parts", O.CLOCK_PARTS)
def q_clock_parts(spark, sf_dir):
    """Stop times an hour and minute of the clock, and their first and last service-day minute."""
    return (schedule.clock_parts(_t(spark, sf_dir).stop_times).groupBy("bundle", "hour", "minute")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("time_in_minutes").alias("first_min"), F.max("time_in_minutes").alias("last_min")))


@register("trip_runtimes", O.TRIP_RUNTIMES)
def q_trip_runtimes(spark, sf_dir):
    t = _t(spark, sf_dir)
    svc = _services(spark, sf_dir)
    return schedule.trip_runtimes(service.trips_on_dates(t.trips, svc), schedule.trip_endpoints(t.stop_times))


@register("schedule", O.SCHEDULE)
def q_schedule(spark, sf_dir):
    return _schedule(spark, sf_dir)


@register("compare_schedules", O.COMPARE_SCHEDULES)
def q_compare_schedules(spark, sf_dir):
    return schedule.compare_schedules(_schedule(spark, sf_dir), "pick_a", "pick_b")


@register("compare_schedules_literal", O.COMPARE_SCHEDULES_LITERAL)
def q_compare_schedules_literal(spark, sf_dir):
    return schedule.compare_schedules(_schedule(spark, sf_dir), "pick_a", "pick_b", literal=True)


# ---- stop lists (C20-C21) -----------------------------------------------------

@register("stop_list", O.STOP_LIST)
def q_stop_list(spark, sf_dir):
    t = _t(spark, sf_dir)
    return stops.stop_list(t.trips, t.stop_times, t.stops)


@register("compare_stop_lists", O.COMPARE_STOP_LISTS)
def q_compare_stop_lists(spark, sf_dir):
    t = _t(spark, sf_dir)
    return stops.compare_stop_lists(stops.stop_list(t.trips, t.stop_times, t.stops), "pick_a", "pick_b")


# ---- the pattern dictionary ----------------------------------------------------

@register("pattern_sizes", O.PATTERN_SIZES)
def q_pattern_sizes(spark, sf_dir):
    return patterns.fold(_t(spark, sf_dir).stop_times).sizes()


@register("pattern_stops", O.PATTERN_STOPS)
def q_pattern_stops(spark, sf_dir):
    """The patterns spelled out: how many patterns hold a stop at a place."""
    return (patterns.fold(_t(spark, sf_dir).stop_times).stops.groupBy("bundle", "stop_sequence", "stop_id")
            .agg(F.count(F.lit(1)).alias("n_patterns")))


@register("stop_list_from_patterns", O.STOP_LIST)
def q_stop_list_from_patterns(spark, sf_dir):
    t = _t(spark, sf_dir)
    return patterns.stop_list_of_patterns(t.trips, patterns.fold(t.stop_times), t.stops)


@register("report_stop_list_folded", O.titled(O.COMPARE_STOP_LISTS))
def q_report_stop_list_folded(spark, sf_dir):
    return report(_t(spark, sf_dir).only(T.COLUMNS), "pick_a", "pick_b", folded=True)["stop_list"]


# ---- route summary (C22-C28) ----------------------------------------------------

def _route_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return routes.route_summary(t.trips, t.stop_times, t.routes, t.calendar, t.calendar_dates,
                                services=_services(spark, sf_dir))


@register("route_period_counts", O.ROUTE_PERIOD_COUNTS)
def q_route_period_counts(spark, sf_dir):
    t = _t(spark, sf_dir)
    svc = _services(spark, sf_dir)
    times = routes.trip_times(service.trips_on_dates(t.trips, svc), routes.trip_first_departure(t.stop_times))
    return routes.route_period_counts(times)


@register("route_summary", O.ROUTE_SUMMARY)
def q_route_summary(spark, sf_dir):
    return _route_summary(spark, sf_dir)


@register("route_summary_literal", O.ROUTE_SUMMARY_LITERAL)
def q_route_summary_literal(spark, sf_dir):
    t = _t(spark, sf_dir)
    return routes.route_summary(t.trips, t.stop_times, t.routes, t.calendar, t.calendar_dates, services=_services(spark, sf_dir), literal=True)


@register("compare_route_summaries", O.COMPARE_ROUTE_SUMMARIES)
def q_compare_route_summaries(spark, sf_dir):
    return routes.compare_route_summaries(_route_summary(spark, sf_dir), "pick_a", "pick_b")


# ---- variants (C29-C39) ------------------------------------------------------------

VARIANT_COLUMNS = ["bundle", "route_id", "shape_id", "daytype", "direction_id", "daytype_direction",
                   "inferred_variant_type", "trip_count", "stop_count", "length_ft", "headsign", "start_stop",
                   "end_stop", "school", "main_shape_id"]


_VT: dict[tuple[str, str], DataFrame] = {}


def _variant_table(spark, sf_dir):
    """The variant table (one row per variant), materialized once: matching
    reads it three times (both sides of the pairs and the leftovers)."""
    key = (session_key(spark), sf_dir)
    if key not in _VT:
        t = _t(spark, sf_dir)
        _VT[key] = materialize(variants.variant_table(t.trips, t.stop_times, t.stops, t.calendar, t.calendar_dates,
                                                      services=_services(spark, sf_dir)))
    return _VT[key]


@register("variant_table", O.VARIANT_TABLE)
def q_variant_table(spark, sf_dir):
    return _variant_table(spark, sf_dir).withColumn("length_ft", F.bround("length_ft", 1)).select(*VARIANT_COLUMNS)


@register("variant_type_counts", O.VARIANT_TYPE_COUNTS)
def q_variant_type_counts(spark, sf_dir):
    return (_variant_table(spark, sf_dir).groupBy("bundle", "inferred_variant_type")
            .agg(F.count(F.lit(1)).alias("variants"), F.sum("trip_count").cast("long").alias("trips")))


# ---- similarity and matching (C40-C47) ------------------------------------------------

def _shown(score: str):
    """Four decimals; the last bits of a sum, which depend on its order, go first."""
    return F.bround(F.bround(score, 9), 4)


def _pairs(spark, sf_dir, version):
    p = matching.variant_pairs(_variant_table(spark, sf_dir), "pick_a", "pick_b", version=version)
    comps = [c for c in p.columns if c not in ("route_id", "direction_id", "daytype", "shape_id_a", "shape_id_b")]
    return p.withColumns({c: _shown(c) for c in comps})


@register("variant_pairs_v1", O.variant_pairs(1))
def q_variant_pairs_v1(spark, sf_dir):
    return _pairs(spark, sf_dir, 1)


@register("variant_pairs_v2", O.variant_pairs(2))
def q_variant_pairs_v2(spark, sf_dir):
    return _pairs(spark, sf_dir, 2)


@register("variant_matches", O.variant_matches(2))
def q_variant_matches(spark, sf_dir):
    m = matching.variant_matches(_variant_table(spark, sf_dir), "pick_a", "pick_b", version=2)
    return m.withColumn("score", _shown("score"))


@register("variant_matches_v1", O.variant_matches(1))
def q_variant_matches_v1(spark, sf_dir):
    m = matching.variant_matches(_variant_table(spark, sf_dir), "pick_a", "pick_b", version=1)
    return m.withColumn("score", _shown("score"))


@register("variant_matches_bounded", O.variant_matches(2))
def q_variant_matches_bounded(spark, sf_dir):
    m = matching.bounded_matches(_variant_table(spark, sf_dir), "pick_a", "pick_b", version=2)
    return m.withColumn("score", _shown("score"))


@register("variant_matches_bounded_v1", O.variant_matches(1))
def q_variant_matches_bounded_v1(spark, sf_dir):
    m = matching.bounded_matches(_variant_table(spark, sf_dir), "pick_a", "pick_b", version=1)
    return m.withColumn("score", _shown("score"))


@register("shared_track", O.SHARED_TRACK)
def q_shared_track(spark, sf_dir):
    t = overlap.shared_track(_variant_table(spark, sf_dir), "pick_a", "pick_b")
    return t.withColumns({c: _shown(c) for c in ("shared", "length_a", "length_b", "shape_similarity")})


@register("variant_pairs_track", O.VARIANT_PAIRS_TRACK)
def q_variant_pairs_track(spark, sf_dir):
    vt = _variant_table(spark, sf_dir)
    p = matching.variant_pairs(vt, "pick_a", "pick_b", track=overlap.shared_track(vt, "pick_a", "pick_b"))
    return p.withColumns({c: _shown(c) for c in [*matching.WEIGHTS_V2, "score"]})


@register("variant_table_of_routes", O.VARIANT_TABLE_OF_ROUTES)
def q_variant_table_of_routes(spark, sf_dir):
    t = _t(spark, sf_dir)
    vt = variants.variant_table(t.trips, t.stop_times, t.stops, t.calendar, t.calendar_dates,
                                services=_services(spark, sf_dir), route_filter="^R1")
    return vt.withColumn("length_ft", F.bround("length_ft", 1)).select(*VARIANT_COLUMNS)


# ---- the report of two bundles (C55, IO7) ----------------------------------------------

def _report(part: str):
    return lambda spark, sf_dir: report(_t(spark, sf_dir).only(T.COLUMNS), "pick_a", "pick_b")[part]


for _part, _sql in (("route_summary", O.COMPARE_ROUTE_SUMMARIES), ("stop_list", O.COMPARE_STOP_LISTS),
                    ("schedule", O.COMPARE_SCHEDULES)):
    register(f"report_{_part}", O.titled(_sql))(_report(_part))


# ---- sinks (IO5, IO8, O1, PF11) ----------------------------------------------------

def _stop_lists(spark, sf_dir):
    t = _t(spark, sf_dir)
    return stops.stop_list(t.trips, t.stop_times, t.stops)


@register("sink_csv_round_trip", O.SINK_CSV)
def q_sink_csv_round_trip(spark, sf_dir):
    """The compared stop lists written as sorted CSV with blanks for nulls, as read back from there."""
    out = stops.compare_stop_lists(_stop_lists(spark, sf_dir), "pick_a", "pick_b")
    path = scratch_folder(spark, "sink")
    sinks.write_checked(out, path, "csv", order_by=["route_id", "direction_id", "stop_id"], fill_empty=True)
    return sinks.read_dataset(out, path, "csv")


@register("sink_receipts", O.SINK_RECEIPTS)
def q_sink_receipts(spark, sf_dir):
    """The stop lists in each format, sorted over all files or within a folder a bundle."""
    out = materialize(_stop_lists(spark, sf_dir))
    made = []
    for fmt, layout in (("csv", "sorted"), ("csv", "folders"), ("parquet", "sorted"), ("parquet", "folders"), ("orc", "sorted")):
        r = sinks.write_checked(out, scratch_folder(spark, "sink"), fmt, partition_by=["bundle"] if layout == "folders" else None,
                                order_by=["route_id", "stop_id", "direction_id"])
        made.append((fmt, layout, r.rows_written, r.rows_read, r.same_rows, r.disorder))
    return spark.createDataFrame(made, "fmt string, layout string, rows_written long, rows_read long, same_rows boolean, disorder long")


# ---- ridership id repair (C48-C54) ---------------------------------------------------

REF_YEAR, REF_MONTHS = "2000", ("9", "10", "11", "12")


def _rid(spark, sf_dir):
    return _t(spark, sf_dir).ridership


def _pre(spark, sf_dir, literal=False):
    return ridership.ridership_overrides(_rid(spark, sf_dir), literal=literal)


@register("ridership_overrides", O.RIDERSHIP_OVERRIDES)
def q_ridership_overrides(spark, sf_dir):
    return _pre(spark, sf_dir)


@register("override_rule_table", O.OVERRIDE_RULE_TABLE)
def q_override_rule_table(spark, sf_dir):
    return ridership.override_by_table(_rid(spark, sf_dir), fixture_override_rules(spark, sf_dir), tolerance=0.05)


@register("override_rules_as_table", O.RIDERSHIP_OVERRIDES)
def q_override_rules_as_table(spark, sf_dir):
    return ridership.override_by_table(_rid(spark, sf_dir), rule_table(spark, ridership.OVERRIDE_RULES))


@register("reference_ids", O.REFERENCE_IDS)
def q_reference_ids(spark, sf_dir):
    return ridership.reference_ids(_pre(spark, sf_dir), REF_YEAR, REF_MONTHS)


@register("missing_ids", O.MISSING_IDS)
def q_missing_ids(spark, sf_dir):
    return ridership.missing_ids(_pre(spark, sf_dir))


def _attempt(spark, sf_dir):
    pre = _pre(spark, sf_dir)
    good = ridership.reference_ids(pre, REF_YEAR, REF_MONTHS)
    return ridership.match_ids(ridership.missing_ids(pre), good), good


@register("match_ids", O.MATCH_IDS)
def q_match_ids(spark, sf_dir):
    return _attempt(spark, sf_dir)[0]


def _renamed(spark, sf_dir):
    attempt, good = _attempt(spark, sf_dir)
    extra = fixture_rename_rules(spark, sf_dir)
    return ridership.rename_stops(attempt.where(F.col("matched_gtfsid").isNull()), extra_rules=extra), good


@register("rename_stops", O.RENAME_STOPS)
def q_rename_stops(spark, sf_dir):
    return _renamed(spark, sf_dir)[0]


@register("match_renamed_ids", O.MATCH_RENAMED_IDS)
def q_match_renamed_ids(spark, sf_dir):
    renamed, good = _renamed(spark, sf_dir)
    return ridership.match_renamed_ids(renamed, good)


def _fill(spark, sf_dir, literal=False):
    return ridership.fill_ids(_rid(spark, sf_dir), REF_YEAR, REF_MONTHS, literal=literal,
                              extra_rename_rules=fixture_rename_rules(spark, sf_dir))


@register("fill_ids", O.FILL_IDS)
def q_fill_ids(spark, sf_dir):
    return _fill(spark, sf_dir)


@register("fill_ids_literal", O.FILL_IDS_LITERAL)
def q_fill_ids_literal(spark, sf_dir):
    return _fill(spark, sf_dir, literal=True)


@register("id_repair_summary", O.ID_REPAIR_SUMMARY)
def q_id_repair_summary(spark, sf_dir):
    pre = _pre(spark, sf_dir)
    lookup = ridership.id_lookup(pre, REF_YEAR, REF_MONTHS,
                                 extra_rename_rules=fixture_rename_rules(spark, sf_dir))
    j = pre.join(lookup, ridership.KEY, "left")
    outcome = (F.when(F.col("gtfsid").isNotNull(), F.lit("had_id"))
               .when(F.col("matched_gtfsid").isNotNull(), F.lit("exact"))
               .when(F.col("renamed_gtfsid").isNotNull(), F.lit("renamed"))
               .otherwise(F.lit("not_repaired")))
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- sub-operators registered on their own ----------------------------------------

@register("trip_endpoints", O.TRIP_ENDPOINTS)
def q_trip_endpoints(spark, sf_dir):
    return schedule.trip_endpoints(_t(spark, sf_dir).stop_times)


@register("hourly_service", O.HOURLY_SERVICE)
def q_hourly_service(spark, sf_dir):
    t = _t(spark, sf_dir)
    rt = schedule.trip_runtimes(service.trips_on_dates(t.trips, _services(spark, sf_dir)),
                                schedule.trip_endpoints(t.stop_times))
    return schedule.hourly_service(rt).withColumn("mean_running_time", F.bround("mean_running_time", 4))


@register("trip_first_departure", O.TRIP_FIRST_DEPARTURE)
def q_trip_first_departure(spark, sf_dir):
    return routes.trip_period(routes.trip_first_departure(_t(spark, sf_dir).stop_times, with_text=True))


@register("route_frequencies", O.ROUTE_FREQUENCIES)
def q_route_frequencies(spark, sf_dir):
    t = _t(spark, sf_dir)
    times = routes.trip_times(service.trips_on_dates(t.trips, _services(spark, sf_dir)),
                              routes.trip_first_departure(t.stop_times))
    return routes.route_frequencies(routes.route_period_counts(times))


@register("variants", O.VARIANTS)
def q_variants(spark, sf_dir):
    return variants.variants(_t(spark, sf_dir).trips)


def _kept_trips(spark, sf_dir):
    t = _t(spark, sf_dir)
    return service.filter_bundle(t.trips, t.stop_times, _services(spark, sf_dir))[0]


@register("variant_school", O.VARIANT_SCHOOL)
def q_variant_school(spark, sf_dir):
    return variants.variant_school(_kept_trips(spark, sf_dir), _t(spark, sf_dir).stop_times)


@register("variant_stop_pattern", O.VARIANT_STOP_PATTERN)
def q_variant_stop_pattern(spark, sf_dir):
    t = _t(spark, sf_dir)
    stats = materialize(variants.variant_trip_stats(_kept_trips(spark, sf_dir), t.calendar))
    p = variants.variant_stop_pattern(stats, t.stop_times, t.stops)
    return p.select("bundle", "shape_id", "stop_count", "start_stop", "end_stop",
                    F.bround("length_ft", 1).alias("length_ft"),
                    F.array_join("stop_ids", ",").alias("stop_ids"),
                    F.array_join("stop_names", "|").alias("stop_names"))


@register("stop_list_from_profile", O.STOP_LIST)
def q_stop_list_from_profile(spark, sf_dir):
    from pickwise.operators.trips import trip_profile
    t = _t(spark, sf_dir)
    return stops.stop_list(t.trips, t.stop_times, t.stops, profile=trip_profile(t.stop_times, with_stops=True))
