"""Map the driver's star-schema test tables onto GTFS-shaped bundle tables.

The rules are written twice -- here with the DataFrame API and in
``pickwise.plans.oracle.FIXTURE_SQL`` as SQL for DuckDB -- and must stay
identical. Only integer arithmetic and string functions are used so the two
engines agree. Two picks: ``pick_a`` (even order keys, 1996) and ``pick_b``
(odd order keys, 2000).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from pickwise.functions.dates import date_to_int, idiv
from pickwise.operators.ridership import OVERRIDE_RULES, RENAME_RULES
from pickwise.sources.tables import GtfsTables

PICK_A, PICK_B = "pick_a", "pick_b"

# Calendar of the fixture (service -> day flags Mon..Sun) and
# each pick's date range as published (19960231 is deliberately impossible).
SERVICE_DAYS = {
    "S1": (1, 1, 1, 1, 1, 0, 0),
    "S2": (1, 1, 1, 1, 0, 0, 0),
    "S3": (0, 0, 0, 0, 0, 1, 0),
    "S4": (0, 0, 0, 0, 0, 0, 1),
    "S5": (1, 1, 1, 1, 1, 1, 1),
}
PICK_RANGE = {PICK_A: (19960105, 19960231), PICK_B: (20000101, 20000331)}
PICK_YEAR = {PICK_A: 1996, PICK_B: 2000}
# Ridership reference period of the fixture: months 9-12 of 2000.
REFERENCE_YEAR, REFERENCE_MONTHS = "2000", ("9", "10", "11", "12")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a star table; timestamps become their stored wall clock
    (``timestamp_ntz``) whatever the session's time zone or inference mode."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tz = spark.conf.get("spark.sql.session.timeZone")
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):  # read as instants: take the UTC wall clock
            df = df.withColumn(f.name, F.to_utc_timestamp(f.name, tz).cast("timestamp_ntz"))
    return df


def _two_digits(c):
    return F.when(c < 10, F.concat(F.lit("0"), c.cast("string"))).otherwise(c.cast("string"))


def _base(spark, sf_dir) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ok = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(ok.alias("ok"), F.col("o_custkey").alias("ck"), F.col("c_nationkey").alias("nk"),
                    "n_name", "o_orderdate", "o_orderpriority",
                    F.when(ok % 2 == 0, F.lit(PICK_A)).otherwise(F.lit(PICK_B)).alias("bundle"),
                    (idiv(ok, 2) % 2).alias("direction_id"),
                    F.when(ok % 97 == 5, F.lit(9).cast("long")).otherwise(F.col("o_custkey") % 3).alias("pat")))


def _trips(base: DataFrame) -> DataFrame:
    b, nk, ok = F.col("bundle"), F.col("nk"), F.col("ok")
    kept = base.where(~(((b == PICK_B) & (nk == 24)) | ((b == PICK_A) & (nk == 23))))
    return kept.select(
        "bundle",
        F.concat(F.lit("R"), nk.cast("string")).alias("route_id"),
        F.concat(F.lit("T"), ok.cast("string")).alias("trip_id"),
        F.concat(F.lit("S"), F.substring("o_orderpriority", 1, 1)).alias("service_id"),
        F.when((F.col("pat") == 2) & (nk % 2 == 0), F.concat("n_name", F.lit(" LTD")))
         .otherwise(F.col("n_name")).alias("trip_headsign"),
        "direction_id",
        F.concat(F.lit("B"), F.col("ck").cast("string")).alias("block_id"),
        F.when(ok % 211 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("R"), nk.cast("string"), F.lit("_"), F.col("direction_id").cast("string"),
                             F.lit("_"), F.col("pat").cast("string"))).alias("shape_id"),
    )


def _timed(visits: DataFrame) -> DataFrame:
    """Visits (an order's columns and ``seq``) with the minute and the stop."""
    ok, nk, seq, pat = F.col("ok"), F.col("nk"), F.col("seq"), F.col("pat")
    shift = F.when((F.col("bundle") == PICK_B) & (nk % 5 == 0), F.lit(1)).otherwise(F.lit(0))
    sm = F.when(nk % 4 == 1, 420 + (ok * 7) % 110).otherwise((ok * 37) % 1560)
    return (visits.withColumn("arr_min", sm + (seq - 1) * (5 + ok % 4))
            .withColumn("stop_key", idiv(F.col("ck"), 100) * 100 + (nk * 4 + seq * (1 + pat) + shift) % 100))


def _visits(spark, sf_dir, base: DataFrame) -> DataFrame:
    """A row per line item of each order. Lines of an order differ in ``seq`` alone
    (1 to their number), so they are counted before they meet the order."""
    n = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("n"))
    orders = base.select("ok", "ck", "nk", "bundle", "direction_id", "pat")
    return _timed(orders.join(n, F.col("l_orderkey") == F.col("ok")).withColumn("seq", F.explode(F.sequence(F.lit(1), "n"))))


def _lines(spark, sf_dir, base: DataFrame) -> DataFrame:
    """The visits with what their line item holds."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_shipdate")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_shipdate")
    li = li.withColumn("seq", F.row_number().over(w)).drop("l_linenumber", "l_partkey", "l_suppkey")
    orders = base.select("ok", "ck", "nk", "bundle", "direction_id", "pat")
    return _timed(li.join(orders, F.col("l_orderkey") == F.col("ok")))


def _clock(minutes):
    return F.concat(_two_digits(idiv(minutes, 60)), F.lit(":"), _two_digits(minutes % 60), F.lit(":00"))


def _stop_times(visits: DataFrame) -> DataFrame:
    ok, seq = F.col("ok"), F.col("seq")
    clock = _clock(F.col("arr_min"))
    return visits.select(
        "bundle",
        F.concat(F.lit("T"), ok.cast("string")).alias("trip_id"),
        F.concat(F.lit("ST"), F.lpad(F.col("stop_key").cast("string"), 9, "0")).alias("stop_id"),
        F.when((seq == 1) & (ok % 89 == 0), F.lit(None).cast("string")).otherwise(clock).alias("arrival_time"),
        clock.alias("departure_time"),
        F.when(seq == 1, F.lit(1)).otherwise(F.lit(0)).alias("timepoint"),
        seq.cast("int").alias("stop_sequence"),
        F.lit(0).alias("pickup_type"),
        F.lit(0).alias("drop_off_type"),
    )


def _per_bundle(df: DataFrame) -> DataFrame:
    return df.withColumn("bundle", F.lit(PICK_A)).unionByName(df.withColumn("bundle", F.lit(PICK_B)))


def _stop_parts(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "part").select("p_partkey", "p_name")


def _stops(parts: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    s = parts.select(
        F.concat(F.lit("ST"), F.lpad(k.cast("string"), 9, "0")).alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        F.when(k == 98, F.lit(None).cast("double")).otherwise(F.lit(40.5) + (k * 37 % 100) / 250).alias("stop_lat"),
        (F.lit(-74.2) + (k * 61 % 100) / 200).alias("stop_lon"),
    )
    return _per_bundle(s)


def _shape_reference(parts: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    sid = F.concat(F.lit("ST"), F.lpad(k.cast("string"), 9, "0")).alias("stop_id")
    kept = parts.where(k % 7 != 0)
    one = kept.select(sid, (k % 2).cast("int").alias("revenue_stop"))
    two = kept.where(k % 10 == 0).select(sid, F.lit(1).alias("revenue_stop"))
    return _per_bundle(one.unionByName(two))


def _calendar(trips: DataFrame) -> DataFrame:
    sid = F.col("service_id")
    flags = {}
    for i, day in enumerate(["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]):
        e = None
        for s, days in SERVICE_DAYS.items():
            e = F.when(sid == s, F.lit(days[i])) if e is None else e.when(sid == s, F.lit(days[i]))
        flags[day] = e.otherwise(F.lit(0))
    b = F.col("bundle")
    return (trips.select("bundle", "service_id").distinct()
            .select("bundle", "service_id", *[v.alias(k) for k, v in flags.items()],
                    F.when(b == PICK_A, F.lit(PICK_RANGE[PICK_A][0])).otherwise(F.lit(PICK_RANGE[PICK_B][0])).alias("start_date"),
                    F.when(b == PICK_A, F.lit(PICK_RANGE[PICK_A][1])).otherwise(F.lit(PICK_RANGE[PICK_B][1])).alias("end_date")))


def _bundle_dates(base: DataFrame) -> DataFrame:
    d = F.to_date(F.col("o_orderdate"))
    y = F.year(d)
    return (base.select(d.alias("service_date"))
            .where(F.month("service_date").between(1, 3) & F.year("service_date").isin(1996, 2000))
            .distinct()
            .select(F.when(F.year("service_date") == 1996, F.lit(PICK_A)).otherwise(F.lit(PICK_B)).alias("bundle"),
                    "service_date",
                    F.year("service_date").alias("pick_year"),
                    F.lit("Winter").alias("pick_name"),
                    F.lit("scheduled").alias("sched_type"),
                    F.lit(False).alias("manual")))


def _calendar_dates(bundle_dates: DataFrame) -> DataFrame:
    day = F.dayofmonth("service_date")
    return (bundle_dates.where((day % 9 == 4) | (day % 9 == 7))
            .select("bundle",
                    F.when(day % 9 == 4, F.lit("S1")).otherwise(F.lit("S3")).alias("service_id"),
                    date_to_int("service_date").alias("date"),
                    F.when(day % 9 == 4, F.lit(2)).otherwise(F.lit(1)).alias("exception_type")))


def _routes(trips: DataFrame, base: DataFrame) -> DataFrame:
    names = base.select(F.concat(F.lit("R"), F.col("nk").cast("string")).alias("route_id"), "nk", "n_name").distinct()
    return (trips.select("bundle", "route_id").distinct()
            .join(names, "route_id")
            .where(F.col("nk") != 22)
            .select("bundle", "route_id",
                    F.concat(F.lit("AG"), (F.col("nk") % 3).cast("string")).alias("agency_id"),
                    F.col("route_id").alias("route_short_name"),
                    F.col("n_name").alias("route_long_name")))


def _rule_cases(spark: SparkSession) -> tuple[DataFrame, int]:
    """One row per rule of the ridership repair and stop name it lists: what a
    ridership row needs to meet that rule."""
    def text(v) -> str:
        return "CAST(NULL AS STRING)" if v is None else f"'{v}'"

    def first(values):
        return values[0] if values else None

    rows = [(name, None if kind == 0 else r.value, first(r.route_names), first(r.routes), r.milepost)
            for kind, rules in enumerate((OVERRIDE_RULES, RENAME_RULES)) for r in rules for name in r.stop_names]
    values = ", ".join(f"({j}L, {text(stop)}, {text(new)}, {text(rn)}, {text(route)}, CAST({'NULL' if at is None else repr(at)} AS DOUBLE))"
                       for j, (stop, new, rn, route, at) in enumerate(rows))
    return spark.sql(f"SELECT * FROM VALUES {values} AS c(j, case_stop, case_new, case_route_name, case_route, case_at)"), len(rows)


def _ridership(spark: SparkSession, lines: DataFrame, parts: DataFrame) -> DataFrame:
    ok, seq = F.col("ok"), F.col("seq")
    year = F.year("l_shipdate").cast("string")
    month = F.month("l_shipdate").cast("string")
    in_ref = (year == REFERENCE_YEAR) & month.isin(*REFERENCE_MONTHS)
    dir_ = F.when(F.col("direction_id") == 0, F.lit("N")).otherwise(F.lit("S"))
    route = F.concat(F.lit("R"), F.col("nk").cast("string"))
    stop_id = F.concat(F.lit("ST"), F.lpad(F.col("stop_key").cast("string"), 9, "0"))
    cases, n = _rule_cases(spark)
    # every fifth order meets a rule of the repair
    named = lines.withColumn("_case", F.when(ok % 5 == 0, idiv(ok, 5) % n))
    named = named.join(cases, F.col("_case") == F.col("j"), "left").join(parts, F.col("stop_key") == F.col("p_partkey"), "left")
    plain = F.concat(F.coalesce("p_name", stop_id), F.when(~in_ref & ((ok + seq) % 11 == 0), F.lit(" (Local)")).otherwise(F.lit("")))
    return named.select(
        F.when(ok % 13 == 0, F.lit("0"))
         .when(~in_ref & ((ok % 7 == 0) | F.col("case_new").isNotNull()), F.lit(None).cast("string"))
         .otherwise(F.concat(stop_id, dir_)).alias("gtfsid"),
        F.concat(F.lit("RUN"), year, F.lit("-"), month).alias("ridership_run_id"),
        year.alias("run_year"),
        month.alias("run_month"),
        F.when(F.weekday("l_shipdate") >= 5, F.lit(1)).otherwise(F.lit(0)).alias("weekend"),
        (idiv(F.col("arr_min"), 60) % 24).alias("hour"),
        F.coalesce("case_route_name", F.concat(route, F.lit(".."), dir_)).alias("route_name"),
        F.coalesce("case_route", route).alias("route"),
        dir_.alias("dir"),
        F.when(F.col("case_stop").isNull(), plain).when(in_ref, F.coalesce("case_new", "case_stop"))
         .otherwise(F.col("case_stop")).alias("stop_name"),
        F.concat(route, F.lit(":"), stop_id).alias("lookup"),
        F.coalesce("case_at", seq * 1.5).alias("milepost"),
        F.col("l_quantity").alias("ons"),
        F.col("l_discount").alias("offs"),
        F.col("l_extendedprice").alias("volume"),
        F.col("l_tax").alias("md_trips"),
        F.col("l_quantity").alias("capacity"),
        F.col("l_discount").alias("vc"),
    )


def star_to_gtfs(spark: SparkSession, sf_dir: str) -> GtfsTables:
    """Every GTFS-shaped table of both picks from the star tables at ``sf_dir``. What
    all tables of orders are made of is stored; a table is computed where it is used."""
    from pickwise.plans.materialize import materialize

    base = materialize(_base(spark, sf_dir))
    trips = _trips(base)
    parts = _stop_parts(spark, sf_dir)
    bundle_dates = _bundle_dates(base)
    return GtfsTables(
        bundle_dates=bundle_dates,
        calendar=_calendar(trips),
        calendar_dates=_calendar_dates(bundle_dates),
        routes=_routes(trips, base),
        trips=trips,
        shapes=None,
        shape_reference=_shape_reference(parts),
        stops=_stops(parts),
        stop_times=_stop_times(_visits(spark, sf_dir, base)),
        ridership=_ridership(spark, _lines(spark, sf_dir, base), parts),
    )


def fixture_rename_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-derived rename rules for the fixture: ``<name> (Local)`` -> ``<name>``."""
    parts = _stop_parts(spark, sf_dir)
    return (parts.select(F.concat("p_name", F.lit(" (Local)")).alias("stop_name"),
                         F.col("p_name").alias("new_name"))
            .distinct()
            .select(F.lit(1000).alias("priority"), "stop_name",
                    F.lit(None).cast("array<string>").alias("routes_in"),
                    F.lit(None).cast("array<string>").alias("routes_not_in"), "new_name"))


def fixture_override_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-derived override rules, over two for each part: by milepost within the
    default tolerance, by route, and for every fifth part a wide one that goes first."""
    k, name = F.col("p_partkey"), F.col("p_name")
    none, number = F.lit(None).cast("array<string>"), F.lit(None).cast("double")
    route = lambda c: F.concat(F.lit("R"), c.cast("string"))

    def rules(parts, priority, names, routes, routes_not, milepost, tolerance, letter):
        return parts.select(priority.cast("long").alias("priority"), names.alias("stop_names"), none.alias("route_names"), routes.alias("routes"), routes_not.alias("routes_not"),
                            milepost.cast("double").alias("milepost"), tolerance.cast("double").alias("tolerance"), F.concat(F.lit(letter), k.cast("string")).alias("value"))

    parts = _stop_parts(spark, sf_dir)
    by_post = rules(parts, k * 3, F.array(name), none, none, F.lit(0.02) + (k % 6 + 1) * 1.5, number, "M")
    by_route = rules(parts, k * 3 + 1, F.array(name), F.array(route(k % 25), route((k + 1) % 25)), none, number, number, "Q")
    wide = rules(parts.where(k % 5 == 0), k - 1_000_000, F.array(name, F.concat(name, F.lit(" (Local)"))), none, F.array(route(k % 3)), F.lit(3.0), F.lit(1.6), "W")
    return by_post.unionByName(by_route).unionByName(wide)
