"""Bundle tables (IO2-IO4) and the bundle loaders' joins.

All tables of all bundles live in one DataFrame per table with ``bundle`` as a
column -- on storage the partition column -- so a bundle filter becomes
partition pruning and every operator handles many bundles in one plan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables keyed by trip: clustered or bucketed on trip_id they meet without a shuffle.
TRIP_KEYED = ("trips", "stop_times")
# Tables written at a time.
WRITERS = 4
# Files that a task writes at a time before it sorts its rows by bundle.
OPEN_FILES, BUNDLE_FILES = "spark.sql.maxConcurrentOutputFileWriters", 8

TABLE_NAMES = ["bundle_dates", "calendar", "calendar_dates", "routes", "trips", "shapes",
               "shape_reference", "stops", "stop_times", "ridership"]

# Columns each operator family reads (projection kept explicit, as in IO2).
COLUMNS = {
    "bundle_dates": ["bundle", "service_date", "pick_year", "pick_name", "sched_type", "manual"],
    "calendar": ["bundle", "service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                 "saturday", "sunday", "start_date", "end_date"],
    "calendar_dates": ["bundle", "service_id", "date", "exception_type"],
    "routes": ["bundle", "route_id", "agency_id", "route_short_name", "route_long_name"],
    "trips": ["bundle", "route_id", "trip_id", "service_id", "trip_headsign", "direction_id",
              "block_id", "shape_id"],
    "shapes": ["bundle", "shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon"],
    "shape_reference": ["bundle", "stop_id", "revenue_stop"],
    "stops": ["bundle", "stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stop_times": ["bundle", "trip_id", "stop_id", "arrival_time", "departure_time", "timepoint",
                   "stop_sequence", "pickup_type", "drop_off_type"],
}


@dataclass(frozen=True)
class GtfsTables:
    """One DataFrame per GTFS table, every bundle in it."""

    bundle_dates: DataFrame | None = None
    calendar: DataFrame | None = None
    calendar_dates: DataFrame | None = None
    routes: DataFrame | None = None
    trips: DataFrame | None = None
    shapes: DataFrame | None = None
    shape_reference: DataFrame | None = None
    stops: DataFrame | None = None
    stop_times: DataFrame | None = None
    ridership: DataFrame | None = None

    def items(self):
        for f in fields(self):
            df = getattr(self, f.name)
            if df is not None:
                yield f.name, df

    def for_bundles(self, bundles) -> "GtfsTables":
        """Narrow every table to the given bundles (pushed to the scan)."""
        bundles = list(bundles)
        return replace(self, **{name: df.where(F.col("bundle").isin(bundles))
                                for name, df in self.items() if "bundle" in df.columns})


def load_tables(spark: SparkSession, root: str, bundles=None, names=None) -> GtfsTables:
    """Read tables stored as ``root/<table>`` Parquet datasets partitioned by bundle."""
    out = {}
    for name in names or TABLE_NAMES:
        try:
            out[name] = spark.read.parquet(f"{root}/{name}")
        except Exception as exc:  # a missing table stays None
            if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
                raise
    t = GtfsTables(**out)
    return t.for_bundles(bundles) if bundles is not None else t


def write_tables(tables: GtfsTables, root: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Write each table partitioned by bundle (the layout ``load_tables`` reads).

    ``overwrite`` replaces the bundles that ``tables`` hold and no others.
    ``files``: spread each table over about this many files so a scan has at
    least that many tasks. Only tables keyed by trip are moved for it: they
    keep each trip's rows in one file, as GTFS feeds list a trip's stop times
    together; the per-trip partial aggregate then collapses a trip before the
    shuffle. The others are written in files by size.
    """
    def write(name: str, df: DataFrame) -> None:
        if files:
            df = (df.repartition(files, "bundle", "trip_id") if name in TRIP_KEYED
                  else df.hint("rebalance"))
        w = df.write.mode(mode)
        if "bundle" in df.columns:
            w = w.partitionBy("bundle").option("partitionOverwriteMode", "dynamic")
        w.parquet(f"{root}/{name}")

    # a task keeps a file open for each of its first bundles, so rows aren't sorted by bundle (beyond them they are)
    spark = next((df.sparkSession for _, df in tables.items()), None)
    if spark is None:
        return
    was = spark.conf.get(OPEN_FILES)
    if was == "0":
        spark.conf.set(OPEN_FILES, str(BUNDLE_FILES))
    try:
        # independent jobs: the small tables fill the cores that a larger one leaves idle
        with ThreadPoolExecutor(WRITERS) as pool:
            for done in [pool.submit(write, name, df) for name, df in tables.items()]:
                done.result()
    finally:
        spark.conf.set(OPEN_FILES, was)


def save_bucketed_tables(tables: GtfsTables, root: str, prefix: str = "gtfs", buckets: int = 64,
                         mode: str = "overwrite") -> None:
    """Store the tables as catalog tables at ``root/<table>``, partitioned by
    bundle, with trips and stop_times bucketed (and sorted) on trip_id into the
    same number of buckets. The per-trip aggregate of stop_times and the
    trips-to-profile join then need no exchange: co-located by storage.
    """
    for name, df in tables.items():
        w = df.write.mode(mode).option("path", f"{root}/{name}")
        if "bundle" in df.columns:
            w = w.partitionBy("bundle")
        if name in TRIP_KEYED:
            w = w.bucketBy(buckets, "trip_id").sortBy("trip_id")
        w.saveAsTable(f"{prefix}_{name}")


def load_catalog_tables(spark: SparkSession, prefix: str = "gtfs", bundles=None) -> GtfsTables:
    """Read tables saved by ``save_bucketed_tables`` (bucket specs come from the catalog)."""
    out = {}
    for name in TABLE_NAMES:
        if spark.catalog.tableExists(f"{prefix}_{name}"):
            out[name] = spark.table(f"{prefix}_{name}")
    t = GtfsTables(**out)
    return t.for_bundles(bundles) if bundles is not None else t


def bundle_trips(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips with the agency of their route.

    Inner join with the distinct (route, agency) pairs of the bundle: a trip
    whose route has no routes row drops out, and a route listed under two
    agencies yields the trip twice (the loader's behaviour).
    """
    agency = routes.select("bundle", "route_id", "agency_id").distinct()
    return trips.join(agency, ["bundle", "route_id"], "inner")


def bundle_stops(stops: DataFrame, shape_reference: DataFrame) -> DataFrame:
    """Stops with the largest revenue flag referencing them (null if none)."""
    ref = shape_reference.groupBy("bundle", "stop_id").agg(F.max("revenue_stop").alias("revenue_stop"))
    return stops.join(ref, ["bundle", "stop_id"], "left")


def bundle_tables(tables: GtfsTables, bundles) -> GtfsTables:
    """The projected tables of the chosen bundles."""
    t = tables.for_bundles(bundles)
    return replace(t, **{name: df.select(*[c for c in COLUMNS[name] if c in df.columns])
                         for name, df in t.items() if name in COLUMNS})
