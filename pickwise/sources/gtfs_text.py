"""Read and write GTFS text feeds (IO1).

Layout: ``root/<bundle>/<table>.txt``, each a text file or a folder of part
files. One job makes an index of all feeds' files: it reads the first line of
each, on the executors. Files of one table with equal headers are then one CSV
scan, whose columns are bound **by name** (GTFS column order is free) and
converted with ``try_cast``; declared columns that a feed lacks become typed
nulls, tables that no feed has become empty. The bundle is the file's folder.

What can't be taken over goes to a quarantine with bundle, file, table and
reason: rows with another number of fields than their header or without a key
(left out of the tables), and values that aren't of their column's type (null
in the tables).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.sources.tables import GtfsTables

# Declared column types of the GTFS text files.
TEXT_SCHEMAS = {
    "calendar": {"service_id": "string", "monday": "int", "tuesday": "int", "wednesday": "int",
                 "thursday": "int", "friday": "int", "saturday": "int", "sunday": "int",
                 "start_date": "int", "end_date": "int"},
    "calendar_dates": {"service_id": "string", "date": "int", "exception_type": "int"},
    "routes": {"route_id": "string", "agency_id": "string", "route_short_name": "string",
               "route_long_name": "string", "route_desc": "string", "route_type": "int", "route_url": "string",
               "route_color": "string", "route_text_color": "string", "exact_times": "int"},
    "shapes": {"shape_id": "string", "shape_pt_lat": "double", "shape_pt_lon": "double",
               "shape_pt_sequence": "int"},
    "stops": {"stop_id": "string", "stop_name": "string", "stop_lat": "double", "stop_lon": "double",
              "location_type": "int", "parent_station": "string"},
    "stop_times": {"trip_id": "string", "arrival_time": "string", "departure_time": "string",
                   "stop_id": "string", "stop_sequence": "int", "pickup_type": "int", "drop_off_type": "int",
                   "timepoint": "int"},
    "trips": {"route_id": "string", "service_id": "string", "trip_id": "string", "trip_headsign": "string",
              "direction_id": "int", "block_id": "string", "shape_id": "string"},
}
# Columns without which a row of the table means nothing.
TEXT_KEYS = {"calendar": ["service_id"], "calendar_dates": ["service_id", "date"], "routes": ["route_id"],
             "shapes": ["shape_id"], "stops": ["stop_id"], "stop_times": ["trip_id", "stop_id"], "trips": ["trip_id"]}

QUARANTINE = "bundle string, file string, table_name string, reason string, column_name string, value string"
WRONG_FIELDS, NO_KEY, WRONG_TYPE = "wrong number of fields", "no key", "not of its type"


@dataclass(frozen=True)
class Feeds:
    """Tables of text feeds, what couldn't be taken over, and the files read."""

    tables: GtfsTables
    quarantine: DataFrame
    index: list[dict]


def _split_bytes(spark: SparkSession) -> int:
    """Bytes of a whole split of a file."""
    n, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(n) << {"k": 10, "m": 20, "g": 30}.get(unit[:1], 0)


def _bundle_of(path: Column) -> Column:
    """The bundle of a file, from its (URL-encoded) path."""
    return _decoded(F.regexp_extract(path, r"/([^/]+)/[a-z_]+\.txt(/[^/]*)?$", 1))


def _decoded(path: Column) -> Column:
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def feed_index(spark: SparkSession, root: str, bundles=None, names=None) -> list[dict]:
    """bundle, table, file and header (column names) of each file of the feeds.

    One job over all files: a task that meets the start of a file hands on its
    first line, and stops at the first rows of a split that holds only the middle
    of a large file. The driver gets a row per file. Empty files aren't listed.
    """
    wanted = list(names or TEXT_SCHEMAS)
    meta = F.col("_metadata")
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(f"{root}/*/*.txt")
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return []
    split = _split_bytes(spark)
    lines = lines.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("at"), meta["file_block_length"].alias("size"), "value")
    table = F.regexp_extract("file", r"/([a-z_]+)\.txt(/[^/]*)?$", 1)
    bundle = _bundle_of(F.col("file"))
    lines = lines.where(table.isin(wanted))
    if bundles is not None:
        lines = lines.where(bundle.isin(list(bundles)))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            files, starts, sizes, values = (batch.column(i) for i in range(4))
            if batch.num_rows and starts[0].as_py() > 0 and sizes[0].as_py() >= split and files[0] == files[-1]:
                return  # a whole split of the middle of a file: nothing else is in this partition
            for file in files.unique().to_pylist():
                i = files.index(file).as_py()
                if file not in seen and starts[i].as_py() == 0:
                    yield pa.RecordBatch.from_pydict({"file": pa.array([file]), "line": values.slice(i, 1)})
                seen.add(file)

    found = lines.mapInArrow(first_lines, "file string, line string").select(_decoded(F.col("file")).alias("file"), "line", table.alias("table"), bundle.alias("bundle"))
    out = []
    for r in found.orderBy("bundle", "table", "file").collect():
        header = [c.strip() for c in next(csv.reader([(r["line"] or "").lstrip("\ufeff")]), [])]
        if any(header):
            out.append({"bundle": r["bundle"], "table": r["table"], "file": r["file"], "header": header})
    return out


def _scan(spark: SparkSession, name: str, header: list[str], files: list[dict]) -> DataFrame:
    """Rows of files with one header: bundle, _file, _bad (the line of a row with
    another number of fields) and the declared columns as text."""
    columns = [f"c{i}" for i in range(len(header))]
    raw = (spark.read.schema(", ".join(f"{c} string" for c in [*columns, "_bad"]))
           .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("escape", '"').option("recursiveFileLookup", True)
           .option("columnPruning", False)  # a row's fields are counted whatever is asked for
           .csv([re.sub(r"([\\*?\[\]{}])", r"\\\1", f["file"]) for f in files]))
    at = {c: columns[i] for i, c in reversed(list(enumerate(header)))}  # of a name listed twice, the first
    path = F.col("_metadata.file_path")
    declared = [(F.nullif(F.trim(at[c]), F.lit("")) if c in at else F.lit(None).cast("string")).alias(c) for c in TEXT_SCHEMAS[name]]
    return raw.select(_bundle_of(path).alias("bundle"), path.alias("_file"), "_bad", *declared)


def _typed(name: str):
    return [(F.col(c) if t == "string" else F.col(c).try_cast(t)).alias(c) for c, t in TEXT_SCHEMAS[name].items()]


def read_feeds(spark: SparkSession, root: str, bundles=None, names=None) -> Feeds:
    """The text tables of the feeds under ``root``, with their quarantine.

    Every feed may lack any table and any column. Nothing is scanned but for the
    index until a table or the quarantine is used.
    """
    index = feed_index(spark, root, bundles, names)
    tables, bad = {}, []
    for name in names or TEXT_SCHEMAS:
        by_header: dict[tuple, list[dict]] = {}
        for f in index:
            if f["table"] == name:
                by_header.setdefault(tuple(f["header"]), []).append(f)
        declared = ", ".join(["bundle string", *[f"{c} {t}" for c, t in TEXT_SCHEMAS[name].items()]])
        if not by_header:
            tables[name] = spark.createDataFrame([], declared)
            continue
        rows = reduce(DataFrame.unionByName, [_scan(spark, name, list(h), files) for h, files in by_header.items()])
        no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in TEXT_KEYS[name]])
        tables[name] = rows.where(F.col("_bad").isNull() & ~no_key).select("bundle", *_typed(name))
        entry = lambda reason, column, value: F.struct(F.lit(reason).alias("reason"), F.lit(column).cast("string").alias("column_name"), value.cast("string").alias("value"))
        values = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), entry(WRONG_TYPE, c, F.col(c))) for c, t in TEXT_SCHEMAS[name].items() if t != "string"]
        keys = [F.when(F.col(c).isNull(), entry(NO_KEY, c, F.lit(None))) for c in TEXT_KEYS[name]]
        found = F.when(F.col("_bad").isNotNull(), F.array(entry(WRONG_FIELDS, None, F.col("_bad")))).otherwise(F.array_compact(F.array(*keys, *values)))
        bad.append(rows.select("bundle", F.col("_file").alias("file"), F.lit(name).alias("table_name"), F.explode(found).alias("x")).select("bundle", "file", "table_name", "x.*"))
    quarantine = reduce(DataFrame.unionByName, bad) if bad else spark.createDataFrame([], QUARANTINE)
    return Feeds(GtfsTables(**tables), quarantine, index)


def read_gtfs_table(spark: SparkSession, root: str, name: str, bundles=None) -> DataFrame:
    """One GTFS table of every (or the given) bundle under ``root``."""
    return getattr(read_feeds(spark, root, bundles, [name]).tables, name)


def read_gtfs_feeds(spark: SparkSession, root: str, bundles=None, names=None) -> GtfsTables:
    """All text tables of the feeds under ``root`` as bundle-keyed DataFrames."""
    return read_feeds(spark, root, bundles, names).tables


def write_feed(tables: GtfsTables, root: str, bundle: str, names=None, columns: dict[str, list[str]] | None = None) -> None:
    """Write a bundle's tables as a text feed, ``root/<bundle>/<table>.txt`` (a
    folder of part files, each with the header). ``columns``: order (and choice) of
    a table's columns; nulls become empty fields. Only text tables are written."""
    for name, df in tables.items():
        if name not in TEXT_SCHEMAS or names is not None and name not in names:
            continue
        chosen = (columns or {}).get(name, [c for c in TEXT_SCHEMAS[name] if c in df.columns])
        rows = df.where(F.col("bundle") == bundle).select(*chosen)
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{root}/{bundle}/{name}.txt")
