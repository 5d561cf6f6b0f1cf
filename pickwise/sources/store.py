"""A store of bundles: one version of a bundle's tables at a time is visible.

Layout: ``root/<table>/bundle=<b>/version=<v>/part-*.parquet`` and, for each
write of a bundle, one row of JSON in ``root/_manifests``. A write appends files
under a version of its own and lists that version in a manifest last, so

- other bundles' files are never touched, and nothing of this bundle is deleted;
- until the manifest row is there (Spark moves it in place in one piece, when all
  tables are written) readers see the version before; a write that breaks leaves
  files that no manifest names;
- of several writes of one bundle the one with the highest number counts.

Manifests carry each table's schema, row count and order-free checksum, taken
by observation while the table is written. Reading therefore needs no schema
inference, keeps bundle ids text (``2025`` doesn't become a number) and can be
verified. Old and unlisted versions stay until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.sources.tables import TABLE_NAMES, TRIP_KEYED, WRITERS, GtfsTables

MANIFESTS = "_manifests"
MANIFEST = "bundle string, number long, version string, tables array<struct<name: string, schema: string, n_rows: long, checksum: long>>"


def checksum(df: DataFrame) -> Column:
    """Aggregate over rows, in any order: equal for equal rows; null columns count."""
    columns = sorted(c for c in df.columns if c not in ("bundle", "version"))
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns]
    return F.coalesce(F.sum(F.xxhash64(*parts) % F.lit(1 << 31)), F.lit(0)).cast("long")


def manifests(spark: SparkSession, root: str, bundles: Iterable[str] | None = None) -> list[dict]:
    """The manifest that counts of every (or the given) bundle, by bundle id. Their
    number is that of the bundles."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/{MANIFESTS}")
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return []
    if bundles is not None:
        rows = rows.where(F.col("bundle").isin(list(bundles)))
    newest = rows.groupBy("bundle").agg(F.max(F.struct("number", "version", "tables")).alias("m")).select("bundle", "m.*")
    return [r.asDict(recursive=True) for r in newest.orderBy("bundle").collect()]


def write_bundle(tables: GtfsTables, root: str, bundle: str, files: int | None = None) -> dict:
    """Write the rows of ``bundle`` of every table as its new version; returns its manifest.

    A table without rows of the bundle is listed as empty; one that is None isn't
    listed, and so is gone from the bundle. Rows of other bundles in ``tables``
    aren't written. ``files``: as for ``write_tables``.
    """
    present = list(tables.items())
    spark = present[0][1].sparkSession
    version = uuid.uuid4().hex

    def write(name: str, df: DataFrame) -> dict:
        rows = df.where(F.col("bundle") == bundle).drop("bundle") if "bundle" in df.columns else df
        if files:
            rows = rows.repartition(files, "trip_id") if name in TRIP_KEYED else rows.hint("rebalance")
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), checksum(rows).alias("checksum")) \
            .write.mode("append").parquet(f"{root}/{name}/bundle={_escaped(bundle)}/version={version}")
        return {"name": name, "schema": rows.schema.json(), "n_rows": seen.get["n_rows"], "checksum": seen.get["checksum"]}

    # independent jobs: the small tables fill the cores that a larger one leaves idle
    with ThreadPoolExecutor(WRITERS) as pool:
        written = list(pool.map(lambda x: write(*x), present))
    number = max((m["number"] for m in manifests(spark, root, [bundle])), default=0) + 1
    manifest = {"bundle": bundle, "number": number, "version": version, "tables": written}
    spark.createDataFrame([manifest], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/{MANIFESTS}")
    return manifest


def _escaped(value: str) -> str:
    """A partition value as a folder name, as Spark writes and reads it."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\\x7F{[]^" or c < " " else c for c in value)


def write_bundles(tables: GtfsTables, root: str, bundles: Iterable[str], files: int | None = None) -> list[dict]:
    """``write_bundle`` for each of the bundles; each becomes visible by itself."""
    return [write_bundle(tables, root, b, files) for b in bundles]


def load_bundles(spark: SparkSession, root: str, bundles: Iterable[str] | None = None, names: Iterable[str] | None = None) -> GtfsTables:
    """The tables of every (or the given) bundle in the store.

    One DataFrame per table with ``bundle`` as its partition column; the versions
    that count are a partition filter, so no other folder is read. Columns that a
    bundle's table lacks are null. Tables that no bundle lists are None; bundles
    that aren't in the store have no rows.
    """
    found = manifests(spark, root, bundles)
    out: dict[str, DataFrame] = {}
    for name in names or TABLE_NAMES:
        listed = [(m, t) for m in found for t in m["tables"] if t["name"] == name]
        if not listed:
            continue
        fields: dict[str, T.StructField] = {}
        for _, t in listed:
            for f in T.StructType.fromJson(json.loads(t["schema"])).fields:
                if f.name in fields and fields[f.name].dataType != f.dataType:
                    raise ValueError(f"{name}.{f.name} is {fields[f.name].dataType.simpleString()} in one bundle and {f.dataType.simpleString()} in another")
                fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
        schema = T.StructType([*fields.values(), T.StructField("bundle", T.StringType()), T.StructField("version", T.StringType())])
        filled = [m for m, t in listed if t["n_rows"]]
        if not filled:
            out[name] = spark.createDataFrame([], schema).drop("version")
            continue
        visible = F.lit(False)
        for m in filled:
            visible = visible | ((F.col("bundle") == m["bundle"]) & (F.col("version") == m["version"]))
        out[name] = spark.read.schema(schema).parquet(f"{root}/{name}").where(visible).drop("version")
    return GtfsTables(**out)


def verify(spark: SparkSession, root: str, bundles: Iterable[str] | None = None) -> DataFrame:
    """(bundle, table_name, n_rows, listed_rows, intact): what is read of each listed
    table against its manifest, by row count and checksum. One aggregate per table."""
    found = manifests(spark, root, bundles)
    listed = spark.createDataFrame(
        [(m["bundle"], t["name"], t["n_rows"], t["checksum"]) for m in found for t in m["tables"]],
        "bundle string, table_name string, listed_rows long, listed_checksum long")
    read = spark.createDataFrame([], "bundle string, table_name string, n_rows long, checksum long")
    for name, df in load_bundles(spark, root, bundles).items():
        read = read.unionByName(df.groupBy("bundle").agg(F.count(F.lit(1)).alias("n_rows"), checksum(df).alias("checksum")).withColumn("table_name", F.lit(name)))
    none = F.lit(0).cast("long")
    j = listed.join(read, ["bundle", "table_name"], "left").withColumns({"n_rows": F.coalesce("n_rows", none), "checksum": F.coalesce("checksum", none)})
    return j.select("bundle", "table_name", "n_rows", "listed_rows", ((F.col("n_rows") == F.col("listed_rows")) & (F.col("checksum") == F.col("listed_checksum"))).alias("intact"))


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the version folders that no counting manifest names; returns their
    paths. Not to be run beside a write or a reader of an older version."""
    keep = {(m["bundle"], m["version"]) for m in manifests(spark, root)}
    names = {_escaped(b): b for b, _ in keep}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.globStatus(path(f"{root}/*/bundle=*/version=*")) or []:
        folder = status.getPath()
        bundle, version = folder.getParent().getName().removeprefix("bundle="), folder.getName().removeprefix("version=")
        if (names.get(bundle, bundle), version) not in keep:
            fs.delete(folder, True)
            gone.append(folder.toString())
    return gone
