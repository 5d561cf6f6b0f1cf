"""Writers (IO5, IO8). Results stay DataFrames until a sink writes them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# Reading options under which a written CSV comes back as it was: quotes doubled, text of several lines, no trimming. A null is
# written as nothing and empty text as two quotes; nothing reads as ``nullValue``, which therefore mustn't be empty.
CSV = {"header": True, "escape": '"', "multiLine": True, "enforceSchema": False, "nullValue": "\u0000null\u0000"}


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by=None, order_by=None, fill_empty: bool = False) -> None:
    """Write a result.

    ``order_by`` sorts at the sink only (range-partitioned, no single task);
    ``fill_empty`` writes nulls of string columns as empty text, as the CSV
    reports do.
    """
    _save(_ready(df, order_by, fill_empty), path, fmt, mode, partition_by)


def _ready(df: DataFrame, order_by, fill_empty: bool) -> DataFrame:
    if fill_empty:
        df = df.fillna("", subset=[f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return df.orderBy(*order_by) if order_by else df


def _save(out: DataFrame, path: str, fmt: str, mode: str, partition_by) -> None:
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        w.format(fmt).save(path)


def with_bundle_titles(df: DataFrame, bundle_a: str, bundle_b: str) -> DataFrame:
    """Carry the compared bundle ids as columns (the report's titles)."""
    return df.select(F.lit(bundle_a).alias("bundle_b1"), F.lit(bundle_b).alias("bundle_b2"), "*")


@dataclass(frozen=True)
class Receipt:
    """What a checked sink wrote and read back. ``disorder``: neighbouring rows
    of the files, in the order of the files, that are in the wrong order."""

    path: str
    fmt: str
    rows_written: int
    rows_read: int
    same_rows: bool
    disorder: int

    @property
    def good(self) -> bool:
        return self.rows_written == self.rows_read and self.same_rows and self.disorder == 0


class SinkError(RuntimeError):
    """What was read back isn't what was written."""


def _print(columns: list[str]) -> list[Column]:
    """Row count and a sum of row hashes that doesn't depend on their order. Nulls count by their column."""
    of_row = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(of_row.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("print")]


def read_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The dataset at ``path`` with the columns and types of ``df``, in its order of columns."""
    reader = df.sparkSession.read.schema(df.schema)
    back = reader.options(**CSV).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return back.select(*df.columns)


def _disorder(df: DataFrame, path: str, fmt: str, order_by: list[str]) -> int:
    """Neighbours in the wrong order, nulls first as they are sorted: within a
    file's blocks by row, then between the blocks of a folder. A window holds a
    block, which one task reads, or one row a block."""
    reader = df.sparkSession.read.schema(df.schema)
    back = reader.options(**CSV).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    file = F.col("_metadata.file_path")
    rows = back.select(F.struct(*order_by).alias("key"), F.regexp_extract(file, "^(.*)/[^/]*$", 1).alias("folder"), file.alias("file"),
                       F.regexp_extract(file, "part-([0-9]+)", 1).cast("long").alias("part"),
                       F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    block = ["folder", "part", "file", "block"]
    within = Window.partitionBy(*block).orderBy("row")
    rows = rows.withColumn("wrong", F.lag("key").over(within) > F.col("key"))
    blocks = rows.groupBy(*block).agg(F.count(F.when(F.col("wrong"), 1)).alias("wrong"), F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    between = Window.partitionBy("folder").orderBy("part", "file", "block")
    blocks = blocks.withColumn("gap", F.when(F.lag("last").over(between) > F.col("first"), 1).otherwise(0))
    return blocks.agg(F.coalesce(F.sum(F.col("wrong") + F.col("gap")), F.lit(0)).alias("n")).first()["n"]


def write_checked(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None,
                  order_by=None, fill_empty: bool = False) -> Receipt:
    """``write_dataset``, then read back and held against what was written.

    Rows and a hash of them are counted in the pass that writes, and again
    over the files; with ``order_by`` (column names, ascending) the files are
    also checked to be sorted from the first to the last (within each folder of
    ``partition_by``, whose columns are sorted first). Raises ``SinkError`` where
    they differ. ``mode`` is ``overwrite`` or ``errorifexists``: what an append
    finds there isn't known.

    An empty table, empty text, nulls, quotes and line ends come back as they
    are. CSV has no types for arrays, maps and structs, and Spark refuses them.
    """
    if mode == "append":
        raise ValueError("a checked sink can't tell its rows from those already there")
    order = list(order_by or [])
    if partition_by and order:
        order = [*partition_by, *[c for c in order if c not in partition_by]]
    out = _ready(df, order, fill_empty)
    seen = Observation()
    _save(out.observe(seen, *_print(df.columns)), path, fmt, mode, partition_by)
    wrote = seen.get
    back = read_dataset(out, path, fmt).agg(*_print(df.columns)).first()
    receipt = Receipt(path, fmt, wrote["n"], back["n"], wrote["print"] == back["print"], _disorder(out, path, fmt, order) if order else 0)
    if not receipt.good:
        raise SinkError(f"{receipt}")
    return receipt
