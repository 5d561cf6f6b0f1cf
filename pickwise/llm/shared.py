"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    and read it back. A lost executor then recomputes nothing above the cut,
    and the planner knows the measured size of what it joins. The folder goes
    when the application ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}-")
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def with_row(df: DataFrame, carry: bool, **columns: Column) -> DataFrame:
    """The given columns; with ``carry`` also ``row``, a struct of all input columns."""
    return df.select(*[c.alias(name) for name, c in columns.items()], *([F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []))


def row_schema(df: DataFrame, schema: str, carry: bool) -> T.StructType:
    """``schema``, with ``carry`` followed by the ``row`` of ``df``."""
    out = T.StructType.fromDDL(schema)
    return T.StructType([*out.fields, *([df.schema["row"]] if carry else [])])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text with A-Z lower-cased
    (``bytes`` methods touch ASCII alone, which is exactly that rule)."""
    return text.lower().split() if text else []


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The rows of a string or binary Arrow column as UTF-8 bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``rows`` rows and about ``size`` bytes (one row at least)."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() > size and _sliced_bytes(batch, at, n) > size:
                n = n // 2
            yield batch.slice(at, n)
            at += n


def _sliced_bytes(batch: pa.RecordBatch, at: int, n: int) -> int:
    return batch.slice(at, n).nbytes


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive runs of rows with an equal (non-null) ``key``, one table a
    run; the input is sorted by the key within the partition."""
    import numpy as np

    kept: list[pa.RecordBatch] = []
    kept_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if kept and keys[a] != kept_key:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(a, b - a))
            kept_key = keys[a]
    if kept:
        yield pa.Table.from_batches(kept)
