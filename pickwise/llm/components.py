"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    out = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return out.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v; longs) but the roots
    themselves; ``root`` is the smallest node reachable.

    Every round is a set of aggregations and equality joins (a hub's many
    edges are pre-aggregated, and its join partition can be split) written to
    the shared folder. Rounds end when the edge set stays the same; only its
    row count and checksum reach the driver. Loops and repeated edges are
    harmless; no edges give no rows.
    """
    now = stored(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(mark)
        now = stored(_small_star(_large_star(now)), "edges")
