"""Shared track of two variants, partly overlapping segments included.

``similarity.sim_shape`` credits whole stop-to-stop segments that both lines
have. Here lines are compared as point sets: segments on one supporting line
are merged to intervals per variant, and the intervals of two variants on the
same supporting line are intersected. A stretch that one variant runs without
stopping where the other stops twice counts in full; a stretch that a variant
runs twice counts once.

Coordinates are taken as whole microdegrees, so that whether two segments lie
on one line is decided by equal keys: slope and intercept over the steeper
axis, each one correctly rounded quotient of integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.operators.matching import PAIR_KEY

MICRO = 1_000_000
LINE = ["steep", "slope", "intercept"]


def line_intervals(vt: DataFrame) -> DataFrame:
    """(bundle, route_id, direction_id, daytype, shape_id, steep, slope,
    intercept, lo, hi): the disjoint intervals of each variant on each
    supporting line, in microdegrees of longitude (of latitude where ``steep``).

    ``vt`` has ``segments`` as of ``variants.variant_stop_pattern``. Variants
    without segments (null or empty) and segments without length give no rows.
    """
    key = ["bundle", *PAIR_KEY, "shape_id"]
    s = vt.select(*key, F.explode("segments").alias("s"))

    def micro(end: str, axis: str):
        return F.round(F.col(f"s.{end}.{axis}") * MICRO).cast("long")

    s = s.select(*key, micro("a", "lon").alias("ax"), micro("a", "lat").alias("ay"), micro("b", "lon").alias("bx"), micro("b", "lat").alias("by"))
    steep = F.abs(F.col("by") - F.col("ay")) > F.abs(F.col("bx") - F.col("ax"))
    s = s.where("ax <> bx or ay <> by").select(
        *key, steep.alias("steep"), *[F.when(steep, F.col(b)).otherwise(F.col(a)).alias(n) for n, a, b in (("u1", "ax", "ay"), ("v1", "ay", "ax"), ("u2", "bx", "by"), ("v2", "by", "bx"))])
    du, dv = F.col("u2") - F.col("u1"), F.col("v2") - F.col("v1")
    # a zero of either sign is one slope
    s = s.select(*key, "steep", (dv / du + F.lit(0.0)).alias("slope"), ((F.col("v1") * du - F.col("u1") * dv) / du + F.lit(0.0)).alias("intercept"),
                 F.least("u1", "u2").alias("lo"), F.greatest("u1", "u2").alias("hi"))
    on = Window.partitionBy(*key, *LINE).orderBy("lo", "hi")
    before = F.max("hi").over(on.rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("starts", F.when(F.col("lo") <= before, F.lit(0)).otherwise(F.lit(1)))
    s = s.withColumn("part", F.sum("starts").over(on.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return s.groupBy(*key, *LINE, "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("part")


def _degrees(lo, hi):
    """Length in degrees of an interval on its line."""
    return (hi - lo) / MICRO * F.sqrt(F.lit(1.0) + F.col("slope") * F.col("slope"))


def shared_track(vt: DataFrame, bundle_a: str, bundle_b: str) -> DataFrame:
    """Candidate pairs (same route, direction and daytype) that share track:
    PAIR_KEY, shape_id_a, shape_id_b, shared, length_a, length_b (degrees) and
    shape_similarity = shared / (length_a + length_b - shared).

    One equi-join on group and supporting line, an inverted index of track:
    pairs without a common line form no row, a line's intervals are disjoint
    within a variant, and a pair's rows are folded where the join makes them.
    Pairs not returned share nothing (similarity 0). A null direction matches
    a null direction.
    """
    pieces = line_intervals(vt).withColumn("length", _degrees(F.col("lo"), F.col("hi")))

    def side(bundle, sfx):
        return pieces.where(F.col("bundle") == bundle).select(*[F.col(c).alias(f"{c}_{sfx}") for c in [*PAIR_KEY, "shape_id", *LINE, "lo", "hi"]])

    a, b = side(bundle_a, "a"), side(bundle_b, "b")
    cond = a["direction_id_a"].eqNullSafe(b["direction_id_b"]) & (a["lo_a"] < b["hi_b"]) & (b["lo_b"] < a["hi_a"])
    for c in ["route_id", "daytype", *LINE]:
        cond = cond & (a[f"{c}_a"] == b[f"{c}_b"])
    met = a.join(b, cond).withColumn("slope", F.col("slope_a"))
    met = met.select(*[F.col(f"{c}_a").alias(c) for c in PAIR_KEY], "shape_id_a", "shape_id_b",
                     _degrees(F.greatest("lo_a", "lo_b"), F.least("hi_a", "hi_b")).alias("shared"))
    met = met.groupBy(*PAIR_KEY, "shape_id_a", "shape_id_b").agg(F.sum("shared").alias("shared"))
    lengths = pieces.groupBy("bundle", *PAIR_KEY, "shape_id").agg(F.sum("length").alias("length"))

    def with_length(df, bundle, sfx):
        of = lengths.where(F.col("bundle") == bundle).select(*PAIR_KEY, F.col("shape_id").alias(f"shape_id_{sfx}"), F.col("length").alias(f"length_{sfx}")).alias("y")
        same = F.col(f"x.shape_id_{sfx}") == F.col(f"y.shape_id_{sfx}")
        for k in PAIR_KEY:
            same = same & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
        return df.alias("x").join(of, same).select("x.*", f"y.length_{sfx}")

    out = with_length(with_length(met, bundle_a, "a"), bundle_b, "b")
    return out.withColumn("shape_similarity", F.col("shared") / (F.col("length_a") + F.col("length_b") - F.col("shared")))
