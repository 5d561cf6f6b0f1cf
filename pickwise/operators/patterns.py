"""The pattern dictionary: trips folded to their distinct ordered stop sequences.

A published schedule has hundreds of trips for each sequence of stops. One hash
aggregate of stop_times gives each trip's profile and, beside it, a 128-bit print
of its (stop_sequence, stop_id) rows: two sums of independent row hashes, which
no order of rows changes and every partial aggregate adds up. Trips of equal
print and row count are one pattern; only one trip of each meets stop_times
again, to spell the pattern out. What is asked of stops is then asked of
patterns: a stop list joins each (route, direction, pattern) once instead of
every stop time.

``verify`` holds every trip's rows against its pattern's, exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.operators.trips import profile_aggregates, with_minutes
from pickwise.plans.materialize import materialize

PATTERN = ["bundle", "print_a", "print_b", "stop_rows"]


@dataclass(frozen=True)
class Patterns:
    """``trips``: a row per trip, the profile and its pattern's PATTERN columns;
    ``stops``: the patterns spelled out (PATTERN columns, stop_sequence, stop_id)."""

    trips: DataFrame
    stops: DataFrame

    def sizes(self) -> DataFrame:
        """Trips, patterns, stop times and pattern rows by bundle."""
        counts = [F.count(F.lit(1)).alias("n_trips"), F.sum("stop_rows").cast("long").alias("n_stop_times")]
        per = self.trips.groupBy("bundle").agg(*counts)
        own = (self.trips.groupBy(*PATTERN).agg(F.count(F.lit(1)).alias("n")).groupBy("bundle")
               .agg(F.count(F.lit(1)).alias("n_patterns"), F.sum("stop_rows").cast("long").alias("n_pattern_rows"), F.max("n").alias("most_trips")))
        return per.join(own, "bundle")


def _row_hash(seed: int) -> Column:
    """Hash of a row's place and stop; nulls are values of their own."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col("stop_sequence").cast("long"), F.lit(-(1 << 40))), F.col("stop_id").isNull(), F.col("stop_id"))


def trip_patterns(stop_times: DataFrame) -> DataFrame:
    """One row per (bundle, trip_id): ``trip_profile`` and the print of the trip's
    stops. Buffers are of fixed width: a hash aggregate, which sorts nothing."""
    # sums of 31-bit parts can't overflow; four of them make the print
    parts = {"a": F.shiftrightunsigned(F.col("_h1"), 33), "b": F.col("_h1").bitwiseAND(F.lit((1 << 31) - 1)),
             "c": F.shiftrightunsigned(F.col("_h2"), 33), "d": F.col("_h2").bitwiseAND(F.lit((1 << 31) - 1))}
    g = (with_minutes(stop_times).withColumns({"_h1": _row_hash(1), "_h2": _row_hash(2)})
         .groupBy("bundle", "trip_id").agg(*profile_aggregates(), *[F.sum(v).alias(f"_{k}") for k, v in parts.items()]))
    return g.withColumns({"print_a": F.xxhash64("_a", "_b"), "print_b": F.xxhash64("_c", "_d", F.lit(7))}).drop("_a", "_b", "_c", "_d")


def fold(stop_times: DataFrame) -> Patterns:
    """Fold the trips of stop_times. Runs a job for the trips' table; the
    dictionary is lazy.

    The trip that spells a pattern out is the one of the smallest id hash. Rows
    of stop_times without a trip id are one trip without an id.
    """
    trips = materialize(trip_patterns(stop_times))
    key = F.xxhash64("trip_id")
    least = trips.groupBy(*PATTERN).agg(F.min(key).alias("_key"))
    chosen = trips.withColumn("_key", key).join(least, [*PATTERN, "_key"]).select(*PATTERN, "trip_id").dropDuplicates(PATTERN)
    st = stop_times.select(F.col("bundle").alias("_b"), F.col("trip_id").alias("_t"), "stop_sequence", "stop_id")
    stops = st.join(chosen, (F.col("_b") == F.col("bundle")) & F.col("_t").eqNullSafe(F.col("trip_id")))
    return Patterns(trips, stops.select(*PATTERN, "stop_sequence", "stop_id"))


def verify(patterns: Patterns, stop_times: DataFrame) -> DataFrame:
    """Trips (bundle, trip_id) whose rows aren't those of their pattern; none, but
    for two sequences of one print. Rows are counted on both sides, so repeats tell."""
    def counted(df: DataFrame, key: list[str]) -> DataFrame:
        return df.groupBy(*key, "stop_sequence", "stop_id").agg(F.count(F.lit(1)).alias("n"))

    st = stop_times.select(F.col("bundle").alias("_b"), F.col("trip_id").alias("_t"), "stop_sequence", "stop_id")
    own = st.join(patterns.trips.select(*PATTERN, "trip_id"), (F.col("_b") == F.col("bundle")) & F.col("_t").eqNullSafe(F.col("trip_id"))).drop("_b", "_t")
    own = counted(own, [*PATTERN, "trip_id"])
    said = counted(patterns.stops, PATTERN)
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*PATTERN, "n")] + [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("stop_sequence", "stop_id")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    # equal totals are part of the key, so rows that all fit leave none over on the other side
    return own.alias("x").join(said.alias("y"), cond, "left_anti").select("bundle", "trip_id").distinct()


def stop_list_of_patterns(trips: DataFrame, patterns: Patterns, stops: DataFrame) -> DataFrame:
    """C20 from patterns: the result of ``stops.stop_list``, one join row for each
    route, direction and pattern instead of each stop time."""
    t = trips.select("bundle", "trip_id", "route_id", "direction_id")
    served = (patterns.trips.select(*PATTERN, "trip_id").join(t, ["bundle", "trip_id"], "left")
              .select(*PATTERN, "route_id", "direction_id").distinct())
    listed = served.join(patterns.stops.select(*PATTERN, "stop_id").distinct(), PATTERN).select("bundle", "route_id", "direction_id", "stop_id").distinct()
    names = stops.groupBy("bundle", "stop_id").agg(F.min("stop_name").alias("stop_name"))
    return listed.join(names, ["bundle", "stop_id"]).select("bundle", "route_id", "direction_id", "stop_id", "stop_name")
