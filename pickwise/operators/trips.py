"""Per-trip aggregates of stop_times -- the one shuffle of the largest table.

stop_times is grouped once on (bundle, trip_id); the schedule, the route
summary and the variant operators all read this one-row-per-trip profile
instead of re-reading stop_times. Map-side partial aggregation collapses a
trip's rows before the shuffle (feeds are usually clustered by trip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.functions.clock import clock_minutes
from pickwise.plans.materialize import materialize


def trip_profile(stop_times: DataFrame, with_stops: bool = False, with_text: bool = False) -> DataFrame:
    """One row per (bundle, trip_id).

    ``start_min``/``end_min``: arrival minutes at the first / last stop by
    stop_sequence (null when that arrival is missing or malformed);
    ``first_min``: minutes of the first non-null arrival text in sequence
    order; ``stop_rows``: number of stop_times rows. Every one of these is a
    fixed-width buffer, so the aggregate is hash-based (no sort of stop_times).
    With ``with_text`` also ``first_arrival`` (that text itself): trips carry
    its 64-bit hash, and the distinct clock texts, far fewer than stop times,
    are stored (a job) as the dictionary that turns it back; with
    ``with_stops`` also ``stop_ids``: the trip's distinct stop ids (bounded by
    its stop count).

    Materialize it once (``plans.materialize``) when several operators run
    on the same bundles: they all read it instead of re-shuffling stop_times.
    """
    aggs = profile_aggregates()
    if with_text:
        first_order = F.when(F.col("arrival_time").isNotNull(), F.col("stop_sequence"))
        aggs.append(F.min_by(F.xxhash64("arrival_time"), first_order).alias("_first"))
    if with_stops:
        aggs.append(F.array_sort(F.collect_set("stop_id")).alias("stop_ids"))
    profile = with_minutes(stop_times).groupBy("bundle", "trip_id").agg(*aggs)
    if with_text:
        texts = materialize(stop_times.where(F.col("arrival_time").isNotNull()).select("arrival_time").distinct()
                            .select(F.xxhash64("arrival_time").alias("_first"), F.col("arrival_time").alias("first_arrival")))
        profile = profile.join(texts, "_first", "left").drop("_first")
    return profile


def with_minutes(stop_times: DataFrame) -> DataFrame:
    """stop_times with ``_arr_min``: the clock text is parsed once per row, before the partial aggregate."""
    return stop_times.withColumn("_arr_min", clock_minutes(F.col("arrival_time")))


def profile_aggregates() -> list[Column]:
    """The fixed-width columns of ``trip_profile``, over ``with_minutes`` rows of a trip."""
    seq, m = F.col("stop_sequence"), F.col("_arr_min")
    first_order = F.when(F.col("arrival_time").isNotNull(), seq)
    return [F.min(seq).alias("min_seq"), F.max(seq).alias("max_seq"),
            F.min_by(m, seq).alias("start_min"),
            F.max_by(m, seq).alias("end_min"),
            F.min_by(m, first_order).alias("first_min"),
            F.count(F.lit(1)).alias("stop_rows")]
