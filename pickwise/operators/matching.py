"""Variant similarity across two bundles and best-counterpart matching.

Candidates are the other bundle's variants of the same route, direction and
daytype (an equi-join on those keys); each variant row carries its stop-id
set and segment list, so scoring needs no further join to stop_times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.similarity import (WEIGHTS_V1, WEIGHTS_V2, folded_headsign, line_length, most_shape, most_stop_set,
                                           sim_headsign, sim_ratio, sim_shape, sim_start_end, sim_stop_set, weighted)
from pickwise.plans.materialize import materialize

PAIR_KEY = ["route_id", "direction_id", "daytype"]
METRICS = ["shape_id", "stop_ids", "segments", "start_stop", "end_stop", "headsign", "trip_count",
           "length_ft", "stop_count"]


def variant_pairs(vt: DataFrame, bundle_a: str, bundle_b: str, version: int = 2,
                  weights: dict | None = None, salts: int = 8, carry: tuple = (), track: DataFrame | None = None) -> DataFrame:
    """Score every candidate pair (a in bundle_a, b in bundle_b) of a group.

    ``version=1`` is the first scorer (no geometry), ``version=2`` adds the
    shape overlap. Returns the components and ``score``. bundle_a's variants
    are spread over ``salts`` parts of their group and meet a copy of
    bundle_b's in each, so a group holding a large share of all variants
    forms its pairs in that many tasks. ``carry`` names further columns of
    bundle_b's variants to hand on (with the suffix ``_b``). ``track``: the
    pairs' shape overlap as of ``overlap.shared_track``, used instead of whole
    shared segments.
    """
    def side(bundle, sfx, more=()):
        return vt.where(F.col("bundle") == bundle).select(
            *[F.col(k).alias(f"{k}_{sfx}") for k in PAIR_KEY], *[F.col(m).alias(f"{m}_{sfx}") for m in [*METRICS, *more]])

    a, b = side(bundle_a, "a"), side(bundle_b, "b", carry)
    a = a.withColumn("_salt_a", F.pmod(F.xxhash64("shape_id_a"), F.lit(salts)).cast("int"))
    b = b.withColumn("_salt_b", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = ((a["_salt_a"] == b["_salt_b"]) & (a["route_id_a"] == b["route_id_b"]) & a["direction_id_a"].eqNullSafe(b["direction_id_b"])
            & (a["daytype_a"] == b["daytype_b"]))
    p = a.join(b, cond)
    overlap = sim_shape("segments_a", "segments_b")
    if track is not None:
        t = track.select(*[F.col(c).alias(f"{c}_t") for c in [*PAIR_KEY, "shape_id_a", "shape_id_b", "shape_similarity"]])
        same = (F.col("shape_id_a") == F.col("shape_id_a_t")) & (F.col("shape_id_b") == F.col("shape_id_b_t"))
        for k in PAIR_KEY:
            same = same & F.col(f"{k}_a").eqNullSafe(F.col(f"{k}_t"))
        p = p.join(t, same, "left")
        overlap = F.coalesce("shape_similarity_t", F.lit(0.0))
    comps = {
        "stop_set_similarity": sim_stop_set("stop_ids_a", "stop_ids_b"),
        "shape_similarity": overlap,
        "startend": sim_start_end("start_stop_a", "end_stop_a", "start_stop_b", "end_stop_b"),
        "headsign": sim_headsign("headsign_a", "headsign_b"),
        "trip_ratio": sim_ratio("trip_count_a", "trip_count_b"),
        "length_ratio": sim_ratio("length_ft_a", "length_ft_b"),
        "stopcount_ratio": sim_ratio("stop_count_a", "stop_count_b"),
    }
    w = weights or (WEIGHTS_V1 if version == 1 else WEIGHTS_V2)
    p = p.withColumns({k: v for k, v in comps.items() if k in w})
    return p.select(F.col("route_id_a").alias("route_id"), F.col("direction_id_a").alias("direction_id"),
                    F.col("daytype_a").alias("daytype"), "shape_id_a", "shape_id_b", *[f"{c}_b" for c in carry], *w.keys(),
                    weighted({k: F.col(k) for k in w}, w).alias("score"))


def variant_matches(vt: DataFrame, bundle_a: str, bundle_b: str, version: int = 2, min_score: float = 0.0,
                    weights: dict | None = None, tie_digits: int = 6, track: DataFrame | None = None) -> DataFrame:
    """Best counterpart in bundle_b of every bundle_a variant, plus the
    variants left over on either side.

    ``status``: ``matched``; ``removed`` (a variant of bundle_a with no
    candidate scoring at least ``min_score``); ``added`` (a bundle_b variant
    that is nobody's best match). Scores equal to ``tie_digits`` decimals (9 at
    most) tie and go to the smallest shape id. ``track`` as in ``variant_pairs``.
    """
    by_shape = Window.partitionBy("bundle", *PAIR_KEY).orderBy("shape_id")
    ranked = vt.withColumn("rank", F.row_number().over(by_shape))
    pairs = (variant_pairs(ranked, bundle_a, bundle_b, version, weights, carry=("rank",), track=track)
             .where(F.col("score") >= min_score))
    # Best candidate per variant as an aggregate, not a window: the pair rows
    # are folded map-side (partial min_by) right where the join produces them,
    # so only about one row per variant and task is shuffled, never every pair.
    # Score and rank of the shape id are packed into one long: fixed-width
    # buffers make it a hash aggregate, and no pair is sorted.
    points = F.round(F.bround("score", tie_digits) * F.lit(float(10**tie_digits))).cast("long")
    order = F.col("rank_b") - points * F.lit(1 << 32)
    best = pairs.groupBy(*PAIR_KEY, "shape_id_a").agg(F.min(order).alias("order"), F.min_by("score", order).alias("score"))
    best = best.withColumn("rank", F.col("order").bitwiseAND(F.lit((1 << 32) - 1)))
    names = ranked.where(F.col("bundle") == bundle_b).select(*PAIR_KEY, "rank", F.col("shape_id").alias("shape_id_b"))
    same = F.col("x.rank") == F.col("y.rank")
    for k in PAIR_KEY:
        same = same & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
    best = materialize(best.alias("x").join(names.alias("y"), same)
                       .select(*[F.col(f"x.{k}") for k in PAIR_KEY], "x.shape_id_a", "y.shape_id_b", "x.score"))
    return _with_leftovers(vt, bundle_a, bundle_b, best)


def _with_leftovers(vt: DataFrame, bundle_a: str, bundle_b: str, best: DataFrame) -> DataFrame:
    """Every variant of bundle_a with its best match, and the bundle_b variants that are nobody's."""
    a_all = vt.where(F.col("bundle") == bundle_a).select(*PAIR_KEY, F.col("shape_id").alias("shape_id_a"))
    b_all = vt.where(F.col("bundle") == bundle_b).select(*PAIR_KEY, F.col("shape_id").alias("shape_id_b"))

    def on(x, y, shape):
        c = F.col(f"{x}.{shape}") == F.col(f"{y}.{shape}")
        for k in PAIR_KEY:
            c = c & F.col(f"{x}.{k}").eqNullSafe(F.col(f"{y}.{k}"))
        return c

    left = (a_all.alias("x").join(best.alias("y"), on("x", "y", "shape_id_a"), "left")
            .select(*[F.col(f"x.{k}") for k in PAIR_KEY], "x.shape_id_a", "y.shape_id_b", "y.score"))
    right = (b_all.alias("x").join(best.alias("y"), on("x", "y", "shape_id_b"), "left_anti")
             .select(*PAIR_KEY, F.lit(None).cast("string").alias("shape_id_a"), "shape_id_b",
                     F.lit(None).cast("double").alias("score")))
    out = left.unionByName(right)
    status = (F.when(F.col("shape_id_a").isNull(), F.lit("added"))
              .when(F.col("shape_id_b").isNull(), F.lit("removed")).otherwise(F.lit("matched")))
    return out.withColumn("status", status)


def _sides(vt: DataFrame, bundle_a: str, bundle_b: str, per_task: int) -> tuple[DataFrame, DataFrame]:
    """Both bundles' variants without their arrays, numbered by shape id in their
    group. A group of many bundle_a variants is dealt over as many parts as it
    holds ``per_task`` of them; bundle_b's meet each part."""
    key = ["bundle", *PAIR_KEY]
    flat = vt.select(*key, "shape_id", "start_stop", "end_stop", folded_headsign("headsign").alias("headsign"), "trip_count", "length_ft", "stop_count",
                     F.size(F.coalesce("stop_ids", F.array().cast("array<string>"))).alias("n_ids"), line_length("segments").alias("line"))
    flat = flat.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("shape_id")))
    parts = F.ceil(F.max("rank").over(Window.partitionBy(*key)) / per_task).cast("int")
    a = flat.where(F.col("bundle") == bundle_a).withColumn("parts", parts).drop("bundle")
    a = a.withColumn("part", F.pmod("rank", "parts"))
    b = flat.where(F.col("bundle") == bundle_b).drop("bundle")
    sizes = a.groupBy(*PAIR_KEY).agg(F.max("parts").alias("parts"))
    same = _same_keys(b, sizes, PAIR_KEY)
    b = b.join(sizes.select("parts", *[F.col(k).alias(f"_{k}") for k in PAIR_KEY]), same).drop(*[f"_{k}" for k in PAIR_KEY])
    b = b.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (df.select(*[F.col(c).alias(f"{c}_{sfx}") for c in df.columns if c != "parts"]) for df, sfx in ((a, "a"), (b, "b")))


def _same_keys(left: DataFrame, right: DataFrame, keys, prefix: str = "_"):
    """Null-safe equality of ``keys`` with the columns of the same names under a prefix."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def _points(score, tie_digits: int):
    return F.round(F.bround(score, tie_digits) * F.lit(float(10**tie_digits))).cast("long")


def _bounded_pairs(a: DataFrame, b: DataFrame, weights: dict) -> DataFrame:
    """Candidate pairs with ``most``, what their score is at most: ends, headsign
    and ratios as they are, overlaps from the sizes of what overlaps."""
    cond = (F.col("part_a") == F.col("part_b")) & (F.col("route_id_a") == F.col("route_id_b")) & (F.col("daytype_a") == F.col("daytype_b"))
    p = a.join(b, cond & F.col("direction_id_a").eqNullSafe(F.col("direction_id_b")))
    comps = {
        "stop_set_similarity": most_stop_set("n_ids_a", "n_ids_b"),
        "shape_similarity": most_shape("line_a", "line_b"),
        "startend": sim_start_end("start_stop_a", "end_stop_a", "start_stop_b", "end_stop_b"),
        "headsign": F.when(F.col("headsign_a") == F.col("headsign_b"), F.lit(1.0)).otherwise(F.lit(0.0)),
        "trip_ratio": sim_ratio("trip_count_a", "trip_count_b"),
        "length_ratio": sim_ratio("length_ft_a", "length_ft_b"),
        "stopcount_ratio": sim_ratio("stop_count_a", "stop_count_b"),
    }
    return p.withColumn("most", weighted(comps, weights)).select(*[F.col(f"{k}_a").alias(k) for k in PAIR_KEY], "shape_id_a", "shape_id_b", "rank_b", "most")


def _exact(pairs: DataFrame, vt: DataFrame, bundle_a: str, bundle_b: str, weights: dict) -> DataFrame:
    """``pairs`` with their ``score``: the two variants' arrays are fetched for these alone."""
    def side(bundle, sfx):
        return vt.where(F.col("bundle") == bundle).select(*[F.col(k).alias(f"_{k}") for k in PAIR_KEY], *[F.col(m).alias(f"{m}_{sfx}" if m != "shape_id" else "_shape") for m in METRICS])

    out = pairs
    for bundle, sfx in ((bundle_a, "a"), (bundle_b, "b")):
        own = side(bundle, sfx)
        out = out.join(own, _same_keys(out, own, PAIR_KEY) & (F.col(f"shape_id_{sfx}") == F.col("_shape"))).drop("_shape", *[f"_{k}" for k in PAIR_KEY])
    comps = {
        "stop_set_similarity": sim_stop_set("stop_ids_a", "stop_ids_b"),
        "shape_similarity": sim_shape("segments_a", "segments_b"),
        "startend": sim_start_end("start_stop_a", "end_stop_a", "start_stop_b", "end_stop_b"),
        "headsign": sim_headsign("headsign_a", "headsign_b"),
        "trip_ratio": sim_ratio("trip_count_a", "trip_count_b"),
        "length_ratio": sim_ratio("length_ft_a", "length_ft_b"),
        "stopcount_ratio": sim_ratio("stop_count_a", "stop_count_b"),
    }
    return out.withColumn("score", weighted(comps, weights)).select(*PAIR_KEY, "shape_id_a", "shape_id_b", "rank_b", "score")


def bounded_candidates(vt: DataFrame, bundle_a: str, bundle_b: str, version: int = 2, weights: dict | None = None,
                       tie_digits: int = 6, per_task: int = 512) -> tuple[DataFrame, DataFrame]:
    """The pairs whose exact score is needed to know each bundle_a variant's best:
    those that promise most, with their score (stored), and the others whose bound
    still reaches it. Any other pair can neither win nor tie."""
    w = weights or (WEIGHTS_V1 if version == 1 else WEIGHTS_V2)
    a, b = _sides(vt, bundle_a, bundle_b, per_task)
    pairs = _bounded_pairs(a, b, w)
    order = F.col("rank_b") - _points("most", tie_digits) * F.lit(1 << 32)
    first = pairs.groupBy(*PAIR_KEY, "shape_id_a").agg(F.min(order).alias("order"))
    first = first.select(*[F.col(k).alias(f"_{k}") for k in PAIR_KEY], F.col("shape_id_a").alias("_shape_id_a"), F.col("order").bitwiseAND(F.lit((1 << 32) - 1)).alias("_rank"))
    names = b.select(*[F.col(f"{k}_b").alias(k) for k in PAIR_KEY], "shape_id_b", "rank_b").distinct()
    tried = names.join(first, _same_keys(names, first, PAIR_KEY) & (F.col("rank_b") == F.col("_rank")))
    tried = tried.select(*PAIR_KEY, F.col("_shape_id_a").alias("shape_id_a"), "shape_id_b", "rank_b")
    tried = materialize(_exact(tried, vt, bundle_a, bundle_b, w))
    reached = tried.select(*[F.col(k).alias(f"_{k}") for k in PAIR_KEY], F.col("shape_id_a").alias("_shape_id_a"), F.col("rank_b").alias("_rank"), _points("score", tie_digits).alias("_points"))
    # one point of slack for the rounding of sums
    left = pairs.join(reached, _same_keys(pairs, reached, [*PAIR_KEY, "shape_id_a"]) & (F.col("rank_b") != F.col("_rank")) & (_points("most", tie_digits) + 1 >= F.col("_points")))
    return tried, left.select(*PAIR_KEY, "shape_id_a", "shape_id_b", "rank_b")


def bounded_matches(vt: DataFrame, bundle_a: str, bundle_b: str, version: int = 2, min_score: float = 0.0,
                    weights: dict | None = None, tie_digits: int = 6, per_task: int = 512) -> DataFrame:
    """The result of ``variant_matches``, exact, with few pairs scored.

    Pairs of a group are formed without stop sets and segments, with a bound on
    their score; each variant's most promising pair is scored, and then only
    those whose bound reaches that score. Arrays are fetched for scored pairs
    alone. Better than scoring all where groups are large; for groups of a few
    variants the two rounds cost more than they save. ``weights`` may not be
    negative.
    """
    w = weights or (WEIGHTS_V1 if version == 1 else WEIGHTS_V2)
    if min(w.values()) < 0:
        raise ValueError("a bound needs weights that aren't negative")
    tried, left = bounded_candidates(vt, bundle_a, bundle_b, version, weights, tie_digits, per_task)
    scored = tried.unionByName(_exact(left, vt, bundle_a, bundle_b, w)).where(F.col("score") >= min_score)
    order = F.col("rank_b") - _points("score", tie_digits) * F.lit(1 << 32)
    best = scored.groupBy(*PAIR_KEY, "shape_id_a").agg(F.min(order).alias("order"), F.min_by("score", order).alias("score"))
    best = best.select(*[F.col(k).alias(f"_{k}") for k in PAIR_KEY], F.col("shape_id_a"), F.col("order").bitwiseAND(F.lit((1 << 32) - 1)).alias("_rank"), "score")
    by_shape = Window.partitionBy("bundle", *PAIR_KEY).orderBy("shape_id")
    names = vt.withColumn("rank", F.row_number().over(by_shape)).where(F.col("bundle") == bundle_b).select(*PAIR_KEY, "rank", F.col("shape_id").alias("shape_id_b"))
    best = materialize(names.join(best, _same_keys(names, best, PAIR_KEY) & (F.col("rank") == F.col("_rank"))).select(*PAIR_KEY, "shape_id_a", "shape_id_b", "score"))
    return _with_leftovers(vt, bundle_a, bundle_b, best)
