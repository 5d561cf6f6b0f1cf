"""Variant-to-variant similarity scores as Column expressions.

Each function takes the two variants' columns and returns a double in [0, 1].
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Composite score weights. V1 is the first scorer; V2 adds the
# shape (geometry) overlap and lowers the stop-set weight.
WEIGHTS_V1 = {"stop_set_similarity": 0.35, "startend": 0.20, "headsign": 0.10,
              "trip_ratio": 0.10, "length_ratio": 0.15, "stopcount_ratio": 0.10}
WEIGHTS_V2 = {"stop_set_similarity": 0.15, "shape_similarity": 0.20, "startend": 0.20, "headsign": 0.10,
              "trip_ratio": 0.10, "length_ratio": 0.15, "stopcount_ratio": 0.10}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sim_stop_set(a, b) -> Column:
    """Jaccard of two stop-id sets; both empty -> 1, one empty -> 0."""
    a = F.coalesce(_c(a), F.array().cast("array<string>"))
    b = F.coalesce(_c(b), F.array().cast("array<string>"))
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(inter / union))


def _seg_total(segs) -> Column:
    return F.aggregate(segs, F.lit(0.0), lambda acc, s: acc + s["len"])


def sim_shape(a_segments, b_segments) -> Column:
    """Shared length / union length of two lines given as distinct
    undirected stop-to-stop segments. A missing line scores 0. Partly
    overlapping collinear segments are not credited."""
    a, b = _c(a_segments), _c(b_segments)
    shared = _seg_total(F.array_intersect(a, b))
    union = _seg_total(a) + _seg_total(b) - shared
    return (F.when(a.isNull() | b.isNull(), F.lit(0.0))
            .when(union > 0, shared / union).otherwise(F.lit(0.0)))


def sim_start_end(a_start, a_end, b_start, b_end) -> Column:
    """1 when first and last stops are equal (two missing ends are equal)."""
    return F.when(_c(a_start).eqNullSafe(_c(b_start)) & _c(a_end).eqNullSafe(_c(b_end)), F.lit(1.0)).otherwise(F.lit(0.0))


# White space that goes at the ends of a headsign: blank, tab, line and page ends, separators, no-break space.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def folded_headsign(c) -> Column:
    """A headsign without white space at its ends, in lower case."""
    return F.lower(F.trim(_c(c), F.lit(BLANKS)))


def sim_headsign(a, b) -> Column:
    """Trimmed, case-folded equality; a missing headsign scores 0."""
    a, b = _c(a), _c(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(0.0))
            .when(folded_headsign(a) == folded_headsign(b), F.lit(1.0)).otherwise(F.lit(0.0)))


def sim_ratio(a, b) -> Column:
    """min/max; 0 when either is missing or both are 0."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    hi = F.greatest(a, b)
    return (F.when(a.isNull() | b.isNull() | ((a == 0) & (b == 0)), F.lit(0.0))
            .when(hi != 0, F.least(a, b) / hi).otherwise(F.lit(0.0)))


def weighted(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """C45/C46 (F19): weighted sum of the named component scores."""
    total = None
    for k, w in weights.items():
        term = F.lit(w) * scores[k]
        total = term if total is None else total + term
    return total


def most_stop_set(n_a, n_b) -> Column:
    """What ``sim_stop_set`` is at most, from the sizes of the two sets."""
    a, b = _c(n_a), _c(n_b)
    return F.when((a == 0) & (b == 0), F.lit(1.0)).otherwise(F.least(a, b) / F.greatest(a, b))


def most_shape(length_a, length_b) -> Column:
    """What ``sim_shape`` is at most, from the total lengths of the two lines."""
    a, b = _c(length_a), _c(length_b)
    return (F.when(a.isNull() | b.isNull(), F.lit(0.0))
            .when(F.greatest(a, b) > 0, F.least(a, b) / F.greatest(a, b)).otherwise(F.lit(0.0)))


def line_length(segments) -> Column:
    """Total length of a line's segments; null without a line."""
    return F.when(_c(segments).isNotNull(), _seg_total(_c(segments)))
