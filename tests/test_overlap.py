"""Shared track with partly overlapping segments: hand cases and brute force on a grid."""

import random

import pytest

from pickwise.operators import overlap as O
from pickwise.operators.matching import variant_pairs

SEG = "struct<a: struct<lon: double, lat: double>, b: struct<lon: double, lat: double>, len: double>"
VT = f"bundle string, route_id string, direction_id int, daytype string, shape_id string, segments array<{SEG}>"


def line(*pts, step=0.001):
    """Segments of a line through whole grid points."""
    at = [(-74 + x * step, 40 + y * step) for x, y in pts]
    return [(min(p, q), max(p, q), 0.0) for p, q in zip(at, at[1:], strict=False)]


def table(spark, *lines, direction=0):
    return spark.createDataFrame([(b, "R", direction, "weekday", s, segs) for b, s, segs in lines], VT)


def track(spark, *lines, **kw):
    return {(r.shape_id_a, r.shape_id_b): r for r in O.shared_track(table(spark, *lines, **kw), "a", "b").collect()}


CASES = {
    # skipped stops, half a segment, the same way back
    "express": (line((0, 0), (4, 0)), line((0, 0), (1, 0), (3, 0), (4, 0)), 4, 4, 4),
    "half": (line((0, 0), (4, 0)), line((2, 0), (6, 0)), 2, 4, 4),
    "back": (line((4, 0), (0, 0)), line((1, 0), (2, 0)), 1, 4, 1),
    "twice": (line((0, 0), (3, 0), (1, 0)), line((2, 0), (5, 0)), 1, 3, 3),
    "steep": (line((0, 0), (0, 5)), line((0, 1), (0, 2), (0, 9)), 4, 5, 8),
    "slant": (line((0, 0), (3, 6)), line((1, 2), (2, 4), (2, 9)), 5 ** .5, 3 * 5 ** .5, 5 ** .5 + 5),
    "steps": (line((0, 0), (3, 0), (3, 3)), line((1, 0), (3, 0), (3, 1), (5, 1)), 3, 6, 5),
    # a break in the middle of what the other runs through
    "gap": (line((0, 0), (1, 0), (1, 1), (3, 1), (3, 0), (4, 0)), line((0, 0), (4, 0)), 2, 6, 4),
}


@pytest.mark.parametrize("name", CASES)
def test_hand_cases(spark, name):
    a, b, shared, la, lb = CASES[name]
    r = track(spark, ("a", "x", a), ("b", "y", b))["x", "y"]
    assert [round(v * 1000, 6) for v in (r.shared, r.length_a, r.length_b)] == [round(v, 6) for v in (shared, la, lb)]
    assert r.shape_similarity == pytest.approx(shared / (la + lb - shared))


def test_what_shares_nothing_gives_no_row(spark):
    flat = line((0, 0), (4, 0))
    for other in (line((4, 0), (6, 0)), line((0, 1), (4, 1)), line((2, -1), (2, 1)), line((0, 0), (4, 1)), [], None, line((1, 0), (1, 0))):
        assert track(spark, ("a", "x", flat), ("b", "y", other)) == {}
    assert set(track(spark, ("a", "x", flat), ("b", "y", flat), direction=None)) == {("x", "y")}
    assert track(spark, ("a", "x", flat), ("c", "y", flat)) == {}


def test_random_walks_against_unit_steps(spark):
    rnd = random.Random(5)
    lines, steps = [], {}
    for bundle in "ab":
        for i in range(12):
            at, walk, units = (0, 0), [(0, 0)], set()
            for _ in range(12):
                dx, dy = rnd.choice([(1, 0), (0, 1), (-1, 0), (0, -1), (1, 1), (-1, -1), (1, 2)])
                for _ in range(rnd.randint(1, 4)):
                    to = (at[0] + dx, at[1] + dy)
                    units.add((min(at, to), max(at, to)))
                    at = to
                walk.append(at)
            lines.append((bundle, f"s{i}", line(*walk)))
            steps[bundle, f"s{i}"] = units
    got = track(spark, *lines)
    size = lambda units: sum(((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** .5 for p, q in units)
    for i in range(12):
        for j in range(12):
            a, b = steps["a", f"s{i}"], steps["b", f"s{j}"]
            if not a & b:
                assert (f"s{i}", f"s{j}") not in got
                continue
            r = got[f"s{i}", f"s{j}"]
            assert (r.shared * 1000, r.shape_similarity) == pytest.approx((size(a & b), size(a & b) / size(a | b)))


def test_pairs_take_the_track_given(spark):
    vt = table(spark, ("a", "x", line((0, 0), (4, 0))), ("a", "z", line((0, 9), (4, 9))), ("b", "y", line((2, 0), (6, 0))))
    from pyspark.sql import functions as F
    vt = vt.select("*", F.array(F.lit("s")).alias("stop_ids"), *[F.lit("p").alias(c) for c in ("start_stop", "end_stop", "headsign")],
                   F.lit(1).alias("trip_count"), F.lit(1.0).alias("length_ft"), F.lit(2).alias("stop_count"))
    whole = {r.shape_id_a: r.shape_similarity for r in variant_pairs(vt, "a", "b").collect()}
    partly = {r.shape_id_a: round(r.shape_similarity, 9) for r in variant_pairs(vt, "a", "b", track=O.shared_track(vt, "a", "b")).collect()}
    assert whole == {"x": 0.0, "z": 0.0}
    assert partly == {"x": round(1 / 3, 9), "z": 0.0}
