"""Best matches by bounds: the same answers as scoring every pair, with few scored."""

import random

from pyspark.sql import functions as F

from pickwise.operators import matching as M

SCHEMA = ("bundle string, route_id string, direction_id int, daytype string, shape_id string, stop_ids array<string>, "
          "segments array<struct<a: struct<lon: double, lat: double>, b: struct<lon: double, lat: double>, len: double>>, "
          "start_stop string, end_stop string, headsign string, trip_count long, length_ft double, stop_count long")
rng = random.Random(9)


def variant(bundle, route, direction, daytype, n):
    stops = sorted(rng.sample([f"s{i}" for i in range(40)], rng.randint(0, 25)))
    segments = [((float(i), 0.0), (float(i + 1), 0.0), 1.0 + i % 3) for i in rng.sample(range(30), rng.randint(0, 20))]
    return (bundle, route, direction, daytype, f"{route}_{n:04d}", rng.choice([stops, stops, None]), rng.choice([segments, segments, None]), rng.choice("xyz"), rng.choice(["x", "y", None]),
            rng.choice([" Main St", "main st\t", "Ferry", None, "FERRY "]), rng.randint(1, 50), rng.choice([None, rng.uniform(0, 9e4)]), rng.randint(0, 30))


def both(spark, rows, **kw):
    vt = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: tuple(map(str, r))
    shown = lambda df: sorted([tuple(r) for r in df.withColumn("score", F.round("score", 9)).select(*M.PAIR_KEY, "shape_id_a", "shape_id_b", "score", "status").collect()], key=key)
    return vt, shown(M.variant_matches(vt, "a", "b", **kw)), shown(M.bounded_matches(vt, "a", "b", **{**kw, "per_task": 16}))


def test_same_answers_as_scoring_all(spark):
    rows = [variant(b, r, d, t, n) for n, (b, r, d, t) in enumerate((b, r, d, t) for b in "ab" for r in ("R1", "R2") for d in (0, None) for t in ("weekday", "weekend") for _ in range(rng.randint(1, 9)))]
    rows += [("a", "R8", 0, "weekday", "only_a", ["s1"], None, "x", "y", "h", 1, 1.0, 1), ("b", "R9", 0, "weekday", "only_b", ["s1"], None, "x", "y", "h", 1, 1.0, 1)]
    rows += [("a", "R7", None, "weekday", f"t{i}", ["s1"], None, "x", "y", "h", 1, 1.0, 1) for i in range(3)] + [("b", "R7", None, "weekday", f"t{i}", ["s1"], None, "x", "y", "h", 1, 1.0, 1) for i in range(3)]  # ties
    for kw in ({}, {"version": 1}, {"min_score": 0.45}, {"weights": {"shape_similarity": 0.9, "headsign": 0.1}}):
        _, want, got = both(spark, rows, **kw)
        assert got == want and {r[-1] for r in got} == {"matched", "removed", "added"}


def test_few_pairs_of_a_large_route_are_scored(spark):
    def make(bundle, n):
        return variant(bundle, "R1", 0, "weekday", n)[:4] + (f"sh{n:04d}", [f"s{i}" for i in range(n % 37 + 1)], [((float(i), 0.0), (float(i + 1), 0.0), 1.0) for i in range(n % 37)],
                                                             f"s{n % 7}", f"e{n % 5}", f"h{n % 3}", n % 50 + 1, 1000.0 * (n % 37 + 1), n % 37 + 1)
    rows = [make(b, n) for b in "ab" for n in range(300)]
    vt, want, got = both(spark, rows)
    assert got == want
    tried, left = M.bounded_candidates(vt, "a", "b", per_task=16)
    assert tried.count() == 300 and left.count() < 0.1 * 300 * 300
    a, b = M._sides(vt, "a", "b", 16)
    assert a.select("part_a").distinct().count() == 19 and b.count() == 19 * 300


def test_headsigns_lose_any_white_space(spark):
    df = spark.createDataFrame([("Main St \t", "\n main st"), ("a b", "a  b"), (None, "x"), (" X", "x\x0b")], "a string, b string")
    assert [r[0] for r in df.select(M.sim_headsign("a", "b")).collect()] == [1.0, 0.0, 0.0, 1.0]
