"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pickwise.llm import topk

LONG = (1 << 63) - 1


def brute(rows, k, scale=1024.0):
    use = [(i, [int(np.floor(float(x) * scale)) for x in e]) for i, e in rows if e and None not in e and np.isfinite(e).all() and np.isfinite(np.array(e, float) * scale).all()]
    out = []
    for a, (q, x) in enumerate(use):
        if q is not None and q % 10 == 0:
            scores = [(max(-LONG - 1, min(LONG, sum(m * n for m, n in zip(x, y, strict=True)))), c) for b, (c, y) in enumerate(use) if a != b and len(x) == len(y)]
            scores.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
            out += [(q, r, c, s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def rows_of(seed, n, d, spread, noise):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(7, d))
    x = centres[r.integers(0, 7, n)] + noise * r.normal(size=(n, d))
    x *= np.exp(spread * r.normal(size=(n, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize(("spread", "noise", "tile", "seeds"), [(1.0, 0.05, 50, 40), (0.0, 0.02, 64, 300), (0.5, 2.0, 8192, 16), (0.3, 0.01, 100, 4)])
def test_search_matches_brute_force(spark, spread, noise, tile, seeds):
    rows = rows_of(3, 600, 12, spread, noise)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = topk.search(df, F.col("vec_id") % 10 == 0, tile=tile, seeds=seeds).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 10)


def test_odd_rows(spark):
    rows = rows_of(5, 60, 4, 0.5, 0.5)
    rows += [(100 + i, rows[10][1]) for i in range(30)] + [(10, rows[10][1]), (20, rows[3][1]), (None, rows[10][1]), (None, None)]
    rows += [(200, None), (210, []), (220, [float("nan")] * 4), (230, [None, 1.0, 1.0, 1.0]), (240, [float("inf"), 0.0, 0.0, 0.0]), (250, [1e307] * 4), (260, [0.0] * 4), (270, [-0.0] * 4), (280, [1.0, 2.0]), (290, [3.0])]
    rows += [(300, [1e16, 3.3, -2e15, 1.0]), (310, [1e300, 0.0, 0.0, 1.0]), (320, [-1e300, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS size", "'t' AS tile", "2 AS row", "true AS asks", "3 AS rank")
    for seeds in (2, 500):
        got = topk.search(df, F.col("vec_id") % 10 == 0, tile=16, seeds=seeds).select("query_id", "rank", "vec_id", "score").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, 10)
    assert topk.search(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert topk.search(df, F.lit(None).cast("boolean")).collect() == []


def test_both_prunings_leave_out_vectors():
    r = np.random.default_rng(1)
    vectors = r.normal(size=(2000, 8))
    vectors[:40] = vectors[0] + r.normal(size=(40, 8)) * 0.02
    vectors = np.floor(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * r.uniform(3000, 3300, (2000, 1)))  # one bucket
    lengths = np.linalg.norm(vectors, axis=1)
    tile = topk.Tile(np.arange(2000), np.arange(2000), lengths, vectors)
    scores = vectors @ vectors[0]
    floor = float(np.sort(scores)[-10])
    n, places = tile.candidates(lengths[0], vectors[0] / lengths[0], floor)
    assert places is not None and len(places) < 300
    assert {*np.flatnonzero(scores >= floor).tolist()} <= {*tile.rows[places].tolist()}
    assert tile.candidates(1.0, vectors[0] / lengths[0], lengths.max() * 1.1)[0] == 0
    assert tile.candidates(1.0, vectors[0] / lengths[0], -5.0) == (2000, None)
    assert 0 < tile.candidates(1.0, np.full(8, 8**-0.5), 3200.0)[0] < 2000
