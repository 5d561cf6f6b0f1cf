"""Whitening against numpy's own eigenvectors and exact integers."""

import numpy as np
import pytest

from pickwise.llm import bidiagonal, queries, whitening


def matrices():
    r = np.random.default_rng(0)
    turn = lambda d: np.linalg.qr(r.normal(size=(d, d)))[0]
    for d in (1, 2, 3, 17, 64):
        yield r.normal(size=(3 * d + 5, d))
        yield np.floor(r.normal(size=(3 * d + 5, d)) * 2)
    yield r.normal(size=(200, 40)) * np.logspace(0, -9, 40)  # graded
    yield r.normal(size=(60, 3)) @ r.normal(size=(3, 40))  # of rank 3
    yield r.normal(size=(2, 9))
    yield np.eye(12)
    yield turn(40)  # all alike
    for gap in (1e-4, 1e-8, 1e-12, 0.0):
        yield turn(40) @ np.diag([1, 1 - gap, 1 - 2 * gap, 1 - 3 * gap, *np.linspace(0.9, 0.1, 36)]) @ turn(40)
    holes = np.zeros((20, 10))
    holes[3, 4] = holes[5, 9] = 2
    yield holes
    yield np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1)  # pairs of close values


@pytest.mark.parametrize("m", list(matrices()), ids=lambda m: "x".join(map(str, m.shape)))
def test_bidiagonal_solver(m):
    r = whitening._reduced([m])
    a, b, v = bidiagonal.bidiagonalise(r)
    band = np.diag(a) + np.diag(b, 1)
    assert np.allclose(v @ band.T @ band @ v.T, r.T @ r, atol=1e-12 * max(1, np.abs(r).max() ** 2))
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(bidiagonal.dqds(np.abs(a), np.abs(b)) - want).max() <= 1e-13 * want[0]
    values, vectors, total = bidiagonal.largest(r, 4)
    assert np.abs(values - want[: len(values)]).max() <= 1e-13 * want[0] and total == pytest.approx(want.sum(), rel=1e-13)
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_dqds_keeps_small_values_exact():
    b = np.array([1.0, 2.0, 3.0])
    a = np.array([1e-8, 1.0, 1e-6, 1.0])
    product = np.prod(a**2)  # of all values
    assert np.prod(bidiagonal.dqds(a, b)) == pytest.approx(product, rel=1e-13)


def test_blocks_merge_to_the_same_factor():
    x = np.random.default_rng(1).normal(size=(300, 7))
    whole = whitening._reduced([x])
    parts = whitening._reduced([whitening._reduced([x[a : a + 3]]) for a in range(0, 300, 3)])
    assert np.allclose(whole.T @ whole, parts.T @ parts, atol=1e-11)


def check(rows, given, components=4):
    """Rows of the query against exact integers and numpy's eigenvectors."""
    whole = [(i, [int(np.floor(256 * float(c))) for c in e]) for i, e in given if e and None not in e and np.isfinite(e).all()]
    for size in {len(x) for _, x in whole}:
        own = [(i, x) for i, x in whole if len(x) == size]
        distinct = sorted({tuple(x) for _, x in own})
        n, s = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
        z = np.array([[(n * v - t) / n for v, t in zip(x, s, strict=True)] for x in distinct])
        cov = z.T @ z / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        got = [r for r in rows if r["size"] == size]
        k = min(components, size)
        assert len(got) == k * len(own) and {r["n"] for r in got} == {n}
        want = sorted((str(i), sum((n * v - t) ** 2 for v, t in zip(x, s, strict=True))) for i, x in own for _ in range(k))
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in got) == want
        for c in range(k):
            mine = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1)
            ours = sorted((str(i), sum((n * v - t) ** 2 for v, t in zip(x, s, strict=True)), float((np.array([(n * v - t) / n for v, t in zip(x, s, strict=True)]) @ vectors[:, c]) / np.sqrt(values[c]))) for i, x in own)
            a, b = np.array([m[2] for m in mine]), np.array([m[2] for m in ours])
            if len({m[:2] for m in mine}) == len(mine):
                assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
            assert {r["explained"] for r in got if r["component"] == c + 1}.pop() == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in got) and len({r["identity_error"] for r in got}) == 1


def test_query_matches_numpy(spark):
    small = "/root/testdata/sf0.01"
    given = [(r.vec_id, r.embedding) for r in queries.table(spark, small, "embeddings").collect()]
    rows = [{**r.asDict(), "size": len(given[0][1])} for r in queries.op13_embedding_whitening(spark, small).collect()]
    check(rows, given)


def test_odd_rows(spark):
    r = np.random.default_rng(4)
    given = [(i, (r.normal(size=6) * [5, 4, 3, 2, 1, 1]).tolist()) for i in range(80)]
    given += [(3, given[3][1]), (90, given[5][1]), (None, given[7][1]), (91, [-0.0] * 6), (92, [-1e-9] * 6)]
    given += [(100, None), (101, []), (102, [None] * 6), (103, [float("nan")] * 6), (104, [float("inf")] * 6)]
    df = spark.createDataFrame([*given, (105, [1e300] * 6)], "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "2 AS size", "3 AS component").repartition(5)
    check([{**x.asDict(), "size": 6} for x in whitening.whiten(df).collect()], given)
    assert whitening.whiten(df.limit(0)).collect() == []


def test_vectors_without_spread_and_of_other_sizes(spark):
    given = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 0.0, 0.0]), (4, [2.0, 0.0, 0.0]), (5, [3e16, 1.0, 1.0, 1.0, 1.0]), (6, [-3e16, 2.0, 1.0, 1.0, 1.0])]
    rows = whitening.whiten(spark.createDataFrame(given, "vec_id long, embedding array<double>")).collect()
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == 2 * 2 + 2 * 3 + 2 * 4
    assert all((r.n, r.deviation, r.whitened, r.explained) == (1, 0, None, None) for r in rows if r.vec_id < 3)
    assert (by[3, 1].whitened, by[4, 1].whitened) in ((-1.0, 1.0), (1.0, -1.0)) and by[3, 1].explained == 1.0 and by[3, 2].whitened is None
    assert by[5, 1].deviation is None and abs(by[5, 1].whitened) == pytest.approx(1.0)


def test_exact_beyond_doubles():
    x = np.array([[2**40 + 1, 3], [2**40, -5]])
    s = [int(v) for v in x.sum(axis=0)]
    assert whitening.deviations(x, 2, s) == [1 + 64, 1 + 64] and whitening.deviations(x * 2**20, 2, [v * 2**20 for v in s]) == [65 << 40] * 2
    assert np.array_equal(whitening.centred(x * 2**20, 2, [v * 2**20 for v in s]), np.array([[2**19, 2**22], [-(2**19), -(2**22)]]))
