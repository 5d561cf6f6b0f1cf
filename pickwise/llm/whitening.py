"""Whitening of embeddings by a bidiagonal qd solver.

The distinct whole-number vectors are centred by their exact mean and reduced
block by block to triangular factors (QR), which tasks merge a few at a time.
The last factor, as large as the vectors have components, goes through
``bidiagonal``: its squared singular values over n are the eigenvalues of the
covariance, its right singular vectors the whitening directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.bidiagonal import EPS, largest
from pickwise.llm.shared import slices, stored

FAN_IN = 8  # triangular factors that a task merges


def _whole(embeddings: DataFrame, scale: float) -> DataFrame:
    """(vec_id, size, vec): floor(scale * x) as longs in bytes, of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096):
            lists = batch.column("embedding")
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False) * scale)
                fits = (flat >= -(2.0**63)) & (flat < 2.0**63)  # NaN doesn't
                whole = np.where(fits, flat, 0).astype(np.int64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            keep = [i for i, (n, e) in enumerate(zip(sizes, ends, strict=True)) if n and fits[e - n : e].all()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(keep, pa.int64())), pa.array(sizes[keep], pa.int32()), pa.array([whole[ends[i] - sizes[i] : ends[i]].tobytes() for i in keep], pa.binary())],
                ["vec_id", "size", "vec"])

    picked = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return picked.mapInArrow(run, "vec_id long, size int, vec binary")


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches of one size each, with their vectors as rows of longs."""
    for batch in slices(batches, rows=2048):
        of = batch.column("size").to_numpy()
        for size in np.unique(of).tolist():
            part = batch.take(pa.array(np.flatnonzero(of == size)))
            yield size, part, np.frombuffer(b"".join(part.column("vec").to_pylist()), np.int64).reshape(-1, size)


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the exact sums of the components, by size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, list[int]]] = {}
        for size, _, x in _by_size(batches):
            n, old = totals.get(size, (0, [0] * size))
            # halves, so that sums of longs don't overflow
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            totals[size] = n + len(x), [a + (h << 32) + b for a, h, b in zip(old, high, low, strict=True)]
        for size, (n, s) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "size": pa.array([size] * size, pa.int32()), "i": pa.array(range(size), pa.int32()), "n": pa.array([n] * size, pa.int64()),
                "high": pa.array([v >> 40 for v in s], pa.int64()), "low": pa.array([v & ((1 << 40) - 1) for v in s], pa.int64())})

    parts = fit.mapInArrow(run, "size int, i int, n long, high long, low long")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("size", "i").collect():
        out.setdefault(r["size"], (r["n"], []))[1].append((r["high"] << 40) + r["low"])
    return out


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """Rows x - s / n in double precision, from exact numerators."""
    if len(x) and n * int(np.abs(x.astype(float)).max()) + max(map(abs, s)) < 1 << 62:
        return (n * x - np.array(s, np.int64)) / n
    return np.array([[float((n * int(v) - t) / n) for v, t in zip(row, s, strict=True)] for row in x]).reshape(x.shape)


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sums of (n * x - s) ** 2 by row, exact; None where a long is too short."""
    if len(x) and (n * int(np.abs(x.astype(float)).max()) + max(map(abs, s))) ** 2 * x.shape[1] < 1 << 62:
        return ((n * x - np.array(s, np.int64)) ** 2).sum(axis=1).tolist()
    sums = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in sums]


def _reduced(blocks: list[np.ndarray]) -> np.ndarray:
    """The square triangular factor of the blocks, one above the other."""
    r = np.linalg.qr(np.concatenate(blocks), mode="r")
    return r if len(r) == r.shape[1] else np.concatenate([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def _factors(fit: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """The triangular factor of all centred vectors, by size."""
    sent = fit.sparkSession.sparkContext.broadcast(sums)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors: dict[int, np.ndarray] = {}
        for size, _, x in _by_size(batches):
            factors[size] = _reduced([*([factors[size]] if size in factors else []), centred(x, *sent.value[size])])
        for size, r in factors.items():
            yield pa.RecordBatch.from_pydict({"size": pa.array([size], pa.int32()), "factor": pa.array([r.tobytes()], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        blocks = [np.frombuffer(r).reshape(size, size) for r in sorted(table.column("factor").to_pylist())]
        return pa.table({"size": table.column("size")[:1], "slot": table.column("slot")[:1], "factor": pa.array([_reduced(blocks).tobytes()], pa.binary())})

    parts = fit.mapInArrow(reduce, "size int, factor binary").withColumn("slot", F.spark_partition_id())
    parts = stored(parts, "whitening-factors")
    most = parts.agg(F.max("slot")).first()[0]
    for _ in range(ceil(log((most or 0) + 1, FAN_IN))):
        parts = parts.withColumn("slot", F.expr(f"slot div {FAN_IN}").cast("int")).groupBy("size", "slot").applyInArrow(merge, "size int, slot int, factor binary")
    return {r["size"]: np.frombuffer(r["factor"]).reshape(r["size"], r["size"]) for r in parts.collect()}


class Model:
    """Whitening of the vectors of one size."""

    def __init__(self, n: int, sums: list[int], factor: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, self.directions, total = largest(factor, components)
        noise = total * EPS * len(factor)
        self.flat = values <= noise  # no spread at all that way
        self.scales = np.sqrt(np.where(self.flat, 1.0, values / n))
        self.explained = [float(v / total) if total > 0 else None for v in values]
        self.error = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.directions / self.scales


def _measure(fit: DataFrame, models: dict[int, Model]) -> None:
    """Set each model's ``error``: how far the covariance of what it whitens is from the identity."""
    sent = fit.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for size, _, x in _by_size(batches):
            z = sent.value[size].project(x)
            z = np.concatenate([np.ones((len(z), 1)), z], axis=1)
            totals[size] = totals.get(size, 0) + z.T @ z
        for size, m in totals.items():
            k = len(m)
            yield pa.RecordBatch.from_pydict({
                "size": pa.array([size] * k * k, pa.int32()), "i": pa.array(np.repeat(np.arange(k), k), pa.int32()), "j": pa.array(np.tile(np.arange(k), k), pa.int32()), "v": pa.array(m.ravel())})

    got: dict[int, dict[tuple[int, int], float]] = {}
    for r in fit.mapInArrow(run, "size int, i int, j int, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect():
        got.setdefault(r["size"], {})[r["i"], r["j"]] = r["v"]
    for size, sums in got.items():
        model, k = models[size], max(i for i, _ in sums)
        mean = np.array([sums[0, j] for j in range(1, k + 1)]) / model.n
        cov = np.array([[sums[i, j] for j in range(1, k + 1)] for i in range(1, k + 1)]) / model.n - np.outer(mean, mean)
        use = ~model.flat
        model.error = float(np.abs(cov[np.ix_(use, use)] - np.eye(int(use.sum()))).max()) if use.any() else 0.0


def whiten(embeddings: DataFrame, components: int = 4, scale: float = 256.0) -> DataFrame:
    """Project vectors on their directions of most spread, at unit variance.

    ``embeddings``: vec_id, embedding; other columns are ignored. Components
    become whole numbers x = floor(``scale`` * c); mean and covariance are over
    the distinct vectors (n of them, component sums S). Returns a row for each
    vector that takes part and each of up to ``components`` directions, most
    spread first: vec_id, component (from 1), n, deviation (the sum of
    (n * x - S) ** 2, exact), whitened, explained (share of the variance),
    identity_error (how far the covariance of ``whitened`` is from the identity).

    Vectors that are null, empty, hold null or non-finite components or ones
    beyond a long take no part. Vectors of different numbers of components are
    whitened apart. Directions have their largest entry positive. Along a
    direction without spread ``whitened`` is null; without any spread so is
    ``explained``. A deviation beyond a long is null. Repeated rows weigh as
    one, and each gets its rows; so do rows without an id. An empty table gives
    no rows.
    """
    rows = stored(_whole(embeddings, scale), "whitening-rows")
    fit = stored(rows.select("size", "vec").distinct(), "whitening-fit")
    sums = _sums(fit)
    factors = _factors(fit, sums)
    models = {size: Model(*sums[size], factor, components) for size, factor in factors.items()}
    _measure(fit, models)
    sent = embeddings.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, part, x in _by_size(batches):
            model = sent.value[size]
            k = len(model.scales)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            hidden = np.tile(model.flat, len(x))
            tiled = lambda values, kind: pa.array(list(values) * len(x), kind)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(each), tiled(range(1, k + 1), pa.int32()), pa.array(np.full(k * len(x), model.n), pa.int64()),
                 pa.array(deviations(x, model.n, model.sums), pa.int64()).take(each), pa.array(model.project(x).ravel(), pa.float64(), mask=hidden),
                 tiled(model.explained, pa.float64()), pa.array(np.full(k * len(x), model.error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
