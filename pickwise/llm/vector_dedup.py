"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are rotated to principal axes. Vectors with cosine >= t lie
within sqrt(2 - 2 t) of each other on every axis, so cells of that width on
the leading axes need comparing with themselves and their neighbours alone.
A cell is split into tiles; a pair of tiles is compared with the leading
dimensions first, adding the product of the suffix norms as a bound on the
rest, and pairs that cannot reach the threshold are left. Survivors are
verified by the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.components import components
from pickwise.llm.shared import groups, slices, stored

SLACK = 1e-9
AXES = 2


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, label, vec): ``vec`` the doubles as bytes, ``key`` 128
    bits of label and vector; both null where a vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096):
            lists, ids, labels = batch.column("embedding"), batch.column("vec_id"), batch.column("label")
            values = lists.flatten()
            flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            keys, vecs = [], []
            for ok, label, a, b in zip((ids.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)), labels.to_pylist(), ends - lengths, ends, strict=True):
                x = flat[a:b]
                top = np.abs(x).max() if ok and b > a else 0.0
                if not (top > 0 and np.isfinite(top)):  # NaN fails as well
                    keys.append(None)
                    vecs.append(None)
                else:
                    vecs.append(x.tobytes())
                    keys.append(xxhash.xxh3_128_digest(str(label).encode() + b"\0" + vecs[-1]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), labels.cast(pa.string()), pa.array(vecs, pa.binary())], ["vec_id", "key", "label", "vec"])

    picked = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return picked.mapInArrow(run, "vec_id long, key binary, label string, vec binary")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares don't overflow and no digit is lost."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(classes: DataFrame, slots: int = 64) -> dict[int, np.ndarray]:
    """Axes (columns, most spread first) by number of dimensions, from the
    second moments of all vectors. Partial sums are added up in two rounds; the
    driver gets one d x d matrix per dimension count."""

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches, rows=4096):
            by_size: dict[int, list[bytes]] = {}
            for v in batch.column("vec").to_pylist():
                by_size.setdefault(len(v) // 8, []).append(v)
            for d, rows in by_size.items():
                x = _unit(np.frombuffer(b"".join(rows)).reshape(-1, d))
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "row": pa.array([r.tobytes() for r in m], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(r) for r in table.column("row").to_pylist())
        return pa.table({"d": table.column("d")[:1], "i": table.column("i")[:1], "row": pa.array([total.tobytes()], pa.binary())})

    parts = classes.select("vec").mapInArrow(partial_sums, "d int, i int, row binary").withColumn("slot", F.spark_partition_id() % slots)
    once = parts.groupBy("d", "i", "slot").applyInArrow(add, "d int, i int, row binary")
    axes: dict[int, dict[int, np.ndarray]] = {}
    for r in once.groupBy("d", "i").applyInArrow(add, "d int, i int, row binary").collect():
        axes.setdefault(r["d"], {})[r["i"]] = np.frombuffer(r["row"])
    return {d: np.linalg.eigh(np.array([rows[i] for i in range(d)]))[1][:, ::-1].copy() for d, rows in axes.items()}


def similar_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, inner: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) with cosine >= threshold; ``inner``: a is b, i < j."""
    d = a.shape[1]
    a, b = _scaled(a), _scaled(b)
    za, zb = _unit(a) @ axes, _unit(b) @ axes
    cuts = sorted({min(d, c) for c in (8, 16, 32)} | {d})
    rest = lambda z, c: np.sqrt((z[:, c:] ** 2).sum(axis=1))
    dots = za[:, : cuts[0]] @ zb[:, : cuts[0]].T
    i, j = np.nonzero(dots + rest(za, cuts[0])[:, None] * rest(zb, cuts[0]) >= threshold - SLACK)
    if inner:
        i, j = i[i < j], j[i < j]
    found_i, found_j = [], []
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        dot = dots[p, q]
        for c, e in zip(cuts, cuts[1:], strict=False):
            dot = dot + np.einsum("ij,ij->i", za[p, c:e], zb[q, c:e])
            keep = dot + rest(za, e)[p] * rest(zb, e)[q] >= threshold - SLACK
            p, q, dot = p[keep], q[keep], dot[keep]
        cosine = np.einsum("ij,ij->i", a[p], b[q]) / (np.linalg.norm(a[p], axis=1) * np.linalg.norm(b[q], axis=1))
        found_i.append(p[cosine >= threshold])
        found_j.append(q[cosine >= threshold])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (i, j)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, tile: int = 1024) -> DataFrame:
    """Link vectors of equal label whose cosine is ``threshold`` or more.

    ``embeddings``: vec_id, embedding, label; other columns are ignored.
    Returns one row per vector: vec_id, n_links (other vectors linked
    directly), component_id (smallest vec_id reachable), kept (vec_id is the
    component_id). Exact copies are compared once and counted as often as they
    occur; a tile hands on a count per vector and the links that connect it,
    never its pairs.

    Null vectors and labels, zero vectors, vectors with null, NaN or infinite
    components, vectors of different lengths and rows without vec_id link with
    nothing (the latter have null component and kept). Repeated rows are
    vectors of their own, linked with each other. An empty table gives no rows.
    """
    rows = stored(_vectors(embeddings), "vectors")
    classes = stored(rows.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec")), "vector-classes")
    axes = principal_axes(classes)
    width = float(np.sqrt(2 - 2 * threshold) + 1e-6)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = [s for s in product((-1, 0, 1), repeat=AXES) if s > (0,) * AXES]
        for batch in slices(batches, rows=4096):
            cells = []
            for v in batch.column("vec").to_pylist():
                x = np.frombuffer(v)
                at = np.floor((_unit(x[None])[0] @ axes[len(x)])[:AXES] / width).astype(int)
                cells.append([len(x), *at, *[0] * (AXES - len(at))])
            for role, step in enumerate([(0,) * AXES, *ahead]):
                cell = pa.array(["%d" % c[0] + "".join(" %d" % (p + s) for p, s in zip(c[1:], step, strict=True)) for c in cells])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), batch.column("n"), batch.column("label"), batch.column("vec"), cell, pa.array(np.full(len(cells), min(role, 1), np.int32))],
                    ["rep", "n", "label", "vec", "cell", "visits"])

    dealt = classes.select("rep", "n", "label", "vec").mapInArrow(deal, "rep long, n long, label string, vec binary, cell string, visits int")
    counts = dealt.groupBy("label", "cell").agg(F.sum(1 - F.col("visits")).alias("homes"), F.sum("visits").alias("visitors")).filter(
        "homes > 1 or homes > 0 and visitors > 0")
    homes, visitors = (F.expr(f"cast(({c} + {tile - 1}) div {tile} as int)") for c in ("homes", "visitors"))
    placed = dealt.join(counts, ["label", "cell"]).withColumn("h", homes).withColumn("g", visitors)
    placed = placed.withColumn("own", F.pmod(F.hash("rep"), F.when(F.col("visits") == 1, F.col("g")).otherwise(F.col("h"))))
    tiles = F.expr("""if(visits = 1,
        transform(sequence(0, h - 1), b -> struct(1 as kind, own as a, b as b)),
        concat(transform(sequence(0, h - 1), b -> struct(0 as kind, least(own, b) as a, greatest(own, b) as b)),
               if(g > 0, transform(sequence(0, g - 1), a -> struct(1 as kind, a as a, own as b)), array())))""")
    placed = placed.select("rep", "n", "vec", "label", "cell", "visits", "own", F.explode(tiles).alias("t")).select(
        F.xxhash64("label", "cell", "t.kind", "t.a", "t.b").alias("tile"), F.concat_ws("\u0001", "label", "cell").alias("of"),
        "rep", "n", "vec", F.expr("if(t.kind = 1, visits, if(own = t.a, if(t.a = t.b, 2, 0), 1))").alias("side"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "tile"):
            if group.num_rows < 2:
                continue
            of, side = np.array(group.column("of").to_pylist()), group.column("side").to_numpy()
            rep, n, vec = group.column("rep").to_numpy(), group.column("n").to_numpy(), group.column("vec").to_pylist()
            for cell in set(of.tolist()):  # one, but for equal hashes
                inner = np.flatnonzero((of == cell) & (side == 2))
                left, right = (inner, inner) if len(inner) else (np.flatnonzero((of == cell) & (side == s)) for s in (0, 1))
                if not len(left) or not len(right):
                    continue
                d = len(vec[left[0]]) // 8
                a, b = (np.frombuffer(b"".join(vec[k] for k in rows)).reshape(-1, d) for rows in (left, right))
                i, j = similar_pairs(a, b, axes[d], threshold, bool(len(inner)))
                i, j = left[i], right[j]
                links = np.zeros(len(rep), np.int64)
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(rep[hit]), pa.array(links[hit]), pa.array(rep[_roots(len(rep), i, j)[hit]])], ["node", "links", "root"])

    found = stored(placed.repartition("tile").sortWithinPartitions("tile").mapInArrow(compare, "node long, links long, root long"), "vector-links")
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("key", "rep", "n").join(sums, F.col("rep") == sums["node"], "left").drop("node")
    named = named.join(roots, named["rep"] == roots["node"], "left").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("component"))
    out = rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
