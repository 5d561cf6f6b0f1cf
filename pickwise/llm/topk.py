"""Exact top-k search by norm-bucketed retrieval.

Vectors are grouped by length into buckets whose lengths differ by at most a
tenth, and buckets are cut into tiles by a hash. A few long and a few drawn
vectors give each query a score that its k-th best can't be below. Divided by
the query's length and a bucket's greatest length, it is the cosine that a
vector of the bucket has to reach: a query visits no bucket where that is over
1. In a tile each query takes what leaves fewer vectors: pruning by length
(the vectors long enough), or by coordinates (a vector with that cosine has
each unit coordinate in an interval around the query's; the query's largest
coordinates are looked up in sorted columns). What is left is verified by exact
integer products.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.shared import slices, stored

RATIO = 0.9  # of the shortest to the longest length of a bucket
TILE = 8192  # vectors of a tile, about
SEEDS = 1024  # long and drawn vectors that give the first bounds, each
COORDINATES = 4
SLACK = 1e-9
#: Integers up to here are exact in double precision.
EXACT = float(1 << 53)


def _fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether products of rows of a and b and all their partial sums are exact in double precision."""
    return not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b (doubles that hold
    integers); Python integers, cut off at the limits of a long, where doubles are too short."""
    if _fits(a, b):
        return a @ b.T
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object)
    most = (1 << 63) - 1
    return np.array([[max(-most - 1, min(most, v)) for v in row] for row in whole(a).dot(whole(b).T)], object)


def _integers(embeddings: DataFrame, asks: Column, scale: float) -> DataFrame:
    """(row, vec_id, asks, size, bucket, length, vec): floor(scale * x) of the
    vectors that take part, ``vec`` the whole numbers as doubles in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096):
            lists = batch.column("embedding")
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False) * scale) + 0.0
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            keep = [i for i, (n, e) in enumerate(zip(sizes, ends, strict=True)) if n and np.isfinite(flat[e - n : e]).all()]
            vectors = [flat[ends[i] - sizes[i] : ends[i]] for i in keep]
            lengths = [_length(x) for x in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("row", "vec_id", "asks")]
                + [pa.array([len(x) for x in vectors], pa.int32()), pa.array([_bucket(x) for x in lengths], pa.int32()), pa.array(lengths, pa.float64()), pa.array([x.tobytes() for x in vectors], pa.binary())],
                ["row", "vec_id", "asks", "size", "bucket", "length", "vec"])

    picked = embeddings.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(asks, F.lit(False)).alias("asks"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    return picked.mapInArrow(run, "row long, vec_id long, asks boolean, size int, bucket int, length double, vec binary")


def _length(x: np.ndarray) -> float:
    top = float(np.abs(x).max())
    return top * float(np.linalg.norm(x / top)) if top else 0.0


def _bucket(length: float) -> int:
    """Number of the bucket of a length; zero and infinite (overflown) lengths have their own."""
    return int(np.ceil(log(length) / -log(RATIO))) if 0 < length < np.inf else -(1 << 30) if not length else 1 << 30


def _matrix(vec: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(vec.to_pylist())).reshape(-1, size)


def _floor(scores: np.ndarray, k: int) -> float:
    """A double not above the k-th largest score; minus infinity if there are fewer."""
    if len(scores) < k:
        return -np.inf
    low = sorted(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]
    return float(low) - SLACK * abs(float(low))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, largest first, ties by id (nulls last)."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], int)
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Tile:
    """Vectors of a bucket, longest first, and their unit coordinates."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, lengths: np.ndarray, vectors: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.rows, self.ids, self.lengths, self.vectors = rows[order], ids[order], lengths[order], vectors[order]
        self.columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def column(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Unit coordinate f in order, and whose it is."""
        if f not in self.columns:
            unit = np.divide(self.vectors[:, f], self.lengths, out=np.zeros(len(self.lengths)), where=self.lengths > 0)
            order = np.argsort(unit, kind="stable")
            self.columns[f] = unit[order], order
        return self.columns[f]

    def long_enough(self, length: float, floor: float) -> int:
        """How many vectors, longest first, are long enough to reach ``floor``."""
        if floor <= 0 or length <= 0:
            return len(self.lengths)
        return int(np.searchsorted(-self.lengths, -(floor / length) * (1 - SLACK), "right"))

    def near_enough(self, unit: np.ndarray, cosine: float) -> list[tuple[int, int, int]]:
        """For the largest coordinates f of a unit query: f and the part of its
        sorted column that vectors of at least this cosine lie in."""
        out = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:COORDINATES].tolist():
            q = min(max(float(unit[f]), -1.0), 1.0)
            across = np.sqrt(max(1 - cosine * cosine, 0.0)) * np.sqrt(1 - q * q)
            low = q * cosine - across if q > -cosine else -1.0
            high = q * cosine + across if q < cosine else 1.0
            values = self.column(f)[0]
            out.append((f, int(np.searchsorted(values, low - 1e-7, "left")), int(np.searchsorted(values, high + 1e-7, "right"))))
        return out

    def candidates(self, length: float, unit: np.ndarray, floor: float) -> tuple[int, np.ndarray | None]:
        """Vectors that may reach ``floor``: the first n by length, or (n, places) by coordinates."""
        n = self.long_enough(length, floor)
        if not n or floor <= 0 or length <= 0:
            return n, None
        cosine = floor / (length * self.lengths[0]) * (1 - SLACK)
        spans = sorted(self.near_enough(unit, min(cosine, 1.0)), key=lambda s: s[2] - s[1])
        expected = n * float(np.prod([(b - a) / len(self.lengths) for _, a, b in spans]))  # as if coordinates were independent
        if 4 * expected >= n:
            return n, None
        f, a, b = spans[0]
        places = self.columns[f][1][a:b]
        for f, a, b in spans[1:]:
            if len(places) < 64 or 2 * (b - a) >= len(self.lengths):
                break
            inside = np.zeros(len(self.lengths), bool)
            inside[self.columns[f][1][a:b]] = True
            places = places[inside[places]]
        return n, places[places < n]

    def search(self, rows: np.ndarray, queries: np.ndarray, lengths: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query with any: its number, and places and scores of the best k
        vectors other than itself that reach its floor."""
        by_length: list[tuple[int, int]] = []
        for i in range(len(queries)):
            unit = queries[i] / lengths[i] if lengths[i] > 0 else queries[i]
            n, places = self.candidates(float(lengths[i]), unit, float(floors[i]))
            if places is None:
                by_length += [(n, i)] * (n > 0)
            elif len(places):
                yield from self._top(i, rows[i], places, products(self.vectors[places], queries[i : i + 1])[:, 0], floors[i], k)
        by_length.sort()
        for at in range(0, len(by_length), 32):
            some = by_length[at : at + 32]
            scores = products(self.vectors[: some[-1][0]], queries[[i for _, i in some]])
            for j, (n, i) in enumerate(some):
                yield from self._top(i, rows[i], np.arange(n), scores[:n, j], floors[i], k)

    def _top(self, i: int, row: int, places: np.ndarray, scores: np.ndarray, floor: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        keep = (scores >= floor) & (self.rows[places] != row)
        places, scores = places[keep], scores[keep]
        if len(places):
            top = best(scores, self.ids[places], k)
            yield i, places[top], scores[top]


def _floors(asking: DataFrame, vectors: DataFrame, classes: DataFrame, k: int, seeds: int) -> DataFrame:
    """``asking`` with ``floor``, which each query's k-th best score can't be
    below, and ``reach``, the length that a vector needs for it.

    The seeds are about ``seeds`` drawn vectors and as many of the longest bucket
    for each of the 16 most frequent sizes (so their number is bounded; queries of
    other sizes have no floor). They only give bounds; all vectors are searched."""
    sizes = classes.groupBy("size").agg(F.sum("n").alias("n_size"), F.max("bucket").alias("top_bucket")).orderBy(F.desc("n_size"), "size").limit(16)
    chosen = classes.join(sizes, "size").select("size", "bucket", F.greatest(seeds / F.col("n_size"), F.when(F.col("bucket") == F.col("top_bucket"), seeds / F.col("n"))).alias("share"))
    drawn = vectors.join(F.broadcast(chosen), ["size", "bucket"]).filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    table = drawn.select("size", "row", "vec").toArrow()
    given: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    of = table.column("size").to_numpy()
    for size in np.unique(of).tolist():
        own = table.take(pa.array(np.flatnonzero(of == size)))
        given[size] = own.column("row").to_numpy(), _matrix(own.column("vec"), size)
    sent = asking.sparkSession.sparkContext.broadcast(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64):
            floors = np.full(batch.num_rows, -np.inf)
            of, rows = batch.column("size").to_numpy(), batch.column("row").to_numpy()
            for size in np.unique(of).tolist():
                seed_rows, seed_vectors = sent.value.get(size, (np.zeros(0, int), np.zeros((0, size))))
                own = np.flatnonzero(of == size)
                scores = products(_matrix(batch.column("vec").take(pa.array(own)), size), seed_vectors)
                floors[own] = [_floor(s[seed_rows != rows[i]], k) for i, s in zip(own, scores, strict=True)]
            lengths = batch.column("length").to_numpy()
            reach = np.where(floors > 0, floors / np.maximum(lengths, 1e-300) * (1 - SLACK), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors), pa.array(reach)], [*batch.schema.names, "floor", "reach"])

    return asking.mapInArrow(run, "row long, vec_id long, size int, length double, vec binary, floor double, reach double")


def _compare(k: int):
    """Search tiles: rows sorted by tile, its vectors before its queries."""
    names = ["asked", "query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tile = None, [], None
        for batch in slices(batches, rows=256):
            keys = np.stack([batch.column(c).to_numpy() for c in ("size", "bucket", "tile", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part, key = batch.slice(a, b - a), tuple(keys[:, a].tolist())
                if key[:3] != at:
                    at, held, tile = key[:3], [], None
                if key[3] == 0:
                    held.append(part)
                    continue
                if tile is None and held:
                    own = pa.Table.from_batches(held)
                    ids = own.column("vec_id").combine_chunks()
                    # null ids last
                    tile = Tile(own.column("row").to_numpy(), ids.fill_null((1 << 63) - 1).to_numpy(), own.column("length").to_numpy(), _matrix(own.column("vec"), key[0]))
                    nulls, held = set(own.column("row").to_numpy()[ids.is_null().to_numpy(zero_copy_only=False)].tolist()), []
                if tile is None:
                    continue
                rows = part.column("row").to_numpy()
                found = list(tile.search(rows, _matrix(part.column("vec"), key[0]), part.column("length").to_numpy(), part.column("floor").to_numpy(), k))
                if found:
                    asked = np.repeat([i for i, _, _ in found], [len(p) for _, p, _ in found])
                    places = np.concatenate([p for _, p, _ in found])
                    ids = pa.array([None if r in nulls else v for r, v in zip(tile.rows[places].tolist(), tile.ids[places].tolist(), strict=True)], pa.int64())
                    scores = pa.array([int(v) for _, _, s in found for v in s], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(rows[asked]), part.column("vec_id").take(pa.array(asked)), ids, scores], names)

    return run


def search(embeddings: DataFrame, queries: Column, k: int = 10, scale: float = 1024.0, tile: int = TILE, seeds: int = SEEDS) -> DataFrame:
    """The ``k`` vectors of highest inner product for each query, by exact integers.

    ``embeddings``: vec_id, embedding; other columns are ignored, but may be used
    by ``queries``, the condition that makes a row a query (null: it doesn't).
    Components become floor(``scale`` * x). Returns query_id, rank (from 1),
    vec_id, score; ties go to the smaller vec_id, null ones last. A query is
    compared with every row but itself, so copies of it and rows that repeat its
    id are found; each of the latter is a query of its own.

    Vectors that are null, empty or hold null or non-finite components (before
    or after scaling) take no part; vectors of another number of components
    aren't compared. Zero vectors score 0. Scores beyond a long count as its
    limits. A query without any candidate gives no row; nor does an empty table.
    """
    vectors = stored(_integers(embeddings, queries, scale), "topk-vectors")
    classes = vectors.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))
    classes = stored(classes.withColumn("tiles", F.ceil(F.col("n") / tile).cast("int")), "topk-buckets")
    asking = stored(_floors(vectors.filter("asks").select("row", "vec_id", "size", "length", "vec"), vectors, classes, k, seeds), "topk-asking")
    # no query of the size visits a bucket whose vectors are all shorter than the least reach
    least = asking.groupBy("size").agg(F.min("reach").alias("least"))
    visited = classes.join(least, "size").filter("longest >= least").select("size", "bucket", "tiles")
    tiles = vectors.join(visited, ["size", "bucket"]).select(
        "size", "bucket", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int").alias("tile"), F.lit(0).alias("kind"), "row", "vec_id", "length", F.lit(None).cast("double").alias("floor"), "vec")
    visits = asking.join(classes, "size").filter("longest >= reach").select(
        "size", "bucket", F.explode(F.expr("sequence(0, tiles - 1)")).alias("tile"), F.lit(1).alias("kind"), "row", "vec_id", "length", "floor", "vec")
    dealt = tiles.unionByName(visits).repartition("size", "bucket", "tile").sortWithinPartitions("size", "bucket", "tile", "kind")
    found = dealt.mapInArrow(_compare(k), "asked long, query_id long, vec_id long, score long")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
