"""SimHash near-dedup with pivot distance tables.

Distinct fingerprints carry their Hamming distances to reference fingerprints.
Two fingerprints within ``max_bits`` of each other differ by no more than that
in any of these distances (triangle inequality), so pairs that differ more are
discarded; survivors are verified on the fingerprints themselves.

Pairs meet in buckets: of ``segments`` bit segments, two near fingerprints
agree on all but ``max_bits`` at least, so every choice of the others is a
table, and its bits are the bucket. Inside a bucket only links that join
something new are sought (a fingerprint once reached is not compared with
others again until its turn comes), so dense groups don't cost all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.components import components
from pickwise.llm.shared import groups, slices, stored, text_bytes, words

SEED = 42
PIVOTS = 16


def fingerprint(text: bytes | None, shingle_words: int) -> int:
    """A bit is 1 if it is set in over half the XXH64 of the shingles, repeats
    included; fewer words than a shingle make one shingle; no word: 0."""
    w = words(text)
    if not w:
        return 0
    n = max(1, len(w) - shingle_words + 1)
    shingles = map(b" ".join, zip(*(w[i:] for i in range(shingle_words)), strict=False)) if len(w) >= shingle_words else [b" ".join(w)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 64):
        bits = np.unpackbits(hashes[at : at + 255 * 64].view(np.uint8), bitorder="little").reshape(-1, 64)
        whole = len(bits) // 255 * 255
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, fp) of each row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(t, shingle_words) for t in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return docs.mapInArrow(run, "doc_id long, fp long")


def pivots() -> np.ndarray:
    """Reference fingerprints, from a rule."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i) for i in range(PIVOTS)], np.uint64)


def bucket_masks(max_bits: int, segments: int) -> list[int]:
    """Bit masks of the tables: all choices of segments - max_bits segments."""
    cuts = [round(i * 64 / segments) for i in range(segments + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, segments - max_bits)]


def spanning_links(fp: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, np.ndarray]]:
    """Links (row, rows) that connect rows exactly as all links would."""
    out, left = [], np.arange(len(fp))
    while len(left) > 1:
        turn, left = [int(left[0])], left[1:]
        while turn and len(left):
            i = turn.pop()
            near = np.abs(table[left] - table[i]).max(axis=1) <= max_bits
            at = left[near]
            hit = np.bitwise_count(fp[at] ^ fp[i]) <= max_bits
            if hit.any():
                out.append((i, at[hit]))
                turn.extend(at[hit].tolist())
                near[near] = hit
                left = left[~near]
    return out


def links(prints: DataFrame, max_bits: int, segments: int, tile: int) -> DataFrame:
    """Edges (u, v) between near fingerprints: as many as connect what is
    linked. ``prints``: one row (fp) per distinct fingerprint."""
    masks = np.array(bucket_masks(max_bits, segments), np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, odd = pivots(), np.uint64(0x9E3779B97F4A7C15)
        for batch in slices(batches, rows=4096):
            fp = batch.column("fp").to_numpy().view(np.uint64)
            table = np.bitwise_count(fp[:, None] ^ refs).astype(np.uint8)
            table = pa.array([row.tobytes() for row in table], pa.binary())
            for t, mask in enumerate(masks):
                key = (fp & mask) * odd + np.uint64(t)  # odd factor: equal keys of a table are equal bits
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("fp"), table], ["key", "fp", "table"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "tile"):
            if group.num_rows < 2:
                continue
            fp = group.column("fp").to_numpy().view(np.uint64)
            table = np.frombuffer(b"".join(group.column("table").to_pylist()), np.uint8).reshape(-1, PIVOTS).astype(np.int16)
            found = spanning_links(fp, table, max_bits)
            if found:
                own = fp.view(np.int64)
                u = np.repeat([own[i] for i, _ in found], [len(j) for _, j in found])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(own[np.concatenate([j for _, j in found])])], ["u", "v"])

    dealt = prints.select("fp").mapInArrow(deal, "key long, fp long, table binary")
    counts = dealt.groupBy("key").count().filter("count > 1")
    tiles = F.expr(f"cast((count + {tile - 1}) div {tile} as int)")
    placed = dealt.join(counts, "key").withColumn("tiles", tiles).withColumn("own", F.pmod(F.hash("fp"), F.col("tiles")))
    placed = placed.select("key", "fp", "table", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    placed = placed.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "fp", "table")
    return placed.repartition("tile").sortWithinPartitions("tile").mapInArrow(link, "u long, v long")


def _unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def near_duplicates(documents: DataFrame, shingle_words: int = 3, max_bits: int = 3, segments: int = 5, tile: int = 16384) -> DataFrame:
    """Group documents (doc_id, text; other columns are ignored) whose SimHash
    fingerprints are linked by ``max_bits`` or fewer differing bits.

    Returns one row per document: doc_id, fingerprint (16 lowercase hex
    digits), component_id (smallest doc_id reachable). Buckets of over
    ``tile`` fingerprints are split into tiles that meet pairwise.

    Null, empty and blank texts have fingerprint 0 and are linked like any
    other. Very long texts count whole. Repeated rows share fingerprint and
    component. A document with a null id links others like any, but never names
    a component: where no document of it has an id, that is null. An empty table
    gives no rows.
    """
    docs = stored(fingerprints(documents, shingle_words), "simhash")
    prints = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    roots = components(links(prints, max_bits, segments, tile))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return docs.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``documents``, all columns, that stand for their group of
    near duplicates: that of the smallest doc_id; of rows that repeat this id
    the one with the smallest text. Rows without an id stay. Only ids are
    grouped; texts move only if the ids that go are too many to send."""
    named = stored(near_duplicates(documents, shingle_words, max_bits).select("doc_id", "component_id"), "simhash-groups")
    ids = named.filter("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays"), F.count(F.lit(1)).alias("n"))
    ids = stored(ids.filter("stays = 0 or n > 1"), "simhash-removed")
    key, turn = _unused(documents, "id_of_row"), _unused(documents, "turn_of_row")
    keyed = documents.withColumn(key, F.col("doc_id").cast("long"))
    removed, repeated = (x.select(F.col("doc_id").alias(key)) for x in (ids, ids.filter("stays = 1")))
    single = keyed.join(removed, key, "left_anti").drop(key)
    first = Window.partitionBy(key).orderBy(F.col("text").asc_nulls_first())
    again = keyed.join(repeated, key, "left_semi").withColumn(turn, F.row_number().over(first)).filter(F.col(turn) == 1).drop(key, turn)
    return single.unionByName(again)
