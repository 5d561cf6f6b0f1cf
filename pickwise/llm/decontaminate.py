"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds short benchmark items inside long documents. Items are partitioned by
size (word shingles, classes of doubling size) and a document is searched, for
each class, in overlapping windows of twice the class's largest size: an item's
passage then lies whole in a window and makes up enough of it for MinHash to
see. An item and a window are candidates when they agree in any of ``hashes``
minimum values (bands of one row); a passage that holds ``threshold`` of an
item agrees in each with a chance of 0.8 * n / (4 n + 0.2 n) at worst, so with
128 hashes one in 10^11 is missed. Candidates are verified by exact shingle
containment in the whole document.

The items are the query set: it is sent to the tasks in blocks of bounded size,
each of which passes over all documents. No document is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import slices, text_bytes, words

MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(tokens: list[bytes], known: dict[bytes, int], limit: int = 400_000) -> np.ndarray:
    """64-bit hashes of the tokens; ``known`` spares hashing words again."""
    if len(known) > limit:
        known.clear()
    for t in set(tokens).difference(known):
        known[t] = xxhash.xxh3_64_intdigest(t)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per run of ``width`` words; all words where they are fewer."""
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n if width else 0, width, np.uint64)
    for i in range(width):
        out = (out ^ hashes[i : i + n]) * MIX
        out ^= out >> np.uint64(29)
    return out


def families(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the hash functions, from a rule."""
    a = np.array([xxhash.xxh64_intdigest(b"a %d" % i) | 1 for i in range(hashes)], np.uint64)
    b = np.array([xxhash.xxh64_intdigest(b"b %d" % i) for i in range(hashes)], np.uint64)
    return a, b


def _spread(v: np.ndarray, a: np.uint64, b: np.uint64) -> np.ndarray:
    v = (v ^ (v >> np.uint64(32))) * a + b
    return v ^ (v >> np.uint64(31))


class Items:
    """A block of benchmark items, ready to be searched for."""

    def __init__(self, rows: list[tuple[int, bytes]], width: int, hashes: int):
        self.width, (self.a, self.b) = width, families(hashes)
        self.ids, self.shingles, self.texts = [], [], []
        known: dict[bytes, int] = {}
        for item, text in rows:
            w = words(text)
            if w:
                self.ids.append(item)
                self.shingles.append(np.unique(shingle_hashes(word_hashes(w, known), width)))
                self.texts.append({b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))})
        self.any = np.unique(np.concatenate(self.shingles)) if self.ids else np.zeros(0, np.uint64)
        of: dict[int, list[int]] = {}
        for k, s in enumerate(self.shingles):
            of.setdefault(max(3, int(len(s) - 1).bit_length()), []).append(k)
        # per size class and hash function: sorted minima and the item of each
        self.classes = {c: [self._minima(own, i) for i in range(hashes)] for c, own in of.items()}

    def _minima(self, own: list[int], i: int) -> tuple[np.ndarray, np.ndarray]:
        low = np.array([_spread(self.shingles[k], self.a[i], self.b[i]).min() for k in own], np.uint64)
        order = np.argsort(low, kind="stable")
        return low[order], np.array(own)[order]

    def candidates(self, doc: np.ndarray) -> set[int]:
        """Items that agree with a window of the document in a minimum. A
        window without a shingle of any item agrees with none, so blocks of
        the document without one are left out beforehand."""
        found: set[int] = set()
        if not len(doc) or not len(self.any):
            return found
        near = np.minimum(np.searchsorted(self.any, doc), len(self.any) - 1)
        at = np.flatnonzero(self.any[near] == doc)
        if not len(at):
            return found
        for c, tables in self.classes.items():
            step = 1 << c
            pieces = np.unique(at // step)
            pieces = np.unique(np.concatenate([pieces, pieces - 1, pieces + 1]))
            pieces = pieces[(pieces >= 0) & (pieces * step < len(doc))]
            gap = np.flatnonzero(np.diff(pieces) != 1) + 1
            for run in np.split(pieces, gap):
                part = doc[run[0] * step : (run[-1] + 1) * step]
                starts = np.arange(0, len(part), step)
                for i, (low, own) in enumerate(tables):
                    least = np.minimum.reduceat(_spread(part, self.a[i], self.b[i]), starts)
                    window = np.minimum(least, np.append(least[1:], np.uint64(0xFFFFFFFFFFFFFFFF)))
                    first, last = np.searchsorted(low, window, "left"), np.searchsorted(low, window, "right")
                    for p in np.flatnonzero(last > first):
                        found.update(own[first[p] : last[p]].tolist())
        return found

    def contained(self, text: bytes | None, known: dict[bytes, int], threshold: float) -> list[tuple[int, int, int]]:
        """(item, shingles of the item, shingles of it in the text)."""
        w = words(text)
        if not w:
            return []
        some = self.candidates(shingle_hashes(word_hashes(w, known), self.width))
        if not some:
            return []
        wanted = set().union(*(self.texts[k] for k in some))
        width = min(self.width, len(w))
        there = wanted.intersection(map(b" ".join, zip(*(w[i:] for i in range(width)), strict=False)))
        counts = [(self.ids[k], len(self.texts[k]), len(self.texts[k] & there)) for k in sorted(some)]
        return [x for x in counts if x[2] >= threshold * x[1]]


def item_blocks(benchmark: DataFrame, block_chars: int, block_items: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of about ``block_chars`` characters and
    ``block_items`` items, dealt by a hash of the id."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    items = items.filter("item_id is not null and text is not null").distinct()
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // block_chars))
    for k in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        yield [(r["item_id"], bytes(r["text"])) for r in own.collect()]


def clean(
    documents: DataFrame, benchmark: DataFrame, shingle_words: int = 5, threshold: float = 0.8,
    hashes: int = 128, block_chars: int = 8 << 20, block_items: int = 10_000,
) -> DataFrame:
    """The rows of ``documents``, all columns, whose text holds no benchmark
    item (see ``leaks``)."""
    context = documents.sparkSession.sparkContext
    for rows in item_blocks(benchmark, block_chars, block_items):
        sent = context.broadcast(rows)  # bounded by block_chars and block_items

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, known = Items(sent.value, shingle_words, hashes), {}
            for batch in slices(batches):
                yield batch.filter(pa.array([not items.contained(text, known, threshold) for text in text_bytes(batch.column("text"))], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents


def leaks(
    documents: DataFrame, benchmark: DataFrame, shingle_words: int = 5, threshold: float = 0.8,
    hashes: int = 128, block_chars: int = 8 << 20, block_items: int = 10_000,
) -> DataFrame:
    """Benchmark items held by documents: doc_id, item_id, n_shingles (distinct
    of the item), n_shared (of those in the document), containment.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text; other
    columns are ignored. A-Z is lower-cased. A text of fewer than
    ``shingle_words`` words is one shingle, its whole word sequence, so such an
    item is found in equal sequences alone. Null, empty and blank texts hold
    and are nothing; rows with a null item_id are no items; a document with a
    null id is reported with it; repeated documents are reported each, repeated
    items once; empty tables give no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    context = documents.sparkSession.sparkContext
    out = None
    for rows in item_blocks(benchmark, block_chars, block_items):
        sent = context.broadcast(rows)  # bounded by block_chars and block_items

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, known = Items(sent.value, shingle_words, hashes), {}
            for batch in slices(batches):
                docs, ids, sizes, shared = [], [], [], []
                for doc, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                    for item, n, k in items.contained(text, known, threshold):
                        docs.append(doc)
                        ids.append(item)
                        sizes.append(n)
                        shared.append(k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, ids, sizes, shared)], ["doc_id", "item_id", "n_shingles", "n_shared"])

        found = docs.mapInArrow(run, "doc_id long, item_id long, n_shingles long, n_shared long")
        out = found if out is None else out.unionByName(found)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
