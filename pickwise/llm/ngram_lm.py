"""Language-model scoring by deleted interpolation.

P(w | h) mixes the maximum-likelihood estimates of the bigram, the unigram and
a uniform share; the mixture weights depend on how often the context h was
seen (buckets of powers of two) and are learned by expectation-maximisation on
counts of training documents that are held out of the estimates meanwhile.

The model is never in one place. Documents are packed into batches; a batch
asks for the counts of its distinct n-grams, dealt over tasks by the n-gram's
hash, and gets them back in the order of its own keys. So a frequent word costs
one key per batch, whatever its share of the tokens. Keys and counts travel as
sorted, delta-coded, compressed arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.decontaminate import word_hashes
from pickwise.llm.shared import crc_fold, groups, slices, stored, text_bytes, words

# Words hold no space, so these hashes are no word's.
END = np.uint64(xxhash.xxh3_64_intdigest(b"end of text"))
BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"begin of text"))
UNSEEN, COUNTED, WEIGHTS = 0, 1, 2  # kinds of batches: not learned from; counted; counted, and the weights are learned on them
BUCKETS = 48
STEPS = 4  # bins per octave of the histogram that EM runs on


def pack(values: np.ndarray) -> bytes:
    """Bytes of the numbers, those of equal place together, compressed."""
    width = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def pack_batches(documents: DataFrame, folds: int, held_out: int, weights_fold: int, batch_bytes: int) -> DataFrame:
    """Documents packed by kind: (batch, kind, doc_ids, held, sizes, n_bytes, texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        sizes: dict[int, int] = {}
        made, part = 0, 0

        def out(kind: int) -> pa.RecordBatch:
            nonlocal made
            rows = waiting.pop(kind)
            text = zstandard.ZstdCompressor(level=1).compress(b"".join(r[2] for r in rows))
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made - 1], pa.int64()), pa.array([kind], pa.int32()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.bool_())), pa.array([[len(r[2]) for r in rows]], pa.list_(pa.int64())),
                 pa.array([sizes.pop(kind)], pa.int64()), pa.array([text], pa.binary())],
                ["batch", "kind", "doc_ids", "held", "sizes", "n_bytes", "texts"])

        for batch in slices(batches):
            part = batch.column("part")[0].as_py()
            for doc, fold, text in zip(batch.column("doc_id").to_pylist(), batch.column("fold").to_pylist(), text_bytes(batch.column("text")), strict=True):
                kind = UNSEEN if fold is None or fold == held_out else WEIGHTS if fold == weights_fold else COUNTED
                waiting.setdefault(kind, []).append((doc, fold == held_out, text or b""))
                sizes[kind] = sizes.get(kind, 0) + len(text or b"") + 8
                if sizes[kind] >= batch_bytes:
                    yield out(kind)
        for kind in list(waiting):
            yield out(kind)

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), crc_fold(F.col("doc_id"), folds).cast("int").alias("fold"), F.col("text").cast("binary").alias("text"),
        F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, "batch long, kind int, doc_ids array<long>, held array<boolean>, sizes array<long>, n_bytes long, texts binary")


def tokens(texts: bytes, sizes: list[int], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, their context's hashes, first token of each document)."""
    text, flat, lengths, at = zstandard.ZstdDecompressor().decompress(texts) if sum(sizes) else b"", [], [], 0
    for size in sizes:
        w = words(text[at : at + size])
        flat += w
        lengths.append(len(w) + 1)
        at += size
    ends = np.cumsum(lengths)
    here = np.empty(int(ends[-1]), np.uint64)
    inner = np.ones(len(here), bool)
    inner[ends - 1] = False
    here[ends - 1] = END
    here[inner] = word_hashes(flat, known)
    before = np.empty_like(here)
    before[1:] = here[:-1]
    starts = ends - lengths
    before[starts] = BEGIN
    return here, before, starts


def bigrams(before: np.ndarray, here: np.ndarray) -> np.ndarray:
    key = (before ^ (before >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + here * np.uint64(0xC2B2AE3D27D4EB4F)
    return (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def requests(batches: DataFrame, bits: int) -> DataFrame:
    """For each batch, order and part (leading ``bits`` of the key): the
    batch's distinct keys, and how often each occurs if the batch is learned from."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        for r in (r for batch in rows for r in batch.to_pylist()):
            here, before, starts = tokens(r["texts"], r["sizes"], known)
            extra = [BEGIN] * len(starts)  # the context that begins texts is counted like a word, but is no token
            for order, keys in ((1, np.concatenate([here, np.array(extra, np.uint64)])), (2, bigrams(before, here))):
                keys, counts = np.unique(keys, return_counts=True)
                at = [0, *np.searchsorted(keys, cuts), len(keys)]
                out = []
                for part, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    if b > a:
                        own = keys[a:b]
                        out.append((part, r["batch"], r["kind"], order, pack(np.diff(own, prepend=np.uint64(0))), pack(counts[a:b].astype(np.uint32)) if r["kind"] else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                    ["part", "batch", "kind", "gram", "keys", "counts"])

    return batches.select("batch", "kind", "sizes", "texts").mapInArrow(run, "part int, batch long, kind int, gram int, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """For each request the training count of its keys, and that in the
    weights' documents where the batch is of those. Rows with a null batch hold
    the sums over a part: tokens and types, with and without the weights' documents."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        for group in groups(rows, "part"):
            got = group.select(["batch", "kind", "gram", "keys", "counts", "part"]).to_pylist()
            out = []
            for order in (1, 2):
                own = [r for r in got if r["gram"] == order]
                if not own:
                    continue
                keys = [np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in own]
                counts = [unpack(r["counts"], np.uint32) if r["kind"] else np.zeros(len(k), np.uint32) for r, k in zip(own, keys, strict=True)]
                ends = np.cumsum([len(k) for k in keys])
                types, at = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(at, np.concatenate(counts), len(types)).astype(np.int64)
                fold = np.bincount(at, np.concatenate([c if r["kind"] == WEIGHTS else c * 0 for r, c in zip(own, counts, strict=True)]), len(types)).astype(np.int64)
                for r, a, b in zip(own, [0, *ends], ends, strict=False):
                    mine = at[a:b]
                    out.append((r["batch"], r["part"], r["kind"], order, pack(total[mine]), pack(fold[mine]) if r["kind"] == WEIGHTS else None, None))
                if order == 1:
                    word = types != BEGIN
                    rest = (total - fold)[word]
                    out.append((None, got[0]["part"], None, order, None, None, [int(total[word].sum()), int((total[word] > 0).sum()), int(rest.sum()), int((rest > 0).sum())]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["batch", "part", "kind", "gram", "total", "fold", "sums"])

    return asked.repartition("part").sortWithinPartitions("part").mapInArrow(
        run, "batch long, part int, kind int, gram int, total binary, fold binary, sums array<long>")


def _counts(row: dict, answer: list[dict], known: dict[bytes, int], without_fold: bool) -> tuple[np.ndarray, ...]:
    """Per token of a batch: its count, its context's, the bigram's; and where documents begin."""
    here, before, starts = tokens(row["texts"], row["sizes"], known)

    def of(order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = sorted((a for a in answer if a["gram"] == order), key=lambda a: a["part"])
        total = np.concatenate([unpack(a["total"], np.int64) for a in own])
        if without_fold:
            total = total - np.concatenate([unpack(a["fold"], np.int64) for a in own])
        types, at = np.unique(keys, return_inverse=True)
        return total, at

    total, at = of(1, np.concatenate([here, np.full(len(starts), BEGIN)]))
    own = total[at[: len(here)]]
    context = np.empty_like(own)
    context[1:] = own[:-1]
    context[starts] = total[at[len(here) :]]
    total, at = of(2, bigrams(before, here))
    return own, context, total[at], starts


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(int) + 1, 0), BUCKETS - 1)


def learn_weights(cells: list[tuple[int, int | None, int | None, int]], rounds: int = 60) -> np.ndarray:
    """Weights (bucket; bigram, unigram, uniform) by EM. A cell is (bucket, bin
    of bigram / uniform, bin of unigram / uniform, held-out tokens); a null bin
    is an estimate of 0. One token of each kind is added to every bucket."""
    out = np.full((BUCKETS, 3), 1 / 3)
    if cells:
        bucket = np.array([c[0] for c in cells])
        odds = np.array([[0.0 if c[1] is None else 2.0 ** (c[1] / STEPS), 0.0 if c[2] is None else 2.0 ** (c[2] / STEPS), 1.0] for c in cells])
        n = np.array([c[3] for c in cells], float)
        for _ in range(rounds):
            share = out[bucket] * odds
            share *= (n / share.sum(axis=1))[:, None]
            out = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + 1
            out /= out.sum(axis=1, keepdims=True)
        seen = np.bincount(bucket, n, BUCKETS) > 0
        for b in range(2, BUCKETS):
            if not seen[b]:
                out[b] = out[b - 1]  # no held-out token after so frequent a context
    out[0] = out[0] * [0, 1, 1]  # a context never seen has no bigram estimate
    return out / out.sum(axis=1, keepdims=True)


def score(
    documents: DataFrame, folds: int = 7, held_out: int = 2, weights_fold: int = 6,
    batch_bytes: int = 4 << 20, part_bytes: int = 16 << 20,
) -> DataFrame:
    """Score every whole text of ``documents`` (doc_id, text; other columns are
    ignored): doc_id, held_out, n_tokens (words and one end), n_known,
    train_tokens, base_score (add-one unigram model) and score (the model), sums
    of log10 probabilities.

    Learns from documents whose crc32(id) mod ``folds`` isn't ``held_out``; the
    weights come from fold ``weights_fold``, whose counts are left out of the
    estimates meanwhile. Null and empty texts hold the end alone. Rows with a
    null id are scored, not learned from and not held out; repeated rows count
    and are scored each; without anything to learn from every token has
    probability 1; an empty table gives no rows. A batch holds about
    ``batch_bytes`` of text (or one longer text), a part the n-grams of about
    ``part_bytes``.
    """
    packed = pack_batches(documents, folds, held_out, weights_fold, batch_bytes)
    batches = stored(packed, "lm-batches")
    n_bytes = batches.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = max(4, int(n_bytes // part_bytes).bit_length())
    known = stored(answers(requests(batches, bits)), "lm-counts")
    sums = known.filter("batch is null").agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(4)]).first()
    n, v, n_rest, v_rest = (int(x) for x in sums)
    known = known.filter("batch is not null").drop("sums")
    text, held = ["batch", "sizes", "texts"], ["batch", "part", "gram", "total", "fold"]

    def histogram(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        cells: dict[tuple, int] = {}
        for row in left.to_pylist():
            own, context, both, _ = _counts(row, right.to_pylist(), {}, without_fold=True)
            with np.errstate(divide="ignore"):
                one = np.round(STEPS * np.log2(own / max(n_rest, 1) * (v_rest + 1)))
                two = np.round(STEPS * np.log2(both / np.maximum(context, 1) * (v_rest + 1)))
            none = -9999
            table = np.stack([_bucket(context), np.where(np.isfinite(two), two, none), np.where(np.isfinite(one), one, none)], axis=1).astype(np.int64)
            code = (table[:, 0] * 20_000 + table[:, 1] + 10_000) * 20_000 + table[:, 2] + 10_000
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            for (b, x, y), c in zip(table[first].tolist(), count.tolist(), strict=True):
                cells[b, x, y] = cells.get((b, x, y), 0) + c
        rows = [(b, None if x == none else x, None if y == none else y, c) for (b, x, y), c in cells.items()] if cells else []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["bucket", "two", "one", "n"])

    learned_on = batches.filter(F.col("kind") == WEIGHTS).select(text).groupBy("batch")
    cells = learned_on.cogroup(known.filter(F.col("kind") == WEIGHTS).select(held).groupBy("batch")).applyInArrow(histogram, "bucket long, two long, one long, n long")
    # at most buckets x bins x bins rows, whatever the corpus
    weights = learn_weights([tuple(r) for r in cells.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect()])

    def evaluate(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            own, context, both, starts = _counts(row, right.to_pylist(), {}, without_fold=False)
            w = weights[_bucket(context)]
            p = w[:, 0] * both / np.maximum(context, 1) + w[:, 1] * own / max(n, 1) + w[:, 2] / (v + 1)
            base = np.log10((own + 1) / (n + v + 1))
            sizes = np.diff([*starts, len(own)])
            columns = (row["doc_ids"], row["held"], sizes, np.add.reduceat((own > 0).astype(np.int64), starts), np.add.reduceat(base, starts),
                       np.add.reduceat(np.log10(p), starts) if n else np.zeros(len(starts)))
            out.append(pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
                                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        return pa.concat_tables(out) if out else empty

    empty = pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
    scored = batches.select(*text, "doc_ids", "held").groupBy("batch").cogroup(known.select(held).groupBy("batch")).applyInArrow(
        evaluate, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
