"""Toxicity by nearest labelled examples.

Examples and documents are whole plain TF-IDF vectors, (1 + ln count) * idf at
unit length: every word counts. A document's nearest examples by exact cosine
come from a block-max inverted index: examples are dealt into blocks of similar
ones; rare terms have postings, frequent ones a matrix and a maximum in each
block. A block's best sum of rare terms and the maxima of the frequent ones
bound what any of its examples can reach; blocks that can't reach the k-th best
so far are never scored.

Neighbours vote with the square of their cosine, and more the more of it comes
from words (or word families, leading 4 and 5 bytes) that mark the toxic class;
this moves votes alone, never a cosine or who is a neighbour. A logistic curve
fitted on leave-one-out votes of the examples turns the vote into a
probability; the strongest voters are the evidence.

Words: A-Z lower-cased, ASCII digits and punctuation separate; each is known by
64 bits of hash. Words in no example count in a document's length as the rarest
ones.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import crc_fold, row_schema, slices, stored, text_bytes, with_row

BATCH = 64
BLOCK = 128
STEP = 1 << 20  # postings weighed at a time
PART = 4 << 20  # bytes of the packed index in a row
FREQUENT = 0.1  # terms in a larger share of the examples are frequent
SHARED = 0.02  # words in a larger share of the examples tell kinds of them
PRIOR = 0.1  # weight of one vote at the share of all examples
_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def counted(text: bytes | None) -> Counter[bytes]:
    """The distinct words of a whole text and how often each occurs."""
    return Counter(text.translate(_CLEAN).split()) if text else Counter()


def word_counts(words: Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words as hashes, in order, and how often each occurs."""
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return _summed(keys.view(np.int64), np.fromiter(words.values(), np.int64, len(words)))


def family_counts(words: Counter[bytes], known: dict[bytes, int] | None = None, stems: frozenset[bytes] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """The same for the leading 4 and 5 bytes of longer words, as a number that
    holds them (or of the ``known`` ones alone, by their numbers; ``stems`` are
    the first 4 bytes of those)."""
    found: dict[int, int] = {}
    for word, n in words.items() if known is None else [x for x in words.items() if x[0][:4] in stems]:
        for size in (4, 5):
            if len(word) > size:
                key = int.from_bytes(word[:size]) | size << 40 if known is None else known.get(word[:size])
                if key is not None:
                    found[key] = found.get(key, 0) + n
    return _summed(np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found)))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where groups of these sizes begin, and the end of the last."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return ends.astype(np.min_scalar_type(-int(ends[-1]) - 1))  # signed


def _idf(size: int, held: np.ndarray) -> np.ndarray:
    return np.log((1 + size) / (1 + held.astype(np.int64))) + 1


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers from 0 on in as few bytes as hold them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _spans(term: np.ndarray, count: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries ordered by term and count, those of one term and count make a span:
    how many spans each term has; each span's count and size."""
    heads = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (count[1:] != count[:-1])])[: len(term)])
    return _narrow(np.bincount(term[heads], minlength=terms)), _narrow(count[heads]), _narrow(np.diff(np.append(heads, len(term))))


class Postings:
    """Examples by term (numbered from 0) and how often each holds it. An
    example's weight for a term is (1 + ln count) * idf / its length."""

    def __init__(self, term: np.ndarray, row: np.ndarray, count: np.ndarray, idf: np.ndarray, length: np.ndarray):
        order = np.lexsort((count, term))
        self._hold(np.bincount(term, minlength=len(idf)), row[order], *_spans(term[order], count[order], len(idf)), idf, length)

    @classmethod
    def of(cls, terms: np.ndarray, held: np.ndarray, row: np.ndarray, spans: np.ndarray, counts: np.ndarray, sizes: np.ndarray, idf: np.ndarray, length: np.ndarray) -> Postings:
        """Those of the terms marked True; ``held``: how many entries each term has."""
        made, some = cls.__new__(cls), np.repeat(terms, spans)
        made._hold(np.where(terms, held, 0), row[np.repeat(terms, held)], np.where(terms, spans, 0), counts[some], sizes[some], idf, length)
        return made

    def _hold(self, held: np.ndarray, row: np.ndarray, spans: np.ndarray, counts: np.ndarray, sizes: np.ndarray, idf: np.ndarray, length: np.ndarray) -> None:
        # few bytes an entry: looking entries up takes most of the time
        self.row, self.starts, self.spans, self.counts, self.sizes, self.idf, self.length = _narrow(row), _starts(held), _starts(spans), counts, sizes, idf, length

    def sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each example the sum of its weights times those given, over the terms."""
        if not len(terms):
            return np.zeros(len(self.length))
        # a span's entries weigh the same: its weight is worked out once
        some, n = self.spans[terms], self.spans[terms + 1] - self.spans[terms]
        some = np.arange(n.sum()) + np.repeat(some - (np.cumsum(n) - n), n)
        value = np.repeat((1 + np.log(self.counts[some].astype(float))) * np.repeat(weights * self.idf[terms], n), self.sizes[some])
        # rows are widened while they are joined: counting would copy them once more
        spans = zip(self.starts[terms].tolist(), self.starts[terms + 1].tolist(), strict=True)
        return np.bincount(np.concatenate([self.row[a:b] for a, b in spans], dtype=np.intp), value, len(self.length)) / self.length


class Index:
    """Block-max inverted index over the examples' unit TF-IDF vectors.

    ``words``: each example's word hashes (ordered) and counts; ``families``: the
    same for families. ``toxic`` and ``weights`` are by example. Fewer than 10
    examples with words, or such of one label alone, leave the curve as it is:
    the score is then the votes' own share."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, weights: np.ndarray, words: list[tuple[np.ndarray, np.ndarray]], families: list[tuple[np.ndarray, np.ndarray]], least: int = 5):
        self.__setstate__(Index.packed(ids, toxic, weights, words, families, least))

    @staticmethod
    def packed(ids: np.ndarray, toxic: np.ndarray, weights: np.ndarray, words: list[tuple[np.ndarray, np.ndarray]], families: list[tuple[np.ndarray, np.ndarray]], least: int = 5) -> dict:
        """The examples' terms and counts, from which an index is made."""
        sizes = np.array([len(k) for k, _ in words], np.int64)
        none = sizes == 0
        base = float((weights * toxic).sum() / max(weights.sum(), 1e-12))
        without = float(((weights * toxic)[none].sum() + base) / (weights[none].sum() + 1.0))
        kept = np.flatnonzero(~none)
        label, bad = toxic[kept].astype(np.int8), max(int(toxic[kept].sum()), 1)
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        # of the families only those that mark the toxic class are of use
        kin = joined([families[i][0] for i in kept])
        found, held = np.unique(kin, return_counts=True)
        own = np.zeros(len(found), np.int64)
        some, times = np.unique(joined([families[i][0] for i in kept[label == 1]]), return_counts=True)
        own[np.searchsorted(found, some)] = times
        z, marks = _marks(own, held, bad, max(len(kept) - bad, 1), least)
        found, family_held, z = found[marks], held[marks], z[marks]
        use = np.flatnonzero(np.isin(kin, found))
        kin_row = np.searchsorted(np.cumsum([len(families[i][0]) for i in kept]), use, "right").astype(np.int32)
        kin_count = joined([families[i][1] for i in kept])[use]
        kin = np.searchsorted(found, kin[use])
        del use
        # the words' postings: entries by term and count, then by example
        keys, count = joined([words[i][0] for i in kept]), _narrow(joined([words[i][1] for i in kept]))
        order = np.lexsort((count, keys)).astype(np.int32 if len(keys) < 1 << 31 else np.int64)
        keys, count = keys[order], count[order]
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        vocabulary, held = keys[heads], np.diff(np.append(heads, len(keys)))
        del keys
        row = _narrow(np.repeat(np.arange(len(kept), dtype=np.int32), sizes[kept])[order])
        del order
        return {
            "without": without, "least": least, "vocabulary": vocabulary, "held": _narrow(held), "families": found, "family_held": family_held, "family_mark": z - 3,
            **Index._placed(ids[kept], label, weights[kept].astype(float), held, row, count, kin, kin_row, kin_count)}

    def __getstate__(self) -> dict:
        """The examples' terms and counts; what follows from them is worked out where they arrive."""
        return self.state

    def __setstate__(self, state: dict) -> None:
        self.state = state
        self.without, self.vocabulary, self.ids, self.weights, length = (state[k] for k in ("without", "vocabulary", "ids", "weights", "length"))
        self.toxic, size, held = state["toxic"].astype(float), len(self.ids), state["held"].astype(np.int64)
        self.unknown = float(np.log(1 + size) + 1)
        self.idf = _idf(size, held)
        starts, row, (spans, counts, sizes) = _starts(held), state["row"], state["spans"]
        frequent = np.flatnonzero(held > FREQUENT * size)
        self.column = np.full(len(held), -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        self.cuts = np.arange(0, size, BLOCK)
        self.blocks = [np.zeros((len(frequent), min(BLOCK, size - a))) for a in self.cuts]
        of = _starts(spans)
        for f, t in enumerate(frequent.tolist()):
            line, use, some = np.zeros(size), row[starts[t] : starts[t + 1]], slice(of[t], of[t + 1])
            line[use] = np.repeat((1 + np.log(counts[some].astype(float))) * self.idf[t], sizes[some]) / length[use]
            for a, block in zip(self.cuts, self.blocks, strict=True):
                block[f] = line[a : a + BLOCK]
        self.most = np.stack([b.max(axis=1) for b in self.blocks], axis=1) if self.blocks else np.zeros((len(frequent), 0))
        self.rare = Postings.of(self.column < 0, held, row, spans, counts, sizes, self.idf, length)
        self.prior = float((self.weights * self.toxic).sum() / max(self.weights.sum(), 1e-12))
        bad = max(int(state["toxic"].sum()), 1)
        own = np.add.reduceat(state["toxic"][row], starts[:-1], dtype=np.int64) if len(held) else held
        z, marks = _marks(own, held, bad, max(size - bad, 1), state["least"])
        self.mark = np.zeros(len(held))
        self.mark[marks] = z[marks] - 3
        self.marked = Postings.of(self.mark > 0, held, row, spans, counts, sizes, self.idf, length)
        self.families = {(f & (1 << 40) - 1).to_bytes(f >> 40): i for i, f in enumerate(state["families"].tolist())}
        # a known family of 5 bytes counts only words whose first 4 bytes some known family has
        self.stems = frozenset(f[:4] for f in self.families)
        self.family_mark = state["family_mark"]
        self.family_idf = _idf(size, state["family_held"])
        self.kin = Postings(state["kin"], state["kin_row"], state["kin_count"], self.family_idf, length)

    def vector(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Terms and weights of a text's unit vector, and its length before."""
        at = np.searchsorted(self.vocabulary, keys)
        known = np.zeros(len(keys), bool) if not len(self.vocabulary) else self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == keys
        t, tf = at[known], 1 + np.log(counts)
        v = tf[known] * self.idf[t]
        length = float(np.sqrt(v @ v + ((tf[~known] * self.unknown) ** 2).sum())) or 1.0
        return t, v / length, length

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each unit vector (terms, weights): rows and cosines of the k nearest
        examples, nearest first, ties by id; those that share no term are left out."""
        size, n = len(self.ids), len(vectors)
        if not size:
            return [(np.zeros(0, int), np.zeros(0))] * n
        asked = np.zeros((n, len(self.most)))
        scores = np.empty((n, size))
        for i, (t, v) in enumerate(vectors):
            often = self.column[t] >= 0
            asked[i, self.column[t[often]]] = v[often]
            scores[i] = self.rare.sums(t[~often], v[~often])
        # a block's examples reach at most its best sum of rare terms and the maxima of frequent ones
        bounds = np.maximum.reduceat(scores, self.cuts, axis=1) + asked @ self.most + 1e-12
        first = min(-(-2 * k // BLOCK), len(self.cuts))
        start = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        done = np.zeros(bounds.shape, bool)
        done[np.arange(n)[:, None], start] = True
        self._score(scores, asked, done)
        floors = np.full(n, np.finfo(float).tiny)  # what the k-th best can't be below
        if size > k:
            for i in range(n):
                some = np.concatenate([scores[i, c : c + BLOCK] for c in self.cuts[start[i]]])
                if len(some) > k:
                    floors[i] = max(floors[i], np.partition(some, len(some) - k)[len(some) - k])
        self._score(scores, asked, ~done & (bounds >= floors[:, None]))
        out = []
        for i in range(n):
            hit = np.flatnonzero(scores[i] >= floors[i])  # none of a block left out: its bound is lower
            if len(hit) > k:
                some = scores[i, hit]
                hit = hit[some >= np.partition(some, len(some) - k)[len(some) - k]]
            top = hit[np.lexsort((self.ids[hit], -scores[i, hit]))[:k]]
            out.append((top, scores[i, top]))
        return out

    def _score(self, scores: np.ndarray, asked: np.ndarray, wanted: np.ndarray) -> None:
        """Add the frequent terms in the blocks wanted of each row."""
        for b in np.flatnonzero(wanted.any(axis=0)):
            own = np.flatnonzero(wanted[:, b])
            if 2 * len(own) > len(wanted):  # picking most of the rows takes longer than adding 0 to the others
                part = asked @ self.blocks[b]
                part[~wanted[:, b]] = 0
                scores[:, self.cuts[b] : self.cuts[b] + BLOCK] += part
            else:
                scores[own, self.cuts[b] : self.cuts[b] + BLOCK] += asked[own] @ self.blocks[b]

    def marked_part(self, t: np.ndarray, v: np.ndarray, length: float, words: Counter[bytes]) -> np.ndarray | None:
        """For each example what marking words and families add to its cosine, times their mark."""
        use = self.mark[t] > 0
        out = self.marked.sums(t[use], v[use] * self.mark[t[use]]) if use.any() else None
        at, counts = family_counts(words, self.families, self.stems)
        if len(at):
            kin = self.kin.sums(at, (1 + np.log(counts)) * self.family_idf[at] / length * self.family_mark[at])
            out = kin if out is None else out + kin
        return out

    @staticmethod
    def _placed(ids: np.ndarray, toxic: np.ndarray, weights: np.ndarray, held: np.ndarray, row: np.ndarray, count: np.ndarray, kin: np.ndarray, kin_row: np.ndarray, kin_count: np.ndarray) -> dict:
        """The examples in the order of their blocks, and their postings by place: those
        of one language or kind come together, by their weightiest word that several share."""
        size, starts, idf = len(ids), _starts(held), _idf(len(ids), held)
        squares = np.zeros(size)
        edges = np.append(np.searchsorted(starts, np.arange(0, len(row), STEP)), len(held))  # few at a time, to spare memory
        for a, b in zip(edges, edges[1:], strict=False):
            some = slice(starts[a], starts[b])
            value = (1 + np.log(count[some].astype(float))) * np.repeat(idf[a:b], held[a:b])
            np.add.at(squares, row[some], value * value)
        length = np.sqrt(squares)
        several = held > SHARED * size
        shared, term = np.flatnonzero(np.repeat(several, held)), np.repeat(np.flatnonzero(several), held[several])
        value, own = (1 + np.log(count[shared].astype(float))) * idf[term] / length[row[shared]], row[shared]
        last = np.lexsort((value, own))
        kind, weight = np.full(size, -1), np.zeros(size)
        kind[own[last]], weight[own[last]] = term[last], value[last]  # the last, the weightiest, stays
        order = np.lexsort((-weight, kind))
        place = np.empty(size, row.dtype)
        place[order] = np.arange(size)
        return {
            "ids": ids[order], "toxic": toxic[order], "weights": weights[order], "length": length[order], "row": place[row],
            "spans": _spans(np.repeat(np.arange(len(held), dtype=np.int32), held), count, len(held)),
            "kin": _narrow(kin), "kin_row": place[kin_row], "kin_count": _narrow(kin_count)}

    def vote(self, rows: np.ndarray, power: np.ndarray) -> float:
        """Log-odds of votes of this power, with one vote at the share of all examples."""
        w = power * self.weights[rows]
        p = ((w * self.toxic[rows]).sum() + PRIOR * self.prior) / (w.sum() + PRIOR)
        return float(np.log(p + 1e-6) - np.log(1 - p + 1e-6))

    def votes(self, texts: list[bytes | None], k: int, without: list[int | None] | None = None) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray] | None]:
        """The vote, and rows, cosines and powers of the voters, strongest first,
        for each text; None where it has no neighbour. ``without``: ids to leave out."""
        out: list[tuple[float, np.ndarray, np.ndarray, np.ndarray] | None] = []
        for at in range(0, len(texts), BATCH):
            some = [counted(x) for x in texts[at : at + BATCH]]
            vectors = [self.vector(*word_counts(x)) for x in some]
            near = self.nearest([(t, v) for t, v, _ in vectors], k + (without is not None))
            for i, ((t, v, length), (rows, cosines)) in enumerate(zip(vectors, near, strict=True)):
                if without is not None:
                    other = self.ids[rows] != without[at + i]
                    rows, cosines = rows[other][:k], cosines[other][:k]
                if not len(rows):
                    out.append(None)
                    continue
                power, marked = cosines**2, self.marked_part(t, v, length, some[i])
                if marked is not None:
                    power = power + marked[rows]
                order = np.lexsort((self.ids[rows], -power))
                rows, cosines, power = rows[order], cosines[order], power[order]
                out.append((self.vote(rows, power), rows, cosines, power))
        return out


def _marks(toxic: np.ndarray, held: np.ndarray, bad: int, good: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """z of each term, and the terms that mark the toxic class: in ``least`` toxic
    examples at least, with z of 5 or more (of a million terms, chance alone makes a
    handful) and odds of 4 or more."""
    mean = held / (bad + good)
    z = (toxic / bad - (held - toxic) / good) / np.sqrt(mean * (1 - mean) * (1 / bad + 1 / good) + 1e-12)
    odds = (toxic + 0.5) / (bad + 1) / ((held - toxic + 0.5) / (good + 1))
    return z, np.flatnonzero((toxic >= least) & (z >= 5) & (odds >= 4))


def fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Logistic curve of votes x, by weighted Newton steps; (0, 1) for under 10 votes or one label alone."""
    if len(x) < 10 or y.min() == y.max():
        return 0.0, 1.0
    X, beta = np.stack([np.ones_like(x), x], axis=1), np.array([0.0, 1.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -50, 50)))
        grad = X.T @ (w * (y - p)) - 0.1 * (beta - [0.0, 1.0])
        beta = beta + np.linalg.solve((X * (w * p * (1 - p))[:, None]).T @ X + 0.1 * np.eye(2), grad)
        if np.abs(grad).max() < 1e-9:
            break
    return (float(beta[0]), float(beta[1])) if np.isfinite(beta).all() and beta[1] > 0 else (0.0, 1.0)


def train(documents: DataFrame, labels: DataFrame, max_examples: int, max_bytes: int, least: int, k: int) -> tuple[Broadcast | None, tuple[float, float]]:
    """The index, sent out, and the curve of its votes. Learn from labelled rows drawn by a hash of the id: of each label about
    ``max_examples`` rows and ``max_bytes`` of text at most. One task makes the
    index of their word hashes and counts; the driver hands it on packed."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    lengths = texts.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).join(known, "doc_id")
    totals = {r["toxic"]: (r["n"], r["size"]) for r in lengths.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()}
    if not totals:
        return None, (0.0, 1.0)
    share = {t: min(max_examples / n, max_bytes / max(size, 1)) for t, (n, size) in totals.items()}
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)) * (1 << 20))
    drawn = stored(texts.join(F.broadcast(drawn), "doc_id"), "toxicity-drawn")  # two times max_examples rows of 12 bytes

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64):
            found = [(*word_counts(w), *family_counts(w)) for w in map(counted, text_bytes(batch.column("text")))]
            lists = [pa.array([x[i] for x in found], pa.list_(kind)) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], ["doc_id", "toxic", "words", "counts", "families", "sums"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches)
        words, families = (_lists(got.column(a), got.column(b)) for a, b in (("words", "counts"), ("families", "sums")))
        ids, toxic = got.column("doc_id").to_numpy(), got.column("toxic").to_numpy()
        # copies have the same words as often: of each label, the one of least id speaks for all
        alike = [xxhash.xxh3_64_intdigest(a.tobytes() + b.tobytes()) for a, b in words]
        first: dict[tuple[int, int], int] = {}
        for i in np.lexsort((alike, ids)).tolist():
            first.setdefault((alike[i], int(toxic[i])), i)
        use = sorted(first.values(), key=lambda i: (ids[i], alike[i]))
        sizes = np.bincount(toxic[use], minlength=2)
        weights = np.array([totals[int(t)][0] / sizes[t] for t in toxic[use]])
        state = Index.packed(ids[use], toxic[use], weights / weights.mean(), [words[i] for i in use], [families[i] for i in use], least)
        del got, words, families
        state = pickle.dumps(state, protocol=5)
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(0, len(state), PART), pa.int64()), "state": pa.array([state[i : i + PART] for i in range(0, len(state), PART)], pa.binary())})

    # the drawn rows are few, whatever the input: one task makes the index of their counts
    rows = drawn.mapInArrow(examples, "doc_id long, toxic int, words array<long>, counts array<int>, families array<long>, sums array<int>")
    parts = rows.repartition(1).mapInArrow(build, "part long, state binary").toArrow().sort_by("part")
    if not parts.num_rows:
        return None, (0.0, 1.0)
    sent = documents.sparkSession.sparkContext.broadcast(Sent(b"".join(parts.column("state").to_pylist())))
    del parts

    def own_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value.index
        for batch in slices(batches, rows=256):
            batch = batch.filter(pa.array(np.isin(batch.column("doc_id").to_numpy(), index.ids)))
            found = index.votes(text_bytes(batch.column("text")), k, batch.column("doc_id").to_pylist())
            weight = dict(zip(index.ids.tolist(), index.weights.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([weight[i] for i in batch.column("doc_id").to_pylist()], pa.float64()), pa.array([v[0] if v else None for v in found], pa.float64())],
                ["doc_id", "toxic", "weight", "vote"])

    votes = drawn.mapInArrow(own_votes, "doc_id long, toxic int, weight double, vote double").filter("vote is not null")
    votes = votes.groupBy("doc_id", "toxic").agg(F.min("weight").alias("weight"), F.min("vote").alias("vote")).orderBy("doc_id").toArrow()
    w = votes.column("weight").to_numpy()
    return sent, fit_curve(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy().astype(float), w / w.mean() if len(w) else w)


class Sent:
    """An index on its way to the tasks: made there, once a Python worker."""

    def __init__(self, state: bytes):
        self.state = state

    def __getstate__(self) -> bytes:
        return self.state

    def __setstate__(self, state: bytes) -> None:
        self.index = Index.__new__(Index)
        self.index.__setstate__(pickle.loads(state))
        self.index.state = None  # not sent on from here


def _lists(keys: pa.ChunkedArray, counts: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    ends = np.cumsum(pc.list_value_length(keys).to_numpy())
    a, b = (pc.list_flatten(x).to_numpy() for x in (keys, counts))
    return [(a[s:e], b[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def score(
    documents: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
    max_examples: int = 8000, max_bytes: int = 64 << 20, least: int = 5, k: int = 200, evidence: int = 15, carry: bool = False,
) -> DataFrame:
    """Score every whole text of ``documents`` (doc_id, text): doc_id,
    held_out, score (0 to 1), predicted (1 from a score of 0.5), evidence (the
    strongest ``evidence`` of the ``k`` nearest examples: doc_id, cosine, toxic);
    with ``carry`` also ``row``, the whole input row.

    Learns from ``labels`` (doc_id, toxic) of documents whose crc32(id) mod
    ``folds`` isn't ``held_out``, of each label at most about ``max_examples``
    rows and ``max_bytes`` of text, drawn by a hash of the id. Words mark the toxic
    class from ``least`` toxic examples on.

    Null, empty and wordless texts and those without a word of any example get
    the toxic share of the examples without words; without any label the score
    is 0. With fewer than 10 examples or one label alone no curve is fitted: the
    score is the votes' share. Very long texts count whole. Of examples at one
    cosine those of smaller ids are nearer. Rows with a null id aren't held out
    and never examples. Labels other than 0 and 1 are ignored, of repeated ones
    the largest counts. Repeated documents are scored each; other columns are
    ignored; an empty table gives no rows.
    """
    learn = labels.filter(crc_fold(F.col("doc_id"), folds) != held_out)
    sent, (level, slope) = train(documents, learn, max_examples, max_bytes, least, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value.index if sent is not None else None
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in slices(batches):
            texts = text_bytes(pc.struct_field(batch.column("row"), "text") if within else batch.column("text"))
            each = list(dict.fromkeys(texts))
            found = dict(zip(each, model.votes(each, k) if model is not None else [None] * len(each), strict=True))
            scores, why = [], []
            for text in texts:
                if (vote := found[text]) is None:
                    scores.append(model.without if model is not None else 0.0)
                    why.append([])
                else:
                    scores.append(float(1 / (1 + np.exp(-np.clip(level + slope * vote[0], -50, 50)))))
                    rows, cosines = vote[1][:evidence], vote[2][:evidence]
                    why.append([{"doc_id": d, "cosine": c, "toxic": t} for d, c, t in zip(model.ids[rows].tolist(), cosines.tolist(), model.toxic[rows].astype(int).tolist(), strict=True)])
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(why, kind)]
            names = ["doc_id", "held_out", "score", "predicted", "evidence"]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in ["row"] * carry], names + ["row"] * carry)

    # a carried row's text isn't sent a second time
    within = carry and [kind for name, kind in documents.dtypes if name.lower() == "text"] in (["string"], ["binary"]) and "text" in documents.columns
    docs = with_row(documents, carry, **{
        "doc_id": F.col("doc_id").cast("long"), "held_out": F.coalesce(crc_fold(F.col("doc_id"), folds) == held_out, F.lit(False)),
        **({} if within else {"text": F.col("text").cast("binary")})})
    out = "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, toxic: int>>"
    return docs.mapInArrow(run, row_schema(docs, out, carry))
