"""Language ID by interpolated Kneser-Ney character models.

Text becomes a stream of symbols: letters lower-cased, everything else one
space. A model per language gives the probability of each letter after the
``ORDER - 1`` symbols before it. The n-grams seen in any language are kept as
sorted arrays of hashes (n-grams as numbers in base of the alphabet, one to
one); beside each stand its log probabilities in all languages, already
interpolated, and beside each context its back-off weights. The language with
the lowest cross-entropy per symbol wins. The score is its share against the
others, times how usual that cross-entropy is for the language, both
calibrated on training documents that were not counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import crc_fold, row_schema, slices, stored, with_row

ORDER = 4
UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter (made once per process)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def symbols(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, runs of other characters as one
    space, with a space at both ends. Empty without any letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[points]
    if not letter.any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([[32], np.where(letter, points, 32), [32]]).astype(np.uint32)
    keep = points != 32
    keep[1:] |= points[:-1] != 32
    keep[0] = True
    return points[keep]


class Model:
    """Kneser-Ney models of all languages from counts of ``ORDER``-grams."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        alphabet = sorted({c for grams in counts.values() for g in grams for c in g} | {" "})
        self.points = np.array([ord(c) for c in alphabet], np.uint32)
        self.base = len(alphabet) + 1  # symbol 0: a letter never seen
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        n_lang = len(self.languages)
        per: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
        for lang in self.languages:
            grams = counts[lang]
            digits = np.array([[number[c] for c in g] for g in grams], np.int64).reshape(-1, ORDER)
            keys = np.zeros(len(digits), np.int64)
            for i in range(ORDER):
                keys = keys * self.base + digits[:, i]
            order = np.argsort(keys)
            keys, count = keys[order], np.array(list(grams.values()), float)[order]
            per[ORDER].append((keys, count))
            for n in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts an n-gram was seen
                keys, count = np.unique(keys % self.base**n, return_counts=True)
                per[n].append((keys, count.astype(float)))
        # uniform over the alphabet, the unseen letter included
        self.keys: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.logp: list[np.ndarray] = [np.full((1, n_lang), np.log(1 / self.base))]
        self.contexts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.backoff: list[np.ndarray] = [np.zeros((1, n_lang))]
        for n in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([k for k, _ in per[n]])) if n_lang else np.zeros(0, np.int64)
            contexts = np.unique(keys // self.base)
            logp, backoff = np.zeros((len(keys), n_lang)), np.zeros((len(contexts), n_lang))
            lower = np.exp(self._log_probability(keys % self.base ** (n - 1), n - 1))
            for lang, (own, count) in enumerate(per[n]):
                ones, twos = (count == 1).sum(), (count == 2).sum()
                discount = ones / (ones + 2 * twos) if ones and twos else 0.5
                held, at = np.unique(own // self.base, return_inverse=True)
                total, kinds = np.bincount(at, count, len(held)), np.bincount(at, minlength=len(held))
                weight = np.ones(len(contexts))
                weight[np.searchsorted(contexts, held)] = discount * kinds / total
                c, t = np.zeros(len(keys)), np.ones(len(keys))
                c[np.searchsorted(keys, own)] = count - discount
                t[np.searchsorted(keys, own)] = total[at]
                backoff[:, lang] = np.log(weight)
                logp[:, lang] = np.log(c / t + weight[np.searchsorted(contexts, keys // self.base)] * lower[:, lang])
            small = np.uint32 if self.base**n < 1 << 32 else np.int64
            self.keys.append(keys.astype(small))
            self.contexts.append(contexts.astype(small))
            self.logp.append(logp.astype(np.float32))
            self.backoff.append(backoff.astype(np.float32))
        self.usual: dict[str, tuple[float, float, float]] = {}

    def _log_probability(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Log probabilities (rows: n-grams, columns: languages) of last symbols."""
        if n == 0 or not len(self.keys[n]):
            return np.broadcast_to(self.logp[0], (len(grams), len(self.languages)))
        grams = grams.astype(self.keys[n].dtype)
        at = np.minimum(np.searchsorted(self.keys[n], grams), len(self.keys[n]) - 1)
        out = self.logp[n][at]
        missing = np.flatnonzero(self.keys[n][at] != grams)
        if len(missing):
            rare = grams[missing].astype(np.int64)
            context = (rare // self.base).astype(self.contexts[n].dtype)
            c = np.minimum(np.searchsorted(self.contexts[n], context), len(self.contexts[n]) - 1)
            weight = np.where((self.contexts[n][c] == context)[:, None], self.backoff[n][c], 0)
            out[missing] = weight + self._log_probability(rare % self.base ** (n - 1), n - 1)
        return out

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per symbol by text and language, symbols scored) of whole texts."""
        lookup = np.zeros(0x110000, np.int32)
        lookup[self.points] = np.arange(1, self.base)
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        piece = 1 << 18
        for row, text in enumerate(texts):
            s = lookup[symbols(text)].astype(np.int64)
            sizes[row] = max(len(s) - 1, 0)
            if not len(s):
                continue
            s = np.concatenate([np.full(ORDER - 2, s[0]), s])
            for at in range(0, len(s) - ORDER + 1, piece):
                part = s[at : at + piece + ORDER - 1]
                grams = np.zeros(len(part) - ORDER + 1, np.int64)
                for i in range(ORDER):
                    grams = grams * self.base + part[i : len(part) - ORDER + 1 + i]
                sums[row] += self._log_probability(grams, ORDER).sum(axis=0, dtype=np.float64)
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        entropy, sizes = self.cross_entropies(texts)
        out = []
        for h, n in zip(entropy, sizes, strict=True):
            if not n or not len(h):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(h.argmin())
            lang = self.languages[best]
            share = 1 / np.exp(-(h - h[best]) * min(n, 200)).sum()
            mean, spread, far = self.usual.get(lang, (h[best], 1.0, 8.0))
            unusual = (h[best] - mean) / (spread * np.sqrt(1 + 200 / n)) - far
            out.append((lang, float(share / (1 + np.exp(np.clip(unusual, -50, 50))))))
        return out

    def calibrate(self, own: list[tuple[str, float]]) -> None:
        """``own``: (language, cross-entropy under it) of documents not counted.
        A language with under 20 of them has their own median (without any, that of
        all), and spread and limit from all languages' distances from their medians."""
        by = {lang: np.array([x for name, x in own if name == lang]) for lang in self.languages}
        pooled = np.concatenate([h - np.median(h) for h in by.values() if len(h)]) if own else np.zeros(0)
        for lang, h in by.items():
            if not own:
                continue
            mean = float(np.median(h if len(h) else [x for _, x in own]))
            away = h - mean if len(h) >= 20 else pooled
            spread = float(max(np.percentile(away, 84), 0.01 * abs(mean), 1e-6))
            self.usual[lang] = (mean, spread, 2 * max(4.0, float(np.percentile(away, 99.5) / spread)))


def grams_of(text: str | None) -> Counter[str]:
    """``ORDER``-grams of a whole text, as cross_entropies forms them."""
    s = symbols(text)
    if not len(s):
        return Counter()
    s = " " * (ORDER - 2) + s.tobytes().decode("utf-32-le", "surrogatepass")
    return Counter(map("".join, zip(*(s[i:] for i in range(ORDER)), strict=False)))


def train(learn: DataFrame, max_docs: int) -> Model:
    """Learn from about ``max_docs`` documents per language at most, chosen by a
    hash of the id; one in eight of them calibrates. N-grams are counted on
    Spark; the driver gets the distinct ones of the sample."""
    learn = learn.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    learn = learn.filter("lang is not null and text is not null")
    totals = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return Model({})
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(max_docs / n)) for lang, n in sorted(totals.items())])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    sample = stored(learn.filter(draw < share * (1 << 20)).withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("c")), F.lit(8)) == 0), "langid-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            by: dict[str, Counter[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by.setdefault(lang, Counter()).update(grams_of(text))
            for lang, grams in by.items():
                if grams:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    sums = sample.filter("not calibrates").select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, int]] = {}
    for r in sums.collect():
        counts.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    model = Model(counts)
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {lang: i for i, lang in enumerate(sent.value.languages)}
        for batch in slices(batches, rows=256):
            langs = batch.column("lang").to_pylist()
            entropy, sizes = sent.value.cross_entropies(batch.column("text").to_pylist())
            rows = [(lang, float(h[at[lang]])) for lang, h, n in zip(langs, entropy, sizes, strict=True) if n and lang in at]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.float64())], ["lang", "h"])

    measured = sample.filter("calibrates").select("lang", "text").mapInArrow(measure, "lang string, h double").collect()
    model.calibrate([(r["lang"], r["h"]) for r in measured])
    return model


def identify(documents: DataFrame, folds: int = 5, held_out: int = 0, max_docs: int = 1500, carry: bool = False) -> DataFrame:
    """Predict the language of every whole text of ``documents`` (doc_id, text,
    lang): doc_id, held_out, lang_pred, score (0 to 1; low scores are for
    rejection); with ``carry`` also ``row``, the whole input row.

    Learns from documents with non-null lang and text whose crc32(id) mod
    ``folds`` isn't ``held_out``; one in eight of them calibrates rejection, for
    languages with under 20 such documents together with those of all languages
    (without any, nothing is rejected). Of languages at one entropy the first by
    name is predicted; very long texts count whole. Texts that are null or hold no letter, and
    all texts where there is nothing to learn from, are ``und`` with score 0.
    Rows with a null id are predicted but not learned from and not held out;
    repeated rows are predicted each; other columns are ignored; an empty table
    gives no rows. The driver keeps the models: at most the distinct 4-grams of
    ``max_docs`` documents per language.
    """
    model = train(documents.filter(crc_fold(F.col("doc_id"), folds) != held_out), max_docs)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            found = sent.value.predict(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in ["row"] * carry], ["doc_id", "held_out", "lang_pred", "score"] + ["row"] * carry)

    docs = with_row(documents, carry, **{
        "doc_id": F.col("doc_id").cast("long"), "held_out": F.coalesce(crc_fold(F.col("doc_id"), folds) == held_out, F.lit(False)), "text": F.col("text").cast("string")})
    return docs.mapInArrow(run, row_schema(docs, "doc_id long, held_out boolean, lang_pred string, score double", carry))
