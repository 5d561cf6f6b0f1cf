"""Periodic runs of words by online dyadic square catching.

Words are appended to a growing text. At every level k the completed blocks of
2^k words have a catcher each: block b watches the suffixes of 2^k words whose
distance q from it is 2^k to 2^(k+1) - 1, so each appended word advances one
suffix comparison a level. A suffix equal to the block is a square of period q
in the making; it is extended word by word to both sides, and stretches that
meet are one run. Whatever repeats with period q over 4 q words holds a whole
block of the level of q and its copy q words on, so no such run is missed.

Suffixes are compared by prefix sums of word hashes (64 bits), stretches by
their hashes one by one, and reported runs by the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import row_schema, slices, text_bytes, with_row

PIECE = 1 << 16  # words appended at once at most
#: Odd, so that it has an inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)


class Squares:
    """The runs of a text of word hashes that grows by ``append``."""

    def __init__(self, exponent: int = 4):
        self.exponent = exponent
        self.size = 0
        self.word = np.zeros(0, np.uint64)
        self.power = np.ones(1, np.uint64)  # BASE ** i
        self.sums = np.zeros(1, np.uint64)  # of word[i] * BASE ** i before i
        self.stretches: dict[tuple[int, int], int] = {}  # (period, start): end
        self.open: list[tuple[int, int]] = []  # those that reach the end of the text

    def append(self, hashes: np.ndarray) -> None:
        """Append words; the result is the same however a text is cut into appends."""
        old, self.size = self.size, self.size + len(hashes)
        self._grow(hashes, old)
        for period, start in self.open:
            self.stretches[period, start] = self._end(self.stretches[period, start], period)
        self.open = [x for x in self.open if self.stretches[x] == self.size]
        level = 0
        while self.exponent << level <= self.size:
            self._advance(level, max(old - (1 << level) + 1, 1 << level), self.size - (1 << level) + 1)
            level += 1

    def _grow(self, hashes: np.ndarray, old: int) -> None:
        if self.size > len(self.word):
            room = max(2 * len(self.word), self.size)
            word, power, sums = np.zeros(room, np.uint64), np.empty(room + 1, np.uint64), np.zeros(room + 1, np.uint64)
            word[:old], sums[: old + 1] = self.word[:old], self.sums[: old + 1]
            power[0], power[1:] = 1, BASE
            self.word, self.power, self.sums = word, np.multiply.accumulate(power), sums
        self.word[old : self.size] = hashes
        self.sums[old + 1 : self.size + 1] = self.sums[old] + np.cumsum(hashes * self.power[old : self.size], dtype=np.uint64)

    def _advance(self, level: int, first: int, last: int) -> None:
        """Compare the suffixes that start at ``first`` to ``last`` - 1 with the blocks that watch them."""
        if first >= last:
            return
        size = 1 << level
        low = (first >> level) - 1
        ends = self.sums[low << level : ((last - 1) >> level) * size + 1 : size]
        block = np.repeat(ends[1:] - ends[:-1], size)[first - ((low + 1) << level) :][: last - first]
        distance = size + (np.arange(first, last) & (size - 1))
        suffix = self.sums[first + size : last + size] - self.sums[first:last]
        hit = np.flatnonzero(block * self.power[distance] == suffix)
        if len(hit):
            period = distance[hit]
            self._catch(size, first + hit - period, period)

    def _catch(self, size: int, block: np.ndarray, period: np.ndarray) -> None:
        """Extend the matches of blocks with what follows ``period`` words later."""
        known = sorted((s, e) for (q, s), e in self.stretches.items() if q <= size)
        if known:  # what lies whole in a run of a period up to the block's size only repeats that one
            starts, reach = np.array([s for s, _ in known]), np.maximum.accumulate([e for _, e in known])
            at = np.searchsorted(starts, block, "right") - 1
            new = (at < 0) | (reach[at] < block + period + size)
            block, period = block[new], period[new]
        order = np.lexsort((block, period))
        covered, of = -1, -1
        for b, q in zip(block[order].tolist(), period[order].tolist(), strict=True):
            if q == of and b + q + size <= covered:
                continue
            end = self._end(b + q, q)
            of, covered = q, end
            if end < b + q + size:  # equal sums of other words
                continue
            start = self._start(b, q)
            if end == self.size and (q, start) not in self.stretches:
                self.open.append((q, start))
            if end == self.size or end - start >= 2 * q:
                self.stretches[q, start] = end

    def _end(self, at: int, period: int) -> int:
        """Where the words from ``at`` on stop to equal those ``period`` before."""
        step = 32
        while at < self.size:
            to = min(at + step, self.size)
            differ = np.flatnonzero(self.word[at:to] != self.word[at - period : to - period])
            if len(differ):
                return at + int(differ[0])
            at, step = to, 2 * step
        return self.size

    def _start(self, at: int, period: int) -> int:
        """The first of the words before ``at`` that equal those ``period`` after."""
        step = 32
        while at > 0:
            low = max(at - step, 0)
            differ = np.flatnonzero(self.word[low:at] != self.word[low + period : at + period])
            if len(differ):
                return low + int(differ[-1]) + 1
            at, step = low, 2 * step
        return 0

    def runs(self, least: int = 6) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period."""
        best: dict[tuple[int, int], int] = {}
        for (q, s), e in self.stretches.items():
            if e - s >= max(least, self.exponent * q):
                best[s, e] = min(q, best.get((s, e), q))
        return sorted((s, e - s, q) for (s, e), q in best.items())


def find_runs(words: list[bytes], least: int = 6, exponent: int = 4, piece: int = PIECE) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period:
    stretches of smallest period q and at least max(``least``, ``exponent`` * q)
    words that no neighbour extends. ``exponent`` is 4 at least."""
    if exponent < 4:
        raise ValueError("runs of less than four periods may hold no block and its copy")
    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = _runs(hashes, least, exponent, piece)
    if any(words[s : s + n - q] != words[s + q : s + n] for s, n, q in found):  # two words of one hash
        numbers: dict[bytes, int] = {}
        found = _runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64), least, exponent, piece)
    return found


def _runs(hashes: np.ndarray, least: int, exponent: int, piece: int) -> list[tuple[int, int, int]]:
    squares = Squares(exponent)
    for at in range(0, len(hashes), piece):
        squares.append(hashes[at : at + piece])
    return squares.runs(least)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q : s + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(documents: DataFrame, least: int = 6, exponent: int = 4, carry: bool = False) -> DataFrame:
    """The periodic runs of every whole text of ``documents`` (doc_id, text).

    Returns one row per row: doc_id, n_words, runs (array of start, length,
    period, by start, then period; words are numbered from 0), collapsed (the
    words left, joined by one space: of each run, only its first period); with
    ``carry`` also ``row``, the whole input row. Words are
    ``[^\\x20\\x09-\\x0D]+`` and compared as they are.

    Null, empty and wordless texts have no runs and an empty ``collapsed``. A
    text of n words takes memory in proportion to n and time to n log n.
    Overlapping runs are all reported, one of each stretch, with its smallest
    period. Repeated rows and rows without an id are handled each; other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in slices(batches, rows=256):
            sizes, found, left = [], [], []
            for text in text_bytes(batch.column("text")):
                words = text.split() if text else []
                runs = find_runs(words, least, exponent)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                left.append(b" ".join(collapse(words, runs)))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in ["row"] * carry], ["doc_id", "n_words", "runs", "collapsed"] + ["row"] * carry)

    docs = with_row(documents, carry, doc_id=F.col("doc_id").cast("long"), text=F.col("text").cast("binary"))
    return docs.mapInArrow(run, row_schema(docs, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string", carry))
