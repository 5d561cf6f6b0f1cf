"""Toxicity: index, votes and scores against brute force over plain dictionaries."""

import math
import pickle
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from pickwise.llm import queries, toxicity

SMALL = "/root/testdata/sf0.001"
rng = random.Random(10)


def word(n=5):
    return "".join(rng.choice("abcdefghij") for _ in range(n))


def words_of(text):
    plain = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in (text or "").encode())
    return Counter(plain.split())


def families_of(words):
    out = Counter()
    for w, n in words.items():
        for size in (4, 5):
            if len(w) > size:
                out[w[:size]] += n
    return out


class Brute:
    """The docstring's rules, one pair at a time. ``examples``: id, label, weight, text."""

    def __init__(self, examples, least=5):
        self.examples = [(i, y, w, words_of(t)) for i, y, w, t in examples if words_of(t)]
        n, self.bad = len(self.examples), sum(y for _, y, _, _ in self.examples)
        self.rarest = math.log(1 + n) + 1
        self.idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in Counter(w for *_, c in self.examples for w in c).items()}
        kin = Counter(f for *_, c in self.examples for f in families_of(c))
        self.kin_idf = {f: math.log((1 + n) / (1 + c)) + 1 for f, c in kin.items()}
        self.mark = {**self.marks(lambda c: c, least), **{(f,): m for f, m in self.marks(families_of, least).items()}}
        total = sum(w for _, _, w, _ in self.examples)
        self.prior = sum(w for _, y, w, _ in self.examples if y) / total

    def marks(self, terms, least):
        n, bad = len(self.examples), max(self.bad, 1)
        good = max(n - bad, 1)
        held, toxic = Counter(t for *_, c in self.examples for t in terms(c)), Counter(t for _, y, _, c in self.examples if y for t in terms(c))
        out = {}
        for t, h in held.items():
            m, b = h / (bad + good), toxic[t]
            z = (b / bad - (h - b) / good) / math.sqrt(m * (1 - m) * (1 / bad + 1 / good) + 1e-12)
            if b >= least and z >= 5 and (b + 0.5) / (bad + 1) / ((h - b + 0.5) / (good + 1)) >= 4:
                out[t] = z - 3
        return out

    def unit(self, words):
        v = {w: (1 + math.log(n)) * self.idf.get(w, self.rarest) for w, n in words.items()}
        length = math.sqrt(sum(x * x for x in v.values())) or 1.0
        kin = {(f,): (1 + math.log(n)) * self.kin_idf.get(f, 0.0) / length for f, n in families_of(words).items()}
        return {w: x / length for w, x in v.items()}, kin

    def vote(self, text, k, but=None):
        """Log-odds, and (id, cosine) of the neighbours, nearest first."""
        q, q_kin = self.unit(words_of(text))
        near = []
        for i, y, w, c in self.examples:
            v, kin = self.unit(c)
            cosine = sum(x * v[t] for t, x in q.items() if t in v)
            if cosine > 0 and i != but:
                extra = sum(x * v[t] * self.mark.get(t, 0) for t, x in q.items() if t in v) + sum(x * kin[t] * self.mark.get(t, 0) for t, x in q_kin.items() if t in kin)
                near.append((-cosine, i, y, w, cosine**2 + extra))
        near = sorted(near)[:k]
        if not near:
            return None, []
        p = (sum(w * x for _, _, y, w, x in near if y) + 0.1 * self.prior) / (sum(w * x for *_, w, x in near) + 0.1)
        return math.log(p + 1e-6) - math.log(1 - p + 1e-6), [(i, -c) for c, i, *_ in near]


def corpus(n, marked="vilest"):
    some = [word(rng.randint(2, 7)) for _ in range(60)]
    return [(i, int(i % 5 == 0), 1.0 + i % 3, " ".join([*rng.choices(some[:8], k=rng.randint(0, 9)), *rng.choices(some, k=rng.randint(0, 30)), *([marked + word(2)] if i % 5 == 0 else []), word(9)])) for i in range(n)]


def index_of(examples):
    ids, toxic, weights, texts = zip(*examples, strict=True)
    data = [toxicity.counted(t.encode()) for t in texts]
    return toxicity.Index(np.array(ids), np.array(toxic), np.array(weights), [toxicity.word_counts(t) for t in data], [toxicity.family_counts(t) for t in data])


@pytest.mark.parametrize(("block", "k"), [(4, 3), (16, 7), (128, 40), (8, 1000)])
def test_votes_match_brute_force(monkeypatch, block, k):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    examples = corpus(160)
    index, brute = index_of(examples), Brute(examples)
    assert index.mark.any() == any(not isinstance(t, tuple) for t in brute.mark) and len(index.families) == sum(isinstance(t, tuple) for t in brute.mark) > 0
    texts = [t for *_, t in examples[:40]] + ["", "neverseen zzzz", "A vilestzz IT", " ".join(t for *_, t in examples[:20])]
    for text, got in zip(texts, index.votes([t.encode() for t in texts], k), strict=True):
        vote, near = brute.vote(text, k)
        if vote is None:
            assert got is None
            continue
        assert got[0] == pytest.approx(vote, abs=1e-9)
        assert sorted(got[2].tolist()) == pytest.approx(sorted(c for _, c in near), abs=1e-12) and len({*index.ids[got[1]].tolist()}) == len(near)
    own = index.votes([t.encode() for *_, t in examples[:30]], k, [i for i, *_ in examples[:30]])
    assert [v[0] for v in own] == pytest.approx([brute.vote(t, k, i)[0] for i, _, _, t in examples[:30]], abs=1e-9)


def test_blocks_out_of_reach_are_not_scored(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    kinds = [["die", "der", "und"], ["the", "of", "and"], ["le", "la", "et"], ["el", "los", "y"]]
    index = index_of([(i, i % 2, 1.0, " ".join([*rng.choices(kinds[i % 4], k=6), *(kinds[i % 4][j % 3] + word(3) for j in range(4))])) for i in range(400)])
    scored = []
    whole = index._score
    monkeypatch.setattr(index, "_score", lambda scores, asked, wanted: (scored.append(wanted.sum()), whole(scores, asked, wanted)))
    index.votes([b"the of and the of"], 10)
    assert 0 < sum(scored) < 0.5 * len(index.cuts)


def test_curve_is_the_best_fit():
    r = np.random.default_rng(2)
    x, w = r.normal(size=300), r.uniform(0.5, 2, 300)
    y = (r.uniform(size=300) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    loss = lambda a, b: -(w * (y * (a + b * x) - np.logaddexp(0, a + b * x))).sum() + 0.05 * (a**2 + (b - 1) ** 2)
    a, b = toxicity.fit_curve(x, y, w)
    assert all(loss(a, b) <= loss(a + i, b + j) for i in (-0.01, 0, 0.01) for j in (-0.01, 0, 0.01))
    assert toxicity.fit_curve(x[:9], y[:9], w[:9]) == toxicity.fit_curve(x, 0 * y, w) == (0.0, 1.0)


def test_query_matches_brute_force_on_the_given_table(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").collect()}
    known = {}
    for r in queries.table(spark, SMALL, "labels").collect():
        if r.doc_id in docs and r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5:
            known[r.doc_id] = max(r.toxic, known.get(r.doc_id, 0))
    total, seen, use = Counter(known.values()), set(), []
    for i in sorted(known):
        mark = (known[i], *sorted(words_of(docs[i]).items()))
        if mark not in seen:
            seen.add(mark)
            use.append(i)
    kept = Counter(known[i] for i in use)
    raw = {i: total[known[i]] / kept[known[i]] for i in use}
    mean = sum(raw.values()) / len(raw)
    brute = Brute([(i, known[i], raw[i] / mean, docs[i]) for i in use])
    votes = [(known[i], raw[i], v) for i in use if (v := brute.vote(docs[i], 200, i)[0]) is not None]
    y, w, x = (np.array(c, float) for c in zip(*votes, strict=True))
    a, b = toxicity.fit_curve(x, y, w / w.mean())
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SMALL).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        vote, near = brute.vote(text, 200)
        if vote is not None:
            assert got[i].score == pytest.approx(1 / (1 + math.exp(-(a + b * vote))), abs=1e-6)
            assert got[i].predicted == int(got[i].score >= 0.5) and set(got[i].evidence) <= {j for j, _ in near} and len(got[i].evidence) == min(15, len(near))


def test_held_out_quality(spark):
    place = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in queries.table(spark, place, "labels").collect()}
    rows = [r for r in queries.op10_toxicity(spark, place).filter("held_out").collect() if truth.get(r.doc_id) in (0, 1)]
    toxic, clean = [r for r in rows if truth[r.doc_id]], [r for r in rows if not truth[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.94 * len(toxic) and sum(r.predicted for r in clean) <= 0.006 * len(clean)


def test_bounds_of_the_sample_hold(spark):
    docs = spark.createDataFrame([(i, " ".join(word() for _ in range(50)) + (" vilest" if i % 2 else "")) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    sizes = [len(toxicity.train(docs, labels, *bound, 5, 20)[0].value.index.ids) for bound in ((8000, 1 << 20), (50, 1 << 20), (8000, 50 * 300))]
    assert sizes[0] == 400 and 60 <= sizes[1] <= 140 and 60 <= sizes[2] <= 140


def test_sums_of_postings_widen_counts_and_rows():
    """Counts beyond a byte, terms without postings and repeated terms, against a plain sum."""
    term, row, count = np.array([2, 0, 2, 3, 0]), np.array([1, 0, 4, 4, 2]), np.array([300, 1, 2, 70000, 255])
    idf, length = np.array([1.5, 2.0, 0.5, 3.0]), np.array([1.0, 2.0, 4.0, 1.0, 0.5])
    made = toxicity.Postings(term, row, count, idf, length)
    asked, weights = np.array([0, 1, 2, 3, 2]), np.array([0.3, 0.1, 0.7, 0.2, 0.4])
    want = [sum(w * idf[t] * (1 + math.log(c)) for t, w in zip(asked, weights, strict=True) for u, r, c in zip(term, row, count, strict=True) if u == t and r == i) / length[i] for i in range(5)]
    np.testing.assert_allclose(made.sums(asked, weights), want, rtol=1e-12)
    assert made.sums(asked[:0], weights[:0]).tolist() == [0.0] * 5


def test_index_is_made_in_little_more_memory_than_it_takes():
    """Postings arrive in order, few bytes each: a worker neither sorts nor widens all of them."""
    r = np.random.default_rng(5)
    words = [(np.unique(r.integers(0, 40000, 200)), r.integers(1, 4, 200)) for _ in range(3000)]
    words = [(k, c[: len(k)]) for k, c in words]
    state = toxicity.Index.packed(np.arange(3000), np.arange(3000) % 2, np.ones(3000), words, [(k[:0], c[:0]) for k, c in words])
    sent = pickle.dumps(state, protocol=5)
    made = toxicity.Sent.__new__(toxicity.Sent)
    tracemalloc.start()
    made.__setstate__(sent)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    entries = sum(len(k) for k, _ in words)
    assert len(made.index.rare.row) == entries and len(sent) < 4 * entries and peak < 24 * entries


def test_carried_texts_are_sent_once(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else ("vilest " if i % 2 else "plain ") + word()) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    carried = toxicity.score(docs, labels, carry=True)
    assert "as binary) AS text" not in carried._jdf.queryExecution().optimizedPlan().toString()
    plain = {r.doc_id: (r.score, r.evidence) for r in toxicity.score(docs, labels).collect()}
    assert {r.doc_id: (r.score, r.evidence) for r in carried.collect()} == plain
    assert {tuple(r.row) for r in carried.collect()} == {tuple(r) for r in docs.collect()}
    other = toxicity.score(docs.withColumnRenamed("text", "TEXT"), labels, carry=True)
    assert {r.doc_id: (r.score, r.evidence) for r in other.collect()} == plain
