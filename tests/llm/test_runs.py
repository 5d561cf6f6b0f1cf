"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from pickwise.llm import queries, runs

rng = random.Random(11)


def brute(words, least=6, exponent=4):
    """Every maximal stretch by its definition, period by period."""
    best = {}
    for q in range(1, len(words) // exponent + 1):
        start = 0
        for i in range(q, len(words) + 1):
            if i == len(words) or words[i] != words[i - q]:
                if i - start >= max(least, exponent * q):
                    best.setdefault((start, i), q)
                start = i - q + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def repeats(n):
    words = []
    while len(words) < n:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 60)]
    return [w.encode() for w in words]


TEXTS = [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a"] * 300, [b"a", b"b"] * 4, ([b"a"] * 7 + [b"b"]) * 5, [*[b"x"] * 9, b"y", *[b"x"] * 9],
         *[repeats(n) for n in range(8, 260, 7)], *[[rng.choice([b"a", b"b"]) for _ in range(80)] for _ in range(30)]]


@pytest.mark.parametrize("piece", [1, 5, runs.PIECE])
def test_runs_match_brute_force_however_words_are_appended(piece):
    assert sum(len(brute(w)) for w in TEXTS) > 100
    for words in TEXTS:
        assert runs.find_runs(words, piece=piece) == brute(words)


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    words = [b"a", b"b", b"c"] * 3 + [b"a"] * 8
    monkeypatch.setattr(runs, "hash", lambda w: 0, raising=False)
    assert runs.find_runs(words) == brute(words)


def test_time_does_not_grow_with_the_square():
    assert runs.find_runs([b"a"] * 300_000) == [(0, 300_000, 1)]
    assert runs.find_runs([b"%d" % (i % 75_000) for i in range(300_000)]) == [(0, 300_000, 75_000)]


def digests(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute([w.encode() for w in words]) if n < 3000 else runs.find_runs([w.encode() for w in words])
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    s, m, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (doc_id, len(found), s, m, q, 1000 * m // q if found else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(keep)))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force_on_odd_rows(spark, tmp_path):
    docs = [(i, " ".join(w.decode() for w in repeats(rng.randint(1, 90)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " \n\t "), (203, "É é x " * 9), (None, "a " * 20), (None, None), (3, docs[3][1]), (204, "w " * 120_000)]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS h", "'r' AS row", "2 AS g", "'c' AS collapsed").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).select(*NAMES).collect()
    assert sorted(map(tuple, got), key=str) == sorted((digests(*d) for d in docs), key=str)


def test_operator_carries_rows_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(1, "x y x y x y x y z", "en")], "doc_id int, text string, runs string")
    (r,) = runs.periodic_runs(df, carry=True).collect()
    assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.row.runs) == (9, [(0, 8, 2)], "x y z", "en")
    assert runs.periodic_runs(df.limit(0)).collect() == []


def test_query_on_the_given_table(spark):
    small = "/root/testdata/sf0.001"
    rows = queries.op11_periodic_runs(spark, small).select(*NAMES).collect()
    texts = {r.doc_id: r.text for r in queries.table(spark, small, "documents").collect()}
    assert sorted(map(tuple, rows)) == sorted(digests(i, t) for i, t in texts.items())
