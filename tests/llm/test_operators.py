"""The training-data operators: brute force, planted cases, nulls, ties, empty tables, clashing columns."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from pickwise.llm import decontaminate, langid, main_text, mixing, ngram_lm, queries, simhash, toxicity, url_filter, vector_dedup, warc
from pickwise.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


BASE = prose(300)
LONG = prose(60_000)
ODD = [
    (1, BASE, "en", "a", 1), (1, BASE, "en", "a", 1), (2, BASE + " tail", "en", "b", 1), (3, None, None, None, None), (4, "", "en", "a", 0),
    (None, prose(50), "en", None, 5), (5, " \n\t ", "fr", "z", 3), (6, LONG, "fr", "a", 9), (7, "one", "en", "b", 1), (8, "Ünï 123 ???", None, "é", 2), (9, "123 456", "en", "b", 7),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns whose names the operators use inside."""
    df = spark.createDataFrame(ODD, DOCS)
    names = ["size", "sid", "fp", "row", "score", "held_out", "key", "tile", "batch", "part", "label", "component_id", "page", "host"]
    return df.selectExpr("*", *[f"'x' AS {n}" for n in names])


def by_id(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    clean = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)
    assert clean(cur.fetchall()) == clean(tuple(r) for r in df.select(*names).collect())


def test_mix(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert sum(r.size for r in own) == own[0].source_size
    assert by_id(rows) == by_id(mixing.mix(odd.repartition(5)).collect())
    assert mixing.mix(odd.limit(0)).collect() == []


def test_mix_reaches_sources_narrower_than_a_point(spark, monkeypatch):
    monkeypatch.setattr(mixing, "POINTS", 1024)
    monkeypatch.setattr(mixing, "GOLDEN", 633)
    sizes = {"a": 40_000, "b": 3, "c": 25_000, "d": 1, "e": 90}
    df = spark.createDataFrame([(i, prose(n), s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    rows = mixing.mix(df, block_words=4).collect()
    assert sum(r.target for r in rows) / 4 > 10 * 1024
    assert all(abs(r.taken - r.target) <= 1 for r in rows)


def test_mix_shares_excess_again(spark):
    df = spark.createDataFrame([(i, prose(n), s) for i, (n, s) in enumerate([(1000, "a"), (10, "b"), (500, "c")])], "doc_id long, text string, source string")
    target = {r.source: r.target for r in mixing.mix(df).collect()}
    assert target == pytest.approx({"a": 370.0, "b": 30.0, "c": 1110.0})


def test_urls(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("x.com", "/a", "block"), ("x.com", "/a", "block"), (None, "/", "block"), ("org", "", "block")], "host string, path string, verdict string")
    urls = ["http://X.com/ab?q", "http://y.x.com/b", "http://xx.com", None, "no scheme", "ftp://a.org", "http://x.com/a#f", "http:///a"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, rule int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules, blocks=1).collect()}
    assert got[0] == got[8] == ("x.com", "/ab", "x.com/a", "block")
    assert got[1] == ("y.x.com", "/b", "com/", "allow")
    assert got[2] == ("xx.com", "", None, "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("a.org", "", "org", "block")
    assert got[7] == ("", "/a", None, "allow")
    assert url_filter.judge(df.limit(0), rules).count() == 0
    assert url_filter.judge(df, rules.limit(0)).filter("verdict <> 'allow' or rule is not null").count() == 0


def test_url_filter_grows_with_its_rules(spark):
    from pyspark.sql import functions as F

    def passing(n_rules, blocks):
        """Of 4,000 keys that no rule has, how many the filter lets through."""
        words = url_filter.bloom_blocks(spark.range(n_rules).select(F.concat(F.lit("h"), "id", F.lit(".com/")).alias("key")), blocks)
        keys = spark.range(4000).select(F.concat(F.lit("x"), "id", F.lit(".org/")).alias("key"))
        keys = keys.select(url_filter._block(F.col("key"), blocks).alias("block"), url_filter._mask(F.col("key")).alias("mask"))
        return keys.join(words, "block").filter("(word & mask) = mask").count()

    assert max(passing(n, max(url_filter.MIN_BLOCKS, n // url_filter.RULES_A_BLOCK)) for n in (10, 8000, 40_000)) < 80
    assert passing(40_000, url_filter.MIN_BLOCKS) > 500


def test_urls_against_brute_force_over_many_rules(spark):
    rnd = random.Random(7)
    hosts = [".".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    paths = ["", "/", "/a", "/a/b", "/b/", "/a/bc"]
    rules = {(rnd.choice(hosts), rnd.choice(paths)): rnd.choice(["allow", "block"]) for _ in range(600)}
    urls = [(i, f"http://{rnd.choice(['', 'x.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'c', '/b', '?q', '#a/b'])}") for i in range(1500)]
    df = spark.createDataFrame(urls, "page_id long, url string")
    listed = spark.createDataFrame([(h, p, v) for (h, p), v in rules.items()], "host string, path string, verdict string")
    for blocks in (None, 1):
        for r in url_filter.judge(df, listed, blocks=blocks).collect():
            fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items() if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
            assert (r.rule, r.verdict) == (max(fits)[2:] if fits else (None, "allow"))


def test_vectors_match_brute_force(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + r.normal(size=24) * 0.1).tolist(), i % 3) for i in range(400)]
    rows += [(400 + i, rows[0][1], 0) for i in range(50)] + [(7, rows[0][1], 0)]
    rows += [(500, None, 0), (501, [0.0] * 24, 0), (502, [float("nan")] * 24, 1), (503, [None] * 24, 1), (504, rows[0][1], None), (505, [], 0), (506, [1.0], 0), (None, rows[0][1], 0), (507, [1e200, 1e200], 0), (508, [1e200, 1.01e200], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_dedup.near_duplicates(df.selectExpr("*", "1 AS n", "2 AS links", "3 AS tile"), tile=64).collect()
    assert len(got) == len(rows)
    use = [k for k, (i, e, lab) in enumerate(rows) if i is not None and lab is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    near = {k: [] for k in use}
    for a in use:
        for b in use:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]) / np.max(rows[a][1]), np.array(rows[b][1]) / np.max(rows[b][1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    near[a].append(b)
                    near[b].append(a)
    low = {k: rows[k][0] for k in use}
    for _ in range(len(use)):
        new = {k: min([low[k], *(low[j] for j in near[k])]) for k in use}
        if new == low:
            break
        low = new
    want = [(i, len(near.get(k, [])), low.get(k, i), None if i is None else low.get(k, i) == i) for k, (i, _, _) in enumerate(rows)]
    assert by_id(got) == by_id(want)
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


def reference_print(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_matches_brute_force(spark, odd):
    texts = {i: t for i, t, *_ in ODD if i is not None} | {100 + i: " ".join(w if rng.random() > 0.01 else "zz" for w in BASE.split()) for i in range(60)} | {200 + i: prose(4) for i in range(40)}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, fp int")
    prints = {i: reference_print(t) for i, t in texts.items()}
    low = {i: i for i in prints}
    while True:
        new = {i: min(low[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
        if new == low:
            break
        low = new
    want = [(i, f"{p:016x}", low[i]) for i, p in prints.items()]
    assert by_id(simhash.near_duplicates(df).collect()) == by_id(want)
    assert by_id(simhash.near_duplicates(df, tile=8).collect()) == by_id(want)
    assert simhash.near_duplicates(odd).count() == len(ODD)
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, *sorted({r.component_id for r in simhash.near_duplicates(odd.filter("doc_id is not null")).collect()})])
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_simhash_links_through_rows_without_an_id(spark, monkeypatch):
    prints = {1: 0xDB3DB18888D8A39A, None: 0xDB1DB18888D8839A, 2: 0xDB1DB18A88C8839A, 3: 0}
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    monkeypatch.setattr(simhash, "fingerprints", lambda documents, words: documents)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    assert got == {i: (f"{p:016x}", 3 if i == 3 else 1) for i, p in prints.items()}
    alone = spark.createDataFrame([(None, 7), (None, 6), (5, -1)], "doc_id long, fp long")
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(alone).collect()) == ["5", "None", "None"]


def test_simhash_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, BASE), (1, BASE + " x"), (2, BASE), (3, "other text"), (None, BASE)], "doc_id long, text string")
    names = ["_key", "_turn", "id_of_row", "Turn_Of_Row", "key", "fp", "rep", "root", "component_id"]
    kept = simhash.keep_one(df.selectExpr("*", *[f"'{n}' AS {n}" for n in names]))
    assert kept.columns == ["doc_id", "text", *names]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", BASE), ("3", "other text"), ("None", BASE)]
    assert all(tuple(r)[2:] == tuple(names) for r in kept.collect())


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (2000, 1001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 200)) and got[2000] == 1000
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/ü x", "<p>é</p>", 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<p>é</p>", 1), (4, "u", "<p>é</p>", 1), (None, "n", "<p>é</p>", 1), (9, "z", "y" * 3_000_000, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload int")
    archives = warc.write_archives(df, archive_bytes=2000)
    got = warc.read_archives(archives).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [(p, len((h or "").encode()), sha(h), "response" if p in (4, 3, 9) else "revisit", {1: 4, 2: 3, None: 4}.get(p)) for p, _, h, _ in pages]
    assert by_id((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == by_id(want)
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {"<p>é</p>".encode(), b"", b"y" * 3_000_000}
    for r in archives.collect():
        (tmp_path / r.path).write_bytes(r.content)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst")
    assert by_id(warc.read_archives(files).drop("payload").collect()) == by_id(warc.read_archives(archives).drop("payload").collect())
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_warc_reader_refuses_broken_archives():
    whole = next(warc.archives(iter([warc.record(1, b"u", b"payload", None, False)] * 20), 1 << 20))
    assert len([warc.parse_record(r) for r in warc.read_records(whole)]) == 20
    for broken in (b"", whole[:-5], whole[8:], whole[:6]):
        with pytest.raises((warc.WarcError, Exception)):
            list(warc.read_records(broken))
    good = warc.record(1, b"u", b"payload", None, False)
    for bad in (good.replace(b"payload", b"paYload"), good.replace(b"WARC-Date", b"X"), good[:-1], good.replace(b"sha1:", b"md5:"), b"junk"):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)


def test_lm_counts_and_normalisation(spark, odd):
    got = ngram_lm.score(odd, batch_bytes=2000, part_bytes=500).collect()
    assert len(got) == len(ODD)
    toks = lambda t: [*(t or "").encode().lower().split(), None]
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    counts = Counter(w for i, t, *_ in ODD if fold(i) not in (None, 2) for w in toks(t))
    n, v = sum(counts.values()), len(counts)
    want = [(i, fold(i) == 2, len(toks(t)), sum(counts[w] > 0 for w in toks(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks(t)), 6)) for i, t, *_ in ODD]
    assert by_id((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == by_id(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert ngram_lm.score(odd.limit(0)).count() == 0
    weights = ngram_lm.learn_weights([(3, 8, 4, 100), (3, None, 2, 10), (0, None, None, 5)])
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and weights[3, 0] > weights[3, 2]


def test_lm_beats_the_base_on_held_out_text(spark):
    rows = queries.op6_lm_scoring(spark, SMALL).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_models_are_distributions():
    counts = {"x": dict(langid.grams_of("abba baba abab bab a")), "y": dict(langid.grams_of("cddc dcdc xyz"))}
    m = langid.Model(counts)
    for context in ([0, 0, 0], [1, 2, 1], [2, 3, 2], [3, 4, 5]):
        grams = np.array([((context[0] * m.base + context[1]) * m.base + context[2]) * m.base + s for s in range(m.base)])
        assert np.allclose(np.exp(m._log_probability(grams, langid.ORDER)).sum(axis=0), 1, atol=1e-4)


def test_small_languages_reject_foreign_text(spark):
    alphabets = {"x": "abcdefgh", "y": "mnopqrst"}
    r = random.Random(3)
    text = lambda letters: " ".join("".join(r.choices(letters, weights=range(len(letters), 0, -1), k=r.randint(2, 7))) for _ in range(60))
    docs = [(i, text(alphabets["xy"[i % 2]]), "xy"[i % 2]) for i in range(60)]
    foreign = [(1000 + i, text("abMNwvzuéü"), None) for i in range(20)]
    rows = {r.doc_id: r for r in langid.identify(spark.createDataFrame(docs + foreign, "doc_id long, text string, lang string")).collect()}
    assert all(rows[i].lang_pred == lang and rows[i].score > 0.5 for i, _, lang in docs)
    assert all(rows[i].score < 0.01 for i, _, _ in foreign)


def test_language_id(spark, odd):
    rows = langid.identify(odd, max_docs=100).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 9)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.identify(odd.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.filter("lang is null")).collect()} == {"und"}
    truth = {r.doc_id: r.lang for r in queries.table(spark, SMALL, "documents").collect()}
    held = [r for r in queries.op7_language_id(spark, SMALL).collect() if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_leaks(spark, odd):
    item = prose(20)
    docs = [(1, prose(500) + " " + item.upper() + " " + prose(500)), (2, prose(800)), (3, item), (3, item), (4, " ".join(item.split()[:9])), (5, "Alpha beta"), (6, None), (None, LONG + " " + item)]
    bench = spark.createDataFrame([(10, item, 1), (10, item, 1), (11, "alpha beta", 1), (12, None, 1), (None, item, 1), (13, "", 1), (14, prose(2000), 1)], "item_id long, text string, doc_id int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = by_id((r.doc_id, r.item_id, r.containment) for r in decontaminate.leaks(df, bench).collect())
    assert got == by_id([(1, 10, 1.0), (3, 10, 1.0), (3, 10, 1.0), (5, 11, 1.0), (None, 10, 1.0)])
    assert got == by_id((r.doc_id, r.item_id, r.containment) for r in decontaminate.leaks(df, bench, block_items=1).collect())
    assert by_id(r.doc_id for r in []) == [] and sorted(str(r.doc_id) for r in decontaminate.clean(df, bench).collect()) == ["2", "4", "6"]
    assert decontaminate.clean(odd, bench).columns == odd.columns
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0 and decontaminate.leaks(df.limit(0), bench).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Home</li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One <b>two</b><br>three<p>Four  &lt;5<aside>Side</aside>
<div class="x1">Always the same</div><form><p>Mail</p></form><div id="comments"><p>First!</p></div></article><div class="sidebar">S</div>
<script>var a = "<p>no</p>";</script><!-- c --><footer>&copy; F</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(PAGE) == "Head & line\nOne two three\nFour <5\nAlways the same"
    assert main_text.main_text(None) == main_text.main_text("") == ""
    assert main_text.main_text("plain a < b text") == "plain a < b text"
    assert main_text.main_text("<p>a<p>b</div></span><i>c<b") == "a\nbc" or main_text.main_text("<p>a<p>b</div></span><i>c<b") == "a\nb c"
    assert main_text.main_text("<div>" * 20_000 + "deep") == "deep"


def test_style_tree_removes_what_a_host_repeats(spark):
    pages = [(i, "http://h.com/%d" % i, PAGE.replace("One", prose(30)).replace("Head", prose(3)), 1) for i in range(8)]
    pages += [(20, None, None, 1), (None, "http://one.com/", PAGE, 1), (21, "x", "", None)] + [(30 + i, "http://copy.com/%d" % i, PAGE, 1) for i in range(9)]
    got = {r.page_id: r for r in main_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text int")).collect()}
    assert len(got) == len(pages)
    assert all("Always the same" not in got[i].text and "Four <5" in got[i].text for i in range(8))
    assert "Always the same" in got[None].text and all("Always the same" in got[30 + i].text for i in range(9))  # one page; copies of one page
    assert got[20].text == got[21].text == "" and got[0].n_chars == len(got[0].text)


def test_toxicity(spark, odd):
    labels = [(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (401, None), (402, 7), (0, 0)]
    docs = [(i, prose(60) + (" vilest" if i % 4 == 0 else "")) for i in range(500)] + [(600, None), (601, ""), (None, "vilest"), (499, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'a' AS toxic", "1 AS score")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.score(df, known).collect()
    assert len(rows) == len(docs)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in rows if r.doc_id is not None and r.doc_id < 499)
    assert all(len(r.evidence) == 15 for r in rows if r.predicted)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert {r.score for r in toxicity.score(odd, known.limit(0)).collect()} == {0.0}
    assert toxicity.score(df.limit(0), known).count() == 0


def test_toxicity_learns_from_texts_that_share_a_word(spark):
    shared = min(VOCABULARY, key=lambda w: xxhash.xxh3_64_intdigest(w.encode()))
    docs = [(i, f"{shared} {prose(40)}" + (" vilest" if i % 4 == 0 else "")) for i in range(200)]
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    rows = toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), known).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in rows)
    assert all(len({e.doc_id for e in r.evidence}) == 15 for r in rows if r.predicted)


def test_toxicity_cosines_are_over_whole_texts(spark):
    docs = [(i, prose(40) + (" vilest" if i % 4 == 0 else "")) for i in range(200)] + [(1000 + i, f"zq{chr(97 + i)}x " * 3 + prose(20)) for i in range(8)]
    labels = [(i, int(i % 4 == 0)) for i in range(200)] + [(1000 + i, 1) for i in range(8)]
    new = [(-1, "zqcx zqcx"), (-2, "vilest " + " ".join(f"qq{w}qq" for w in VOCABULARY[:200])), (-3, "vilest"), (-4, "neverseen")]
    df = spark.createDataFrame(docs + new, "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score(df, spark.createDataFrame(labels, "doc_id long, toxic int"), folds=1, held_out=1).collect()}
    assert all(r.evidence for i, r in rows.items() if i != -4)  # texts without a marker have neighbours too
    assert rows[-1].evidence[0].doc_id == 1002  # a word of one example counts
    assert max(e.cosine for e in rows[-2].evidence) < max(e.cosine for e in rows[-3].evidence)  # so do the words beside a marker
    assert rows[-4].evidence == []


@pytest.mark.parametrize(("html", "want"), [
    ('<article class="post has-sidebar"><p>Body.</p></article>', "Body."),
    ('<main class="with-comments comments"><p>Body.</p></main>', "Body."),
    ('<div class="content no-sidebar"><article><p>Body.</p></article></div><p>Out.</p>', "Body."),
    ('<p>Out.</p><div class="widget"><div><article><p>The long body.</p></article></div></div>', "The long body."),
    ('<article><p>Body.</p></article><div class="related"><article><p>A teaser longer than the body.</p></article></div>', "Body."),
    ('<main><p>The body itself.</p><div class="comments"><article>Me too</article></div></main>', "The body itself."),
    ('<main><article class="post sponsored"><p>Body.</p><article class="comment">No</article></article></main>', "Body."),
    ('<article><div class="header"><h2 id="social-impact">One</h2></div><section id="related"><p>Two</p></section><div class="share">No</div></article>', "One\nTwo"),
    ('<article><div class="article-header"><h1>One</h1></div><section id="search-methods">Two</section></article>', "One\nTwo"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p></article>", "Let x=1 be."),
])
def test_names_keep_the_article(html, want):
    assert main_text.main_text(html) == want


def test_marked_part_must_hold_most_of_the_text(spark):
    body, teasers = prose(80), "".join(f"<article class='card'><p>{prose(4)}</p></article>" for _ in range(3))
    pages = [(1, "http://a.com/1", f"<div><p>{body}</p></div>{teasers}"), (2, "http://a.com/2", f"<p>Short.</p><article><p>{body}</p></article>")]
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert body in got[1] and got[2] == body
    assert all(got[i] == main_text.main_text(html) for i, _, html in pages)


def test_breaks_and_names_of_a_page():
    assert main_text.main_text("<p>one</p>two<hr>three") == "one\ntwo\nthree"
    assert main_text.main_text("<p>a<hr/>b</hr><nav>x<hr>y</nav>") == "a\nb"
    for name in ("site-header", "comments-area", "comment-list", "page-footer"):
        assert main_text.main_text(f'<body><p>Body</p><div class="x {name}"><p>gone</p></div></body>') == "Body"


def test_deep_pages_take_work_by_their_length():
    page = main_text.read_page("<div>x" * 20_000)
    assert len(page.blocks) == len(page.paths) == len(page.ups) == len(page.nodes) == 20_000
    deep = main_text.read_page("<div>x" * 3 + "</div>" * 3 + "<div>y")
    assert deep.ups == [-1, 0, 1, -1]
    assert main_text.main_text("<div>x" * 3 + "</div>" * 3 + "<div>y", frozenset([deep.paths[1]])) == "x\ny"
    assert main_text.main_text("<div>x" * 3 + "</div>" * 3 + "<p>y", frozenset([deep.paths[0]])) == "y"


def test_equal_contents_have_equal_hashes_wherever_they_stand():
    page = main_text.read_page("<p>z</p><div><p>a</p><p>b</p></div><div><p>a</p><p>b</p></div><div><p>b</p><p>a</p></div><div><p>a b</p></div>")
    held = [c for n, _, c in page.nodes if n == page.paths[1]]
    assert held[0] == held[1] and len(set(held)) == 3


def test_importance_is_that_of_brute_force(spark):

    rnd = random.Random(3)
    pages = []
    for i in range(40):
        body = "".join(f"<p>{rnd.random()}</p>" for _ in range(rnd.randint(1, 4)))
        side = rnd.choice(["<b>Offer</b>", "<i>Offer</i>", "<b>Other</b>"])
        pages.append((i, f"http://h{i % 2}.example/{i}", f'<div class="top">Always</div><div class="mid">{side}</div><div class="text">{body}</div><div class="end">{rnd.choice("ab")}</div>'))
    pages += [(90, *pages[0][1:]), (91, "http://h9.example/", "<div>alone</div>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    seen = {}
    for _, url, html in set(pages[:40]) | {pages[-1]}:
        for node, style, content in main_text.read_page(html).nodes:
            seen.setdefault((url.split("/")[2], node), []).append((html, style, content))
    want = {}
    for key, rows in seen.items():
        m = len({h for h, *_ in rows})
        styles, contents = Counter(min(s for h2, s, _ in rows if h2 == h) for h in {h for h, *_ in rows}), Counter(c for _, c in {(h, c) for h, _, c in rows})
        shown = -sum(k / m * math.log(k / m, m) for k in styles.values()) if m > 1 else 1.0
        n = sum(contents.values())
        content = 1 - sum(k / n * math.log(k) for k in contents.values()) / math.log(m) if m > 1 else 1.0
        weight = main_text.GAMMA ** (len(styles) - 1)
        want[key] = (m, round((1 - weight) * shown + weight * content, 9))
    from pyspark.sql import functions as F
    host = F.split("url", "/")[2]
    nodes = main_text.parse(df).withColumn("host", host).select("host", "page", F.explode("nodes").alias("x")).select("host", "page", "x.*")
    assert {(r.host, r.node): (r.pages, round(r.importance, 9)) for r in main_text.importance(nodes).collect()} == want
    # the branch that is the same everywhere goes, without a telling tag or class; the others stay
    low = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert all("Always" not in low[i] and low[i] for i in range(40)) and low[91] == "alone" and low[90] == low[0]
