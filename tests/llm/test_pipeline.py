"""The pipeline, stage by stage, against what its operators say."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from pickwise.llm import decontaminate, langid, mixing, simhash, toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SMALL}/labels.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "language_id", "simhash_near_dedup", "decontamination", "mixing"]
    wanted = {
        "toxicity": lambda d: ids(toxicity.score(d, labels).filter("score < 0.5")),
        "language_id": lambda d: ids(langid.identify(d).filter(f"lang_pred <> 'und' and score >= {P.LANGUAGE_SCORE}")),
        "simhash_near_dedup": lambda d: sorted({r.component_id for r in simhash.near_duplicates(d).collect()}),
        "decontamination": lambda d: sorted(set(ids(d)) - set(ids(decontaminate.leaks(d, bench)))),
    }
    rows = docs.count()
    for name, stage in P.STAGES[:-1]:
        want = wanted[name](docs)
        docs = P.stored(stage(spark, docs, SMALL), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert ids(docs) == want
    assert 0.5 * rows < docs.count() < rows
    key = lambda r: tuple(map(str, r))
    assert sorted(P.run(spark, SMALL).collect(), key=key) == sorted(mixing.mix(docs).collect(), key=key)


rng = random.Random(12)
LETTERS = {"en": "abcdefgh", "de": "mnopqrst"}


def prose(lang, n):
    return " ".join("".join(rng.choices(LETTERS[lang], k=rng.randint(3, 7))) for _ in range(n))


ITEM = prose("en", 24)
TEXTS = {i: prose(lang, 40 + i % 5) for i, lang in enumerate(["en", "de"] * 60)}
TOXIC = {i: f"{TEXTS[i]} vilest scumbag vilest" for i in range(0, 60, 4)}
ODD = [(i, TOXIC.get(i, t), "en" if i % 2 == 0 else "de", "ab"[i % 2], 1) for i, t in TEXTS.items()]
ODD += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \n ", None, "é", 0), (203, "123 ?? 45", "en", "a", 9), (None, prose("de", 30), None, None, None), (None, None, None, None, None)]
ODD += [(1, TEXTS[1], "de", "b", 1), (1, prose("de", 30), "de", "b", 1), (204, TEXTS[3], "de", "b", 1)]  # a repeated row, a repeated id, a copy
ODD += [(205, f"{prose('en', 9)} {ITEM} {prose('en', 9)}", "en", "a", 1), (206, prose("en", 60_000), "en", "a", 1), (207, prose("en", 30_000) + " " + ITEM + " " + prose("en", 30_000), "en", "a", 1)]
EXTRA = ["row", "score", "predicted", "evidence", "lang_pred", "held_out", "fp", "component_id", "id_of_row", "_key", "_turn", "tile", "size", "sid", "taken", "item_id"]


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(i, int(i in TOXIC)) for i in TEXTS] + [(None, 1), (200, None), (201, 7), (0, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (None, "x y"), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *[f"'{n}' AS {n}" for n in EXTRA])


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_each_stage_on_odd_rows(spark, place, name):
    docs = odd(spark).repartition(5)
    got = dict(P.STAGES)[name](spark, docs, place)
    rows = [(r.doc_id, r.text if name != "mixing" else None) for r in got.collect()]
    if name == "mixing":
        assert sorted(str(i) for i, _ in rows) == sorted(str(r[0]) for r in ODD)
        return
    assert got.columns == docs.columns and all(r[n] == n for r in got.collect() for n in EXTRA)
    left, whole = Counter(rows), Counter((r[0], r[1]) for r in ODD)
    assert left <= whole  # nothing is made up or doubled
    gone = whole - left
    if name == "toxicity":
        assert {i for i, _ in gone} == set(TOXIC)
    elif name == "language_id":
        assert set(gone) == {(200, None), (201, ""), (202, " \n "), (203, "123 ?? 45"), (None, None)}
    elif name == "simhash_near_dedup":
        assert {i for i, _ in gone} == {201, 202, 1, 204} and sum(gone.values()) == 5 and left[200, None] == 1
        assert sum(n for (i, _), n in left.items() if i == 1) == 1 and sum(n for (i, _), n in left.items() if i is None) == 2
    else:
        assert {i for i, _ in gone} == {205, 207}


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_each_stage_on_an_empty_table(spark, place, name):
    docs = odd(spark).limit(0)
    got = dict(P.STAGES)[name](spark, docs, place)
    assert got.count() == 0 and (name == "mixing" or got.columns == docs.columns)


def test_stages_without_labels_and_items(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("toxicity", "decontamination"):
        assert dict(P.STAGES)[name](spark, odd(spark), str(tmp_path)).count() == len(ODD)
    assert dict(P.STAGES)["language_id"](spark, odd(spark).selectExpr("* EXCEPT (lang)", "cast(null AS string) AS lang"), str(tmp_path)).count() == 0
