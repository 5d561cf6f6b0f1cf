"""A corpus pipeline of the training-data operators.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame; it is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``; the last
returns the mix: how many words it takes of each document left.

Every stage takes nulls in any column, empty and very long texts, repeated rows,
an empty table and further columns of any name; what becomes of such rows is
said with each stage. Rows without an id are judged like any other by the
filters. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import decontaminate, langid, mixing, simhash, toxicity
from pickwise.llm.shared import stored

#: Documents whose language score is lower are rejected, as are those without any letter. Low, so that
#: short texts with odd tokens stay: what goes is far from any text the models were calibrated on.
LANGUAGE_SCORE = 0.01


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't call toxic.

    Whole texts are judged, however long. Null, empty and wordless texts have the
    score of such examples and stay unless most of those are toxic; without labels
    everything stays. Repeated rows are judged alike, each for itself."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, labels, carry=True).filter("predicted = 0").select("row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know.

    Null and empty texts and those without any letter go (they have no language),
    as does everything where no document has both a text and a language to learn
    from. Whole texts are judged; of languages at one entropy the first by name
    counts. Repeated rows are judged alike; a null language or source is no matter."""
    known = langid.identify(docs, carry=True)
    return known.filter((known["lang_pred"] != langid.UNKNOWN) & (known["score"] >= LANGUAGE_SCORE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id.

    Null, empty and blank texts are one group, so one of them stays. Rows without
    an id link others but all stay themselves, as no id stands for them. Of rows
    that repeat the id that stays, the one of the smallest text does (null first).
    Texts shorter than a shingle are compared whole, very long ones too."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay; items without text or id are no
    items; repeated rows go or stay together; of very long texts every part is
    searched. An empty benchmark lets everything stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the documents left: a row for each, also for those of no words.

    A null source is a source of its own, the last; null texts have size 0 and
    nothing is taken of them. Repeated rows are documents of their own. No
    documents give no rows."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: Toxicity, language ID and SimHash aren't expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
