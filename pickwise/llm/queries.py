"""Registered queries of the training-data operators, over the whole tables.

Each query is thin: it reads its table, calls its operator with production
parameters and returns the contract's columns. ``ORACLES`` has DuckDB SQL
where SQL can express a result; the others are held against brute force in
``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import decontaminate, langid, main_text, mixing, ngram_lm, oracle, runs, shared, simhash, topk, toxicity, url_filter, vector_dedup, warc, whitening

#: Rules of the registered URL query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(rule) for rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = shared.stored(warc.write_archives(table(spark, sf_dir, "pages")), "warc")
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.col("evidence.doc_id").alias("evidence"))


#: The words of a text, then those of the contract of op11: from word a on, p words repeat.
PLANTED = r"""transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w -> array_join(
  transform(sequence(0, size(w) - 1), i -> w[int(if(i < g % size(w), i,
    g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8))))]), ' '))[0]"""


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.withColumn("g", F.expr("h div 10")).select("doc_id", F.expr(rf"if(h % 10 = 0 and text rlike '[^\\x20\\x09-\\x0D]', {PLANTED}, text)").alias("text"))
    found = runs.periodic_runs(docs).withColumn("longest", F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"))
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr("-longest.start").alias("start"), F.col("longest.length").alias("length"), F.expr("-longest.period").alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_mix_sources, op2_url_filter, op3_embedding_near_dedup, op4_simhash_near_dedup, op5_warc_round_trip, op6_lm_scoring, op7_language_id, op8_benchmark_leaks, op9_main_text, op10_toxicity,
              op11_periodic_runs, op12_exact_top_k, op13_embedding_whitening)
}
ORACLES: dict[str, str] = {
    "op1_mix_sources": oracle.MIX,
    "op2_url_filter": oracle.URLS,
    "op3_embedding_near_dedup": oracle.VECTORS,
    "op5_warc_round_trip": oracle.WARC,
    "op8_benchmark_leaks": oracle.LEAKS,
    "op12_exact_top_k": oracle.TOP_K,
}
