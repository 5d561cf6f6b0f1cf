"""URL filters: a blocked Bloom filter of the listed canonical URLs in front
of an exact hash join.

A rule (host, path, verdict) fits its host and all subdomains when the URL's
path starts with the rule's path. A URL's candidates are its host suffixes
(no more labels than any rule has) times its path prefixes (of lengths that
rules have). Only candidates the filter passes are joined, by equality, with
the rules; the join removes the filter's false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import lower_ascii, stored

HASHES = 5
# A filter has at least MIN_BLOCKS blocks of 64 bits and one for every RULES_A_BLOCK rules.
MIN_BLOCKS = 2048
RULES_A_BLOCK = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/ ? #`` or the end, A-Z
    lower-cased; path from there up to ``?``, ``#`` or the end. Both are empty
    for null and for text without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    bits = F.xxhash64(F.lit("bloom"), key)
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        at = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return mask


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, word): the 64 bits of each block that holds a key of the ``key``
    column. A key sets ``HASHES`` bits of a single block; blocks not listed are empty."""
    words = keys.select(_block(F.col("key"), blocks).alias("block"), _mask(F.col("key")).alias("mask"))
    return words.groupBy("block").agg(F.bit_or("mask").alias("word"))


def judge(urls: DataFrame, rules: DataFrame, blocks: int | None = None, default: str = "allow") -> DataFrame:
    """Judge each row of ``urls`` (columns ``page_id`` and ``url``; others are ignored).

    ``rules`` has host, path, verdict. The longest fitting rule wins (host and
    path together; of equal lengths the longer host). Returns page_id, url,
    host, path, rule (host and path of the rule, else null), verdict
    (``default`` where no rule fits).

    The filter has ``blocks`` 64-bit blocks, by default as many as the number
    of rules asks for (16 bits a rule, about one miss in 200 passes), so the
    share of false positives stays as rules are added. Rules and filter are
    stored first (jobs), and the planner sends the filter everywhere while its
    bytes are under the broadcast threshold, else candidates meet it by block
    in a shuffle. Other sizes mean more or fewer false positives for the join,
    never other results. Urls are judged once per host and path, whole,
    however long.

    Null urls and urls without ``://`` have empty host and path and fit no
    rule; a null or empty rule host fits nothing; repeated rules count once
    (the smallest verdict); repeated rows each get their row; an empty table
    gives no rows.
    """
    listed = rules.filter("host <> ''").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    listed = listed.groupBy("rule_host", "rule_path").agg(F.min("rule_verdict").alias("rule_verdict"))
    listed = stored(listed.withColumn("key", F.concat("rule_host", "rule_path")), "url-rules")
    if blocks is None:
        blocks = max(MIN_BLOCKS, -(-listed.count() // RULES_A_BLOCK))
    shape = listed.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(0)).alias("labels"), F.collect_set(F.length("rule_path")).alias("lengths"))
    words = stored(bloom_blocks(listed, blocks), "url-bloom")

    host, path = host_and_path(F.col("url"))
    pages = urls.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    probe = pages.filter("host <> ''").select("host", "path").distinct().withColumns(
        {"labels": shape.select("labels").scalar(), "lengths": shape.select("lengths").scalar()})
    suffixes = F.expr("array_distinct(transform(if(labels > 0, sequence(1, labels), cast(array() as array<int>)), k -> substring_index(host, '.', -k)))")
    prefixes = F.expr("transform(filter(lengths, n -> n <= length(path)), n -> left(path, n))")
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("rule_host"), p.alias("rule_path"), F.concat(h, p).alias("key")))))
    pairs = probe.select("host", "path", F.explode(pairs).alias("pair")).select(
        "host", "path", "pair.rule_host", "pair.rule_path", _block(F.col("pair.key"), blocks).alias("block"), _mask(F.col("pair.key")).alias("mask"))
    hits = pairs.join(words, "block").filter(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")).select("host", "path", "rule_host", "rule_path")
    matched = hits.join(listed.drop("key"), ["rule_host", "rule_path"])
    best = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), F.length("rule_host").alias("h"))
    judged = matched.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), best).alias("won"))
    return pages.join(judged, ["host", "path"], "left").select(
        "page_id", "url", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict"))
