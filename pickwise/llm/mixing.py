"""Mixing sources to target weights by a low-discrepancy source schedule.

Slot n of the mix gets the golden-ratio point frac(n / phi), in integers:
(n * A mod 2^31) / 2^31. Each further run of 2^31 slots visits the same points
moved on by a part of the gap between two of them, the golden-ratio point of
the run's number, so that points go on filling gaps (2^53 in all) and a source
narrower than a gap comes up too. The points are mapped through the cumulative slot
shares of the sources, so every stretch of the schedule holds each source in
its share. The k-th slot of a source takes the k-th block of ``block_words``
words of that source's shuffled stream (documents in the order of a hash of
their id); past the end the stream starts again. A source stops at its target,
inside a block if need be.

All steps are DataFrame operations. No window spans a whole source: positions
in a stream and ranks of slots are prefix sums in two levels (sums of hash
buckets or of stretches of the schedule, then rows inside one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.shared import WORD, stored

POINTS = 1 << 31
GOLDEN = 1327217885  # POINTS / golden ratio, odd: each run of POINTS slots visits every point once
RUNS = 1 << 22
GOLDEN_RUN = 2592175  # RUNS / golden ratio, odd
GRID = 1024
STRETCH = 1 << 14


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """One row per source: (sid, source, source_size, target).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    all words; a target stops at ``max_repeat`` times its source and the excess
    is shared again by weight (water level over the sources sorted by size per
    weight). Only the per-source sums meet in one task.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("sid"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("rest", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.coalesce("full", F.lit(0))) / F.col("rest"))
        .withColumn("ok", F.col("level") <= F.col("cap") / F.col("w"))
        .withColumn("level", F.first(F.when(F.col("ok"), F.col("level")), ignorenulls=True).over(
            fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return per.select("sid", "source", "source_size", target.alias("target"))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """The mix in order: (slot, sid, block, words), ``words`` from the start of
    ``block`` of source ``sid``'s stream. Slots run a little past the summed
    need, so that each source comes up often enough to reach its target."""
    spark = targets.sparkSession
    goal = F.floor(F.col("target") + 0.5).cast("long")
    need = targets.filter("source_size > 0").withColumn("goal", goal).filter("goal > 0")
    rest = F.col("goal") % F.col("source_size")
    need = need.withColumn("n_blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}")).withColumn(
        "slots", F.expr("goal div source_size") * F.col("n_blocks") + F.expr(f"(goal % source_size + {block_words - 1}) div {block_words}"))
    everything = Window.orderBy("sid")
    need = (
        need.withColumn("hi", F.sum("slots").over(everything.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("lo", F.col("hi") - F.col("slots"))
        .withColumn("n", F.sum("slots").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    last = need.agg(F.expr("max(n) + ceil(3 * max(n) / min(slots))").alias("last"))
    stretches = last.select(F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(last - 1) div {STRETCH}"))).alias("stretch"), "last")
    stretches = stretches.repartition(F.col("stretch"))
    slots = stretches.select(
        "stretch", F.explode(F.sequence(F.col("stretch") * STRETCH, F.least(F.col("last"), (F.col("stretch") + 1) * STRETCH) - 1)).alias("slot"))
    slots = slots.withColumn("point", F.col("slot") % POINTS * GOLDEN % POINTS).withColumn("cell", F.expr(f"point div {POINTS // GRID}"))
    cells = need.select("*", F.explode(F.sequence(
        F.floor(F.col("lo") / F.col("n") * GRID), F.least(F.floor(F.col("hi") / F.col("n") * GRID), F.lit(GRID - 1).cast("long")))).alias("cell"))
    moved = F.expr(f"slot div {POINTS}") % RUNS * GOLDEN_RUN % RUNS / F.lit(float(RUNS))
    at = (F.col("point") + moved) * (F.col("n") / F.lit(float(POINTS)))
    # "merge": the planner can't know how many rows a sequence makes, and would send them to every task
    drawn = slots.join(cells.hint("merge"), "cell").filter((at >= F.col("lo")) & (at < F.col("hi")))
    drawn = drawn.select("stretch", "slot", "sid", "n_blocks", "source_size", "goal")
    before = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = drawn.groupBy("sid", "stretch").count().select(
        "sid", "stretch", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("sid", "stretch").orderBy("slot")
    ranked = drawn.withColumn("k", F.row_number().over(within) - 1).join(offsets.hint("merge"), ["sid", "stretch"])
    ranked = ranked.withColumn("k", F.col("k") + F.col("offset")).withColumn("block", F.col("k") % F.col("n_blocks"))
    used = F.expr(f"k div n_blocks * source_size + block * {block_words}")
    size = F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("block") * block_words)
    ranked = ranked.withColumn("words", F.least(size, F.col("goal") - used)).filter("words > 0")
    return ranked.select("slot", "sid", "block", "words")


def streams(sized: DataFrame, targets: DataFrame, buckets: int = 4096) -> DataFrame:
    """``sized`` with (sid, start): where each document's words begin in its
    source's shuffled stream. Order: 60 bits of md5 of the id, then id, size."""
    turn = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10)
    ids = targets.select("sid", F.col("source").alias("its"))
    docs = sized.withColumn("turn", turn.cast("long")).withColumn("bucket", F.expr(f"turn div {(1 << 60) // buckets}"))
    docs = docs.join(ids, docs["source"].eqNullSafe(ids["its"])).drop("its")
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = docs.groupBy("sid", "bucket").agg(F.sum("size").alias("sum")).select(
        "sid", "bucket", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("sid", "bucket").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs = docs.withColumn("end", F.sum("size").over(within)).join(offsets, ["sid", "bucket"])
    return docs.withColumn("start", F.col("offset") + F.col("end") - F.col("size")).drop("turn", "bucket", "end", "offset")


def mix(documents: DataFrame, block_words: int = 64, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Mix ``documents`` (doc_id, source, text; other columns are ignored).

    Returns one row per document: doc_id, source, size (words of the text),
    source_size, target (words its source should give), taken (words the mix
    takes of it, repeats counted). ``block_words`` trades the length of the
    schedule against how finely sources interleave.

    Null or empty texts have size 0 and give nothing; a null source is a
    source of its own, sorted last; a null id is shuffled as the text "null";
    repeated rows are documents of their own; an empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(documents.select("doc_id", "source", size.alias("size")), "mix-sizes")
    targets = stored(source_targets(sized, weights, max_repeat), "mix-targets")
    placed = streams(sized, targets)
    pieces = placed.filter("size > 0").select("sid", "start", "size", "doc_id", F.explode(F.sequence(
        F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"))
    plan = schedule(targets, block_words).groupBy("sid", "block", "words").count()
    takes = plan.groupBy("sid", "block").agg(F.collect_list(F.struct("words", "count")).alias("takes"))  # whole and one cut: two entries at most
    takes = stored(takes, "mix-takes")
    begin = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0).cast("long"))
    end = F.col("start") + F.col("size") - F.col("block") * block_words
    piece = F.aggregate("takes", F.lit(0).cast("long"), lambda total, t: total + t["count"] * F.greatest(
        F.lit(0).cast("long"), F.least(end, t["words"]) - begin))
    taken = pieces.join(takes, ["sid", "block"], "left").groupBy("sid", "start", "size", "doc_id").agg(F.coalesce(F.sum(piece), F.lit(0)).alias("taken"))
    empty = placed.filter("size = 0").select("sid", "size", "doc_id", F.lit(0).cast("long").alias("taken"))
    rows = taken.select("sid", "size", "doc_id", "taken").unionByName(empty)
    return rows.join(targets, "sid").select("doc_id", "source", "size", "source_size", "target", "taken")
