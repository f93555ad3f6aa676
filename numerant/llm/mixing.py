"""Mixing sources to target weights by a low-discrepancy schedule.

``targets``: the sources share ``total`` words by weight; a target stops at ``repeats`` times the words of
its source, and the excess is shared anew by weight until no target is above that.

``schedule``: slot i of ``SLOTS`` equal slots gets the point of the golden-ratio sequence, the fraction of
i times the golden ratio kept in 32 bits, and the source in whose part of the cumulative targets the
point falls. Any run of slots holds each source nearly in proportion. The rank of a slot among its
source's slots says which block of that source it takes.

``tape``: the documents of a source in a seeded shuffled order (by a digest of the key), end to end;
blocks are equal numbers of words on it, and a rank beyond the last block starts over, ``repeats``
times at most. ``blocks`` joins slots with the pieces of documents inside their block.

A block grows with the corpus (5 billion words: 4,769 words), so by its points alone a source whose target is under a few
blocks would get none or too much. ``closed`` gives each source just the slots that cover its target, in whole words: slots
beyond are left out, missing ones come after the last slot, and the last block is taken in part. So a source's taken words are its
target, rounded to a whole word, whatever the corpus and the number of slots.

Everything is arithmetic of whole numbers, so reruns agree. Sums along a tape are taken in two levels
(common.running_sum), sums over the sources as well (common.sums_before): no task holds a whole source or all sources.
A slot meets its source by the cell of its point, an equal part of the range of points in which a few sources lie.

Defined results: a null text has no words and nothing of it is taken; null is a source, the last one;
a source without words has target 0, and if there is none with words all have; rows with the same key are separate documents; an empty table
gives an empty result; other columns stay with the rows in ``mixed`` and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import ROW, WORD, numbered, packed, running_sum, sums_before, table, text_of, written

SLOTS = 1 << 20
SPAN = 12  # bits of a slot inside its span, in which ranks are counted
GOLDEN = 2654435769  # 2^32 divided by the golden ratio
WEIGHTS = (1, 2, 3)
REPEATS = 3


def words_in(text: Column) -> Column:
    """Number of words: starts of words, so no text is split."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def sizes(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """key, row, size, source and the shuffled order of each document."""
    order = F.md5(F.concat_ws("-", F.lit("mix"), F.col(key).cast("string")).cast("binary"))
    return numbered(docs.select(key, source, text)).select(
        F.col(key).cast("long").alias("key"), F.col(ROW).alias("row"), words_in(text_of(text)).alias("size"),
        F.col(source).isNull().alias("no_source"), F.coalesce(F.col(source), F.lit("")).alias("source"), order.alias("order"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """no_source, source, source_size, low, high, target; one row per source.

    Sources are taken by capacity per weight: the first so many are full, the others share what is left
    by weight. low and high bound the source's part of the cumulative targets, as 32-bit fractions.
    """
    each = rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    each = sums_before(each.withColumn("one", F.lit(1).cast("long")), ["no_source", "source"], {"place": "one"})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int")).cast("double")
    each = each.select("no_source", "source", "source_size", weight.alias("weight"), (F.col("source_size") * repeats).alias("capacity"))
    each = written(each.withColumn("fill", F.col("capacity") / F.col("weight")), "mix-sources")
    all_ = each.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")).first()
    # The level rises while sources fill up, so the highest is the one that holds in the end.
    filled = sums_before(each, ["fill", "no_source", "source"], {"full": "capacity", "full_weight": "weight"})
    level = (F.lit(float(all_["words"])) - F.col("full")) / (F.lit(all_["weight"]) - F.col("full_weight"))
    full = filled.agg(F.max(level).alias("level")).first()["level"] or 0.0
    each = each.withColumn("target", F.least(F.col("capacity").cast("double"), F.lit(full) * F.col("weight")))
    total = each.agg(F.sum("target").alias("t")).first()["t"] or 1.0
    # Parts as whole numbers of 40 bits: the end of one is the beginning of the next.
    each = sums_before(each.withColumn("part", F.floor(F.col("target") / F.lit(total) * 2.0**40).cast("long")), ["no_source", "source"], {"before": "part"})
    edge = lambda upto: F.shiftright(upto, 8)
    return each.select("no_source", "source", "source_size", "target", edge(F.col("before")).alias("low"), edge(F.col("before") + F.col("part")).alias("high"))


def schedule(goals: DataFrame, slots: int = SLOTS) -> DataFrame:
    """slot, no_source, source, rank: which block of which source comes when. ``goals``: targets, written."""
    spark = goals.sparkSession
    parts = goals.where("high > low")
    cell = 32 - min(20, max(8, parts.count().bit_length()))  # bits of a point inside its cell
    met = F.sequence(F.shiftright("low", cell), F.shiftright(F.col("high") - 1, cell))
    parts = written(parts.select("low", "high", "no_source", "source", F.explode(met).alias("cell")), "mix-cells")
    point = (F.col("slot") * GOLDEN).bitwiseAND(2**32 - 1)
    points = spark.range(0, slots, 1, max(1, slots >> 16)).select(F.col("id").alias("slot"), F.shiftright("id", SPAN).alias("span")).withColumn("point", point)
    points = points.withColumn("cell", F.shiftright("point", cell))
    hit = points.join(broadcast_if_small(parts), "cell").where("low <= point and point < high").select("slot", "span", "no_source", "source")
    inside = F.row_number().over(Window.partitionBy("no_source", "source", "span").orderBy("slot")) - 1
    spans = hit.groupBy("no_source", "source", "span").agg(F.count("*").alias("n"))
    before = Window.partitionBy("no_source", "source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("no_source", "source", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = hit.withColumn("inside", inside).join(starts, ["no_source", "source", "span"])
    return ranked.select("slot", "no_source", "source", (F.col("start") + F.col("inside")).alias("rank"))


def closed(plan: DataFrame, goals: DataFrame, words: int, slots: int) -> DataFrame:
    """``plan`` with as many slots of each source as its target has blocks of ``words`` words, a part of one as one."""
    had = plan.groupBy("no_source", "source").agg(F.count("*").alias("had"))
    wanted = goals.select("no_source", "source", F.ceil(F.round("target") / F.lit(words)).cast("long").alias("wanted")).where("wanted > 0")
    wanted = written(wanted.join(had, ["no_source", "source"], "left").withColumn("had", F.coalesce("had", F.lit(0))), "mix-wanted")
    kept = plan.join(wanted.drop("had"), ["no_source", "source"]).where("rank < wanted").select("slot", "no_source", "source", "rank")
    short = wanted.where("had < wanted").withColumn("missing", F.col("wanted") - F.col("had"))
    short = sums_before(short, ["no_source", "source"], {"place": "missing"})  # after the last slot
    short = short.withColumn("place", F.lit(slots) - F.col("had") + F.col("place"))
    added = short.withColumn("rank", F.explode(F.sequence("had", F.col("wanted") - 1)))
    return kept.union(added.select((F.col("place") + F.col("rank")).alias("slot"), "no_source", "source", "rank"))


def blocks(tape: DataFrame, plan: DataFrame, goals: DataFrame, words: Column, repeats: int = REPEATS) -> DataFrame:
    """row, slot, rank, first, taken: the pieces of documents that a slot takes, up to the target.

    ``words`` is the number of words in a block, ``first`` the first word of the document in it. A
    document meets as many blocks as its words span, in each round of the tape: the pieces grow with the
    documents and the slots, never with their product.
    """
    end = F.round("target").cast("long")
    sized = tape.join(goals.select("no_source", "source", "source_size", end.alias("end")), ["no_source", "source"]).where("size > 0")
    rounds = sized.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    begin = F.col("start") + F.col("round") * F.col("source_size")
    rounds = rounds.withColumn("begin", begin).withColumn("block_words", words).where("begin < end")
    met = F.sequence(F.floor(F.col("begin") / F.col("block_words")), F.floor((F.col("begin") + F.col("size") - 1) / F.col("block_words")))
    pieces = rounds.withColumn("rank", F.explode(met))
    taken = pieces.join(plan, ["no_source", "source", "rank"])
    left = F.greatest(F.col("begin"), F.col("rank") * F.col("block_words"))
    right = F.least(F.col("begin") + F.col("size"), (F.col("rank") + 1) * F.col("block_words"), F.col("end"))
    return taken.where(right > left).select("row", "slot", "rank", (left - F.col("begin")).alias("first"), (right - left).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, slots: int = SLOTS) -> DataFrame:
    """key, row, size, source_size, target, taken for every document; taken: words in all slots."""
    rows = written(sizes(docs, key, source, text), "mix-sizes")
    goals = written(targets(rows, weights, repeats), "mix-targets")
    total = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t")).first()["t"]
    words = max(1, -(-total // slots))
    block_words = F.lit(words)
    used = -(-total // words)  # as many blocks as hold all words: fewer than slots if words are few
    plan = closed(schedule(goals, used), goals, words, used)
    tape = running_sum(rows.where("size > 0"), ["no_source", "source"], ["order", "key", "size", "row"], "size", "start")
    pieces = blocks(tape, plan, goals, block_words, repeats).groupBy("row").agg(F.sum("taken").alias("taken"))
    every = rows.join(pieces, "row", "left").join(goals, ["no_source", "source"])
    return every.select("key", "row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, source, md5('mix-' || doc_id) AS ord
  FROM documents
), s AS (
  SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::double AS weight FROM s
), l AS (
  SELECT *, ((sum(source_size) OVER ())::double - 3 * coalesce(sum(source_size) OVER f, 0)::double)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0.0)) AS level
  FROM w WINDOW f AS (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT source, source_size, least((3 * source_size)::double, (SELECT max(level) FROM l) * weight) AS target FROM l
), x AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size))
        + greatest(0, least(size, goal - start - 2 * source_size)))::bigint AS taken
FROM x JOIN (SELECT *, round(target)::bigint AS goal FROM g) n ON x.source IS NOT DISTINCT FROM n.source
"""


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in whole documents: a part of half or more counts as one.

    Of a source one document at most is taken in part, so it is off its target by half a document at most.
    Documents without words are never taken.
    """
    found = mixed(docs).select(F.col("row").alias(ROW), F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("times"))
    chosen = packed(docs).join(found.where("times > 0"), ROW)
    return chosen.select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("doc.*")
