"""Mixing of sources to target weights by a low-discrepancy schedule.

Each source gets a target number of words.  Its documents are shuffled by a hash and laid on an axis of words, which is cut
into blocks of equal length; a source that is taken more than once goes over its axis again.  The slots of the mix are points
of a golden-ratio sequence, mapped through the cumulative target shares to a source, so that every stretch of the mix holds
the sources in proportion.  Slots are drawn until every source has met all its blocks: the r-th slot of a source carries its
r-th block, and what a document gives to the mix is what its blocks with a slot hold of it.

Ranks and running sums are made in two levels (within hash ranges, then over their totals), so that a source holding a third of
all rows is spread over many tasks.  Only the table of sources is taken whole: one row per source, of which there are few.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.sources.staging import stage

BLOCK_WORDS = 4096
RANGE_ROWS = 2_000  # documents or slots ranked together in one task, about; the root of their number, if that is more
CELLS = 1024  # grid over the cumulative shares
# The golden-ratio sequence leaves no gap wider than 2.618 / n after n points, so that among so many slots for each block every
# stretch of the shares that is a block long has been hit.
SLOTS_A_BLOCK = 2.7
SPARE_SLOTS = 64
# The golden ratio as a multiplier of a prime modulus; products stay within 63 bits.
MODULUS = 2_147_483_647
GOLDEN = 1_327_217_884


@dataclass
class Mix:
    sources: DataFrame  # source, source_size, target, goal (whole words)
    blocks: DataFrame  # slot, source, block: the order of the mix
    docs: DataFrame  # doc_id, source, size, source_size, target, taken, extra columns


def n_words(text: Column | str) -> Column:
    """Number of runs of characters that are no white space (null: 0)."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.trim(trimmed)
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def source_targets(sizes: DataFrame, weights: list[int], percent: int, most: int) -> DataFrame:
    """source, source_size, target, goal from (source, source_size): shares by weight that stop at ``most`` times the source.

    Filling by weight up to caps is one level: sources are full in the order of cap / weight, and the first prefix of them whose
    remainder fits gives the level of all others.
    """
    by_name = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    table = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    full = Window.partitionBy(F.lit(1)).orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    table = (
        table.withColumn("total", F.sum("source_size").over(everything) * percent / 100.0)
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("fits", F.col("left") * F.col("w") <= F.col("cap") * F.col("weight_left"))
        .withColumn("nth", F.row_number().over(full))
        .withColumn("level", F.min(F.when(F.col("fits"), F.struct("nth", "left", "weight_left"))).over(everything))
    )
    target = F.when(
        F.col("level").isNull(), F.col("cap")
    ).otherwise(F.least(F.col("cap").cast("double"), F.col("level.left") * F.col("w") / F.col("level.weight_left")))
    return table.select("source", "source_size", target.cast("double").alias("target")).withColumn(
        "goal", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most).cast("bigint")
    )


def _ranged(df: DataFrame, by: str, ranges: Column) -> tuple[DataFrame, DataFrame]:
    """df with its range, and (source, range, words and rows before the range)."""
    df = df.withColumn("range", ranges)
    per = df.groupBy("source", "range").agg(F.sum(by).alias("here"))
    so_far = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return df, per.select(F.col("source").alias("s"), F.col("range").alias("q"), F.coalesce(F.sum("here").over(so_far), F.lit(0)).alias("offset"))


def _range_rows(rows: int) -> int:
    return max(RANGE_ROWS, math.isqrt(rows))


def schedule(sources: DataFrame, blocks: int, block_words: int) -> DataFrame:
    """slot, source, block: the slots of the golden-ratio sequence that carry a block.  ``blocks``: of all sources together.

    The shares of the sources are their blocks; a source takes the slots that fall into its share until it has none left.
    """
    spark = sources.sparkSession
    slots = int(blocks * SLOTS_A_BLOCK) + SPARE_SLOTS
    shares = sources.where("goal > 0").withColumn("blocks", n_blocks(block_words))
    shares = shares.select(
        F.struct("source").alias("source"),  # a struct is never null: a null source joins like any other
        "blocks",
        F.sum("blocks").over(Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())).alias("upto"),
        F.lit(blocks).alias("all"),
    )
    edges = shares.select(
        "source",
        "blocks",
        ((F.col("upto") - F.col("blocks")) / F.col("all") * MODULUS).cast("bigint").alias("lo"),
        F.when(F.col("upto") == F.col("all"), F.lit(MODULUS)).otherwise((F.col("upto") / F.col("all") * MODULUS).cast("bigint")).alias("hi"),
    )
    width = -(-MODULUS // CELLS)
    cells = edges.where("lo < hi").withColumn("cell", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"(id % {MODULUS}) * {GOLDEN} % {MODULUS}").alias("point"))
    drawn = points.withColumn("cell", F.expr(f"point div {width}")).join(cells, "cell").where("point >= lo AND point < hi")
    drawn = drawn.select("slot", "source", "blocks", F.lit(1).alias("one"))
    drawn, before = _ranged(drawn, "one", F.expr(f"slot div {_range_rows(slots)}"))
    rank = F.row_number().over(Window.partitionBy("source", "range").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", rank).join(before, F.expr("source = s AND range = q"))
    ranked = ranked.withColumn("block", F.col("rank") + F.col("offset")).where("block < blocks")
    return ranked.select("slot", F.col("source.source").alias("source"), "block")


def n_blocks(block_words: int) -> Column:
    return F.expr(f"(goal + {block_words - 1}) div {block_words}")


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    percent: int = 150,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = (),
) -> Mix:
    """Mix all documents: sources weigh ``weights`` in turn by name (null last) and share ``percent`` of all words.

    A target stops at ``most`` times its source; the excess is shared again by weight.  taken of a document is the sum of its
    words in the blocks that have a slot of the schedule, repeats counted: at most ``most`` times its size, and over a source
    exactly its target rounded to whole words.  first_slot is the first slot that holds a word of it, null if none does.  Documents without words, or with a null text, take part with 0 words; a null source is a source.
    Rows are told apart by their place on the axis, so repeated rows and null ids stay rows of their own.  ``keep`` names columns
    to carry along; they come out under ``extra``, a struct, so that no name can clash.
    """
    kept = F.struct(*(F.col(c) for c in keep)) if keep else F.lit(None).cast("string")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.struct(F.col(source).alias("source")).alias("source"), n_words(text).alias("size"), kept.alias("extra")
    )
    rows = stage(rows, "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = source_targets(per_source.select("source.source", "source_size"), list(weights), percent, most)
    sources = stage(sources, "targets")
    total = rows.agg(F.count(F.lit(1))).first()
    ranges = max(1, -(-total[0] // _range_rows(total[0])))
    order = F.xxhash64(F.lit("mix"), "doc_id", "size")
    placed, before = _ranged(rows.withColumn("order", order), "size", F.pmod("order", F.lit(ranges)))
    # Ties of the hash are rows of one id and size; any order of them gives the same rows.
    so_far = Window.partitionBy("source", "range").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("begin", F.coalesce(F.sum("size").over(so_far), F.lit(0))).join(before, F.expr("source = s AND range = q"))
    goals = sources.select(F.struct("source").alias("s2"), "source_size", "target", "goal")
    placed = placed.join(goals, F.expr("source = s2")).withColumn("begin", F.col("begin") + F.col("offset"))
    placed = stage(placed.select("doc_id", "source", "size", "extra", "begin", "source_size", "target", "goal"), "axis")
    wanted = sources.agg(F.coalesce(F.sum(n_blocks(block_words)), F.lit(0))).first()[0]
    blocks = stage(schedule(sources, wanted, block_words), "schedule")
    if (scheduled := blocks.count()) != wanted:
        raise RuntimeError(f"{scheduled} of {wanted} blocks have a slot: more blocks than the sequence has points for, take larger ones")
    # Words of each document in each pass over the axis, cut at the goal, then by block.
    passes = placed.where("size > 0").select("source", "size", "begin", "goal", "source_size", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
    passes = passes.select(
        "source",
        "begin",
        F.expr("begin + pass * source_size").alias("lo"),
        F.expr("least(begin + pass * source_size + size, goal)").alias("hi"),
    ).where("lo < hi")
    cut = passes.withColumn("block", F.explode(F.expr(f"sequence(lo div {block_words}, (hi - 1) div {block_words})")))
    cut = cut.withColumn("words", F.expr(f"least(hi, (block + 1) * {block_words}) - greatest(lo, block * {block_words})"))
    in_mix = cut.join(blocks.select(F.struct("source").alias("source"), "block", "slot"), ["source", "block"])
    taken = in_mix.groupBy("source", "begin").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    # (source, begin) names one document that has words; the others took no part in the join.
    taken = taken.select("source", "begin", F.lit(True).alias("has_words"), "taken", "first_slot")
    out = placed.withColumn("has_words", F.col("size") > 0).join(taken, ["source", "begin", "has_words"], "left")
    out = out.select(
        "doc_id", F.col("source.source").alias("source"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot", "extra"
    )
    return Mix(sources, blocks, out)
