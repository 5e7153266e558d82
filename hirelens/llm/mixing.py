"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's words are laid out in a seeded permuted order and drawn from the front, as
often as its target asks. What is drawn is cut into blocks of about equal words. The tree
starts with the exact number of blocks of each source and halves the output shards again
and again; each half gets a multivariate-hypergeometric draw of its parent's blocks. A
shard then holds so many disjoint blocks of each source's permuted blocks and is shuffled
on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import keep, ranked, slices_for

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SHARDS = 16
BLOCK_WORDS = 65_536
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
MOST_BLOCKS = 400_000_000  # numpy draws exactly from pools of less than 1e9


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab and line ends; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A source name that can be joined on: null becomes a name of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """Targets of sources (`source`, `source_size`), one row each.

    Sources in code point order, null last, get the weights in turn and share the sum of
    all sizes; a target stops at `most` times its source's size, and what is cut off is
    shared again by weight until no target is above. In order of the weight's level at
    which a source is full, the sources that end full are a prefix, so running sums give
    the final level; no iteration is needed. Adds `target` and the whole `quota`.
    """
    everything = Window.partitionBy(F.lit(0))
    table = F.array(*[F.lit(w).cast("double") for w in weights])
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weighed = (
        sizes.withColumn("weight", F.element_at(table, (place - 1) % len(weights) + 1))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    fills = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = fills.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    rest = F.sum("weight").over(fills.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("level", left / rest).withColumn(
        "full", F.col("cap") <= F.col("level") * F.col("weight")
    )
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level")))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.least(F.col("final.level") * F.col("weight"), F.col("cap").cast("double"))
    )
    return levels.withColumn("final", level.over(everything)).select(
        "source", "source_size", target.alias("target"),
        F.least(F.round(target).cast("bigint"), F.col("cap")).alias("quota"),
    )


def _halves(counts: list[int], take: int, draw: np.random.Generator) -> list[int]:
    """How many of `take` blocks drawn from the pool come from each source: one
    hypergeometric draw per source, given the draws before."""
    got, rest = [], sum(counts)
    for count in counts:
        rest -= count
        if rest < 1 or take < 1 or count < 1:
            x = min(take, count)
        else:
            x = int(draw.hypergeometric(count, rest, take))
        got.append(x)
        take -= x
    return got


def splitting_tree(counts: Sequence[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Block quotas of each shard: rows are shards, columns sources.

    A node with s shards gives its first s // 2 shards their share of its blocks, so shards
    end at most a block per level apart, and each source's column adds up to its count.
    """

    def split(node: list[int], size: int, path: int) -> list[list[int]]:
        if size == 1:
            return [node]
        left, pool = size // 2, sum(node)
        draw = np.random.default_rng([seed, path])
        first = _halves(node, pool * left // size, draw)
        second = [n - x for n, x in zip(node, first)]
        return split(first, left, 2 * path) + split(second, size - left, 2 * path + 1)

    return split(list(counts), shards, 1)


def mix(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Draw a mix from rows (`row` unique, `source`, `size` words >= 0, `content` any
    number made from the row's content).

    Returns the draws and the sources with their targets. A draw is (`row`, `copy` from 0,
    `words`, `shard`, `slot` gapless from 0 in its shard, `block`). Each source's words add
    up to its quota exactly: whole passes over the source and the front of one more, at
    whose end one row is taken in part (its first `words` words). No row is drawn more than
    `most` times. Rows of size 0 are not drawn. The order depends on seed, content and size
    only, so reruns agree; rows equal in all of these are alike. A null source is a source
    of its own. Empty input gives no draws. Blocks have `block_words` words, or as many more
    that there are at most MOST_BLOCKS of them: every split is an exact draw at any size.

    A source may hold any share of the rows: its order is cut into hashed slices. Only one
    row per source goes to the driver, for the tree; that is sources x shards numbers.
    """
    rows = rows.withColumn("key", source_key(F.col("source"))).withColumn(
        "mixed", F.xxhash64(F.lit(seed), "content", "size")
    )
    totals = rows.groupBy("key", "source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    targets = keep(
        source_targets(totals.select("source", "source_size"), weights, most)
        .withColumn("key", source_key(F.col("source"))),
        "mix-targets",
    )
    known = targets.select("key", "quota").orderBy("key").collect()
    block_words = max(block_words, -(-sum(r["quota"] for r in known) // MOST_BLOCKS))
    blocks = [-(-r["quota"] // block_words) for r in known]
    tree = splitting_tree(blocks, shards, seed)
    ends, plan = [0] * len(known), [[] for _ in known]
    for shard in tree:
        for i, n in enumerate(shard):
            ends[i] += n
            plan[i].append(ends[i])
    spark = rows.sparkSession
    quotas = spark.createDataFrame(
        [(r["key"], p) for r, p in zip(known, plan)], "key string, ends array<bigint>"
    )
    count = rows.count()
    slices = slices_for(count)
    placed = ranked(
        rows.select("row", "key", "size", "mixed", "content"),
        ["key"], ["mixed", "content", "row"], slices, "place", "size", "before",
        mixed_by=F.col("mixed"),
    )
    sized = placed.filter("size > 0").join(
        targets.select("key", "source_size", "quota"), "key"
    )
    passes = F.floor(F.col("quota") / F.col("source_size"))
    drawn = (
        sized.withColumn("copy", F.explode(F.sequence(F.lit(0), passes)))
        .withColumn("start", F.col("copy") * F.col("source_size") + F.col("before"))
        .withColumn("words", F.least(F.col("size"), F.col("quota") - F.col("start")))
        .filter("words > 0")
        .withColumn("block", F.floor(F.col("start") / block_words))
        .select("row", "key", F.col("copy").cast("int").alias("copy"), "words", "block",
                "mixed", "content")
    )
    drawn = keep(drawn, "mix-drawn")
    # blocks that hold the start of a draw, in permuted order; a block without one is empty
    permuted = ranked(
        targets.withColumn("n", F.ceil(F.col("quota") / block_words))
        .filter("n > 0")
        .select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))
                .alias("block")),
        ["key"], [F.xxhash64(F.lit(seed), "key", "block"), F.col("block")],
        slices, "at",
    ).join(quotas, "key")
    homes = permuted.select(
        "key", "block", F.size(F.filter("ends", lambda e: e <= F.col("at"))).alias("shard")
    )
    shuffled = ranked(
        drawn.join(homes, ["key", "block"]), ["shard"],
        [F.xxhash64(F.lit(seed + 1), "mixed", "copy"), F.col("content"), F.col("row"),
         F.col("copy")],
        slices, "slot",
    )
    return shuffled.select("row", "copy", "words", "block", "shard", "slot"), targets


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of so many words, with what stands before each word."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words), "")
