"""Mixing sources to target weights by a splitting tree of block quotas; DataFrame functions only.

Documents are hashed into blocks within their source.  Each source's target is
filled by whole epochs of its blocks and a part of one more; the counts of
block draws are split among the output shards by a tree: each node's draws are
halved, and how many of each source go left follows the multivariate
hypergeometric distribution, drawn source by source.  A permutation of each
source's draws then deals disjoint runs of blocks to the shards, as long as the
quotas say, and rows are shuffled within their shard.

Null sources are a source, the last; null texts and texts without words have
size 0.  Every draw comes from hashes of the seed, so reruns agree.  Rows that
repeat are rows of their own, drawn alike, as they share a block.  An empty
table has an empty mix.  Texts of any length count whole.  Orders that tie are
settled by the block's number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free, materialize, n_words, whole

#: Blocks of a source at most; a source with fewer documents has about one block a document.
BLOCKS = 1024
#: Rows of the block table up to which it is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
MOST_COPIES = 3
#: Permutations of a source's blocks that are tried at most; the one that fills its target best counts.
ORDERS = 16


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) + 0.5) / float(1 << 53)


def targets(sizes: DataFrame, cycle: int = 3, most: float = MOST_COPIES) -> DataFrame:
    """``source, source_size`` with ``weight`` and ``target``.

    Weights are 1, 2, 3, repeating, over the sources by code point, null last;
    targets share all sizes by weight, but none is above ``most`` times its
    source's size.  With the sources in order of the share at which they meet
    their limit, the first that needs no limiting fixes the share of a unit of
    weight.  One row a source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", (F.pmod(F.row_number().over(by_name) - 1, F.lit(cycle)) + 1).cast("double"))
    w = w.withColumn("_cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    w = w.withColumn("_unit", (F.sum("source_size").over(everything) - before) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("_at", F.row_number().over(order))
    fits = F.when(F.col("_unit") <= F.col("_cap") / F.col("weight") * (1 + 1e-12), F.struct("_at", "_unit"))
    w = w.withColumn("_share", F.min(fits).over(everything)["_unit"])
    return w.select("source", "source_size", "weight", F.least(F.col("_cap"), F.col("_share") * F.col("weight")).alias("target"))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``total`` are among the ``good``: the quantile at ``u``.

    The distribution is summed by its recurrence over eight standard deviations
    around the mean; beyond lies less than double precision can tell.
    """
    n, m, k = total.cast("double"), good.cast("double"), draws.cast("double")
    mean = F.when(n > 0, k * m / n).otherwise(0.0)
    sd = F.when(n > 1, F.sqrt(mean * (1 - m / n) * (n - k) / (n - 1))).otherwise(0.0)
    low = F.greatest(F.lit(0), draws - (total - good), F.floor(mean - 8 * sd - 2).cast("long"))
    high = F.greatest(low, F.least(good, draws, F.ceil(mean + 8 * sd + 2).cast("long")))

    def ratio(x: Column) -> Column:
        return (m - x) * (k - x) / ((x + 1) * (n - m - k + x + 1))

    def walk(limit: Column) -> Column:
        # What the steps need stands in the accumulator: an expression inside a lambda is computed anew for each element.
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), low.cast("long").alias("x"), limit.cast("double").alias("limit"))

        def step(a: Column, x: Column) -> Column:
            done = a["sum"] + a["w"] >= a["limit"]
            return F.when(done, a).otherwise(F.struct((a["w"] * ratio(x)).alias("w"), (a["sum"] + a["w"]).alias("sum"), F.least(x + 1, high).cast("long").alias("x"), a["limit"].alias("limit")))

        return F.aggregate(F.sequence(low, high), zero, step)

    return walk(u * walk(F.lit(float("inf")))["sum"])["x"]


def split_quotas(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source, draws`` to ``source, ends``: the running ends of the shards' runs of draws.

    One row holds one entry a source and is split level by level; every shard
    gets the same number of draws, but for rounding, and every draw one shard.
    """
    # Fixed types keep the tree's rows alike on every level.
    entries = "array<struct<source:string,n:bigint>>"
    tree = counts.groupBy().agg(F.array_sort(F.collect_list(F.struct("source", F.col("draws").alias("n")))).cast(entries).alias("have"))
    tree = tree.select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "have")
    width = shards
    while width > 1:
        left_width = F.expr("(width + 1) div 2")
        total = F.aggregate("have", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        tree = tree.withColumn("_total", total).withColumn("_quota", F.expr("_total * ((width + 1) div 2) div width"))
        zero = F.struct(F.col("_total").alias("total"), F.col("_quota").alias("quota"), F.array().cast(entries).alias("out"))

        def step(a: Column, x: Column) -> Column:
            drawn = hypergeometric(a["total"], x["n"], a["quota"], uniform(F.lit(seed), F.col("first"), F.col("width"), x["source"]))
            return F.transform(F.array(drawn), lambda d: F.struct((a["total"] - x["n"]).alias("total"), (a["quota"] - d).alias("quota"), F.concat(a["out"], F.array(F.struct(x["source"].alias("source"), d.alias("n")))).cast(entries).alias("out")))[0]

        left = F.when(F.col("width") > 1, F.aggregate("have", zero, step)["out"]).otherwise(F.col("have"))
        tree = tree.withColumn("_left", left)
        rest = F.zip_with("have", "_left", lambda a, b: F.struct(a["source"].alias("source"), (a["n"] - b["n"]).alias("n")))
        both = F.when(
            F.col("width") > 1,
            F.array(
                F.struct(F.col("first"), left_width.cast("int").alias("width"), F.col("_left").alias("have")),
                F.struct((F.col("first") + left_width).cast("int").alias("first"), (F.col("width") - left_width).cast("int").alias("width"), rest.cast(entries).alias("have")),
            ),
        ).otherwise(F.array(F.struct("first", "width", F.col("have").alias("have"))))
        tree = tree.select(F.explode(both).alias("_n")).select("_n.*")
        width = (width + 1) // 2
    quotas = tree.select(F.col("first").alias("shard"), F.explode("have").alias("_q")).select("shard", F.col("_q.source").alias("source"), F.col("_q.n").alias("n"))
    runs = quotas.withColumn("end", F.sum("n").over(Window.partitionBy("source").orderBy("shard")))
    return runs.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends"))


def block_of(key: list[Column], seed: int, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(blocks)).cast("int")


def draws(sized: DataFrame, shards: int = 16, seed: int = 5) -> DataFrame:
    """The block table: ``source, block, source_size, target, shards`` (one entry a draw of the block), written once.

    ``sized`` has source, size and block.  Blocks are taken in a permuted order
    while they fit what is left of the target after whole epochs; one more may
    follow if that brings the source nearer its target.
    """
    blocks = materialize(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    goals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(MOST_COPIES), F.floor(F.col("target") / F.col("source_size") + 1e-9))).otherwise(1).cast("int")
    goals = goals.withColumn("epochs", epochs).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
    listed = blocks.groupBy("source").agg(F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed), F.lit("order"), "source", "block").alias("h"), "block", "words"))).alias("all"))
    rows = listed.alias("l").join(goals.alias("g"), F.expr("l.source <=> g.source")).select("g.*", "l.all")

    # Many blocks fill a target closely in any order; few are worth more tries for the same work.
    tries = F.greatest(F.lit(1), F.least(F.lit(ORDERS), F.expr(f"cast({BLOCKS} div greatest(size(all), 1) as int)")))

    def filled(order: Column) -> Column:
        """What a permuted order of the blocks leaves of the target, and the blocks it takes."""
        by = F.sort_array(F.transform("all", lambda x: F.struct(F.xxhash64(order, x["h"]).alias("h"), x["block"].alias("block"), x["words"].alias("words"))))
        zero = F.struct(F.col("left").cast("double").alias("left"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(by, zero, lambda a, x: F.when(x["words"] <= a["left"] + 1e-6, F.struct((a["left"] - x["words"]).cast("double").alias("left"), F.concat(a["out"], F.array(x["block"])).alias("out"))).otherwise(a))

    rows = rows.withColumn("_taken", F.array_min(F.transform(F.sequence(F.lit(1), tries), filled)))
    over = F.filter("all", lambda x: (x["words"] < 2 * F.col("_taken.left")) & ~F.array_contains("_taken.out", x["block"]))
    nearest = F.array_min(F.transform(over, lambda x: F.struct(F.abs(x["words"] - F.col("_taken.left")).alias("far"), x["block"].alias("block"))))["block"]
    rows = rows.withColumn("_one", nearest).withColumn("_more", F.concat("_taken.out", F.when(F.col("_one").isNull(), F.array().cast("array<int>")).otherwise(F.array("_one"))))
    rows = rows.withColumn("_more", F.when(F.col("epochs") < MOST_COPIES, F.col("_more")).otherwise(F.array().cast("array<int>")))
    each = rows.select("source", "source_size", "target", "epochs", "_more", F.explode("all").alias("_b")).withColumn("block", F.col("_b.block"))
    each = each.withColumn("copies", F.col("epochs") + F.array_contains("_more", F.col("block")).cast("int")).drop("_b", "_more", "epochs")
    each = materialize(each, "copies")
    drawn = each.where("copies > 0").select("source", "block", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    drawn = drawn.withColumn("_at", F.row_number().over(Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("draw"), "block", "copy"), "block", "copy")))
    ends = split_quotas(each.groupBy("source").agg(F.sum("copies").cast("long").alias("draws")), shards, seed)
    dealt = drawn.alias("d").join(ends.alias("e"), F.expr("d.source <=> e.source")).select("d.source", "d.block", "d.copy", F.size(F.filter("e.ends", lambda e: e < F.col("d._at"))).alias("shard"))
    dealt = dealt.groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards"))
    out = each.alias("e").join(dealt.alias("s"), F.expr("e.source <=> s.source AND e.block = s.block"), "left")
    return materialize(out.select("e.source", "e.block", "e.source_size", "e.target", F.coalesce("s.shards", F.array().cast("array<int>")).alias("shards")), "draws")


def plan(docs: DataFrame, key: list[str], source: str = "source", text: str = "text", shards: int = 16, seed: int = 5) -> DataFrame:
    """``row`` (the row of ``docs``) with ``size, source_size, target`` and ``shards``, one entry a copy that the mix takes.

    The block table has a bounded number of rows a source; it is broadcast when
    counted small, and rows then stay where they are.
    """
    sized = docs.select(whole(docs).alias("row"), docs[source].alias("s"), n_words(docs[text]).alias("size"), block_of([docs[k] for k in key], seed).alias("b"))
    table = draws(sized.select(F.col("s").alias("source"), "size", F.col("b").alias("block")), shards, seed)
    small = F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
    return sized.join(small, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block"))).select("row", "size", "source_size", "target", "shards")


def mix(docs: DataFrame, key: list[str], source: str = "source", text: str = "text", shards: int = 16, seed: int = 5, keep_shard: bool = False) -> DataFrame:
    """The rows the mix takes, a row a copy, with the columns of ``docs``, whatever their names.

    They come shard by shard, shuffled within each: written, every file is a
    run of that order.  ``keep_shard`` adds it as ``mix_shard`` and
    ``mix_order`` (with an underscore behind, where ``docs`` has such columns).
    """
    rows = plan(docs, key, source, text, shards, seed).select("row", F.posexplode("shards").alias("copy", "shard"))
    rows = rows.withColumn("at", F.xxhash64(F.lit(seed), *[F.col("row").getField(k) for k in key], F.col("copy")))
    rows = rows.repartitionByRange("shard", "at").sortWithinPartitions("shard", "at")
    return rows.select("row.*", *([F.col("shard").alias(free("mix_shard", docs.columns)), F.col("at").alias(free("mix_order", docs.columns))] if keep_shard else []))
