"""Connected components by alternating large-star and small-star contraction.

Null ends are no links; repeated links count once; loops and an empty table
have no rows.  Other columns of ``links`` are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: A key with more than this share of all rows is hot; twice as many keys can be at most.
SHARE = 512


def join_back(rows: DataFrame, sums: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``sums``, an aggregate over their keys with the number of rows ``_c``, and without it.

    An aggregate's side of a join can't be split, so a hot key's rows would
    meet in one task.  Keys of more than a ``SHARE``-th of the ``total`` rows
    number ``SHARE`` at most: their sums are broadcast, and their rows stay
    where they are.
    """
    most = max(total // SHARE, 1)
    hot = F.broadcast(sums.where(F.col("_c") > most))
    cold = rows.join(hot.select(*on), on, "left_anti").join(sums.where(F.col("_c") <= most), on)
    return rows.join(hot, on).unionByName(cold).drop("_c")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (x, y: longs) that isn't itself the least of its component, the root.

    Each round hangs a node's larger neighbours, then its smaller ones, on the
    least of them; rounds grow with the logarithm of the longest path.  A
    node's neighbours are never gathered: minima are pre-aggregated and joined
    back, a hot node's by broadcast.
    """
    edges = materialize(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v AND x IS NOT NULL AND y IS NOT NULL").distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("_c"))
        large = join_back(both.where("v > u"), least, ["u"], 2 * now[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_c"))
        small = join_back(large, least, ["u"], now[0]).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
