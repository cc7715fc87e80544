"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
    return edges.select(ends.alias("e")).select("e.node", "e.other")


def _lowest(sides: DataFrame) -> DataFrame:
    return sides.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))


def _large_star(stars: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours below its smallest one."""
    sides = _both_ways(stars)
    moved = sides.join(_lowest(sides), "node").where("other > node")
    return moved.select(F.col("low").alias("a"), F.col("other").alias("b")).where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours below the smallest of them."""
    sides = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    low = _lowest(sides)
    moved = sides.join(low, "node").select(F.col("low").alias("a"), F.col("other").alias("b"))
    own = low.select(F.col("low").alias("a"), F.col("node").alias("b"))
    return moved.unionByName(own).where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node, root`: the smallest node that links (columns a, b) lead to, for every node but the roots.

    Each round hangs every node's larger neighbours below its smallest one, then the
    rest of what it still points to; the forest is flat when a round changes
    nothing, after about log2 of the longest path.  Smallest neighbours are a
    map-side combined minimum, and every round is checkpointed.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    stars = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    now, before = state(stars), None
    while now != before and now[0]:
        stars = cut_lineage(_small_star(_large_star(stars)))
        before, now = now, state(stars)
    return stars.select(F.col("b").alias("node"), F.col("a").alias("root"))
