"""Connected components by distributed union-find, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import packed, sent, staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _smallest(table: DataFrame) -> DataFrame:
    return table.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of `edges` (a, b) but the roots: the smallest node of its component.

    Alternates two star operations until nothing changes: every node's larger
    neighbours, then its smaller ones, are hung below its smallest neighbour.  Both
    are a map-side combined minimum and a join, so a node with many neighbours
    passes through no single task; the minima of a small graph are sent to all tasks
    instead, which are as many as its edges need.  Each round is written to the
    shared folder.
    """
    flat = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(flat)
    while state[0]:
        rows = 2 * state[0]  # of a table below, at most
        low = lambda table: sent(packed(_smallest(table), rows), rows)
        both = flat.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
        large = both.join(low(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        large = packed(large, rows)
        hung = large.join(low(large), "u").select(F.explode(F.array(F.struct(F.col("u").alias("b"), F.col("m").alias("a")), F.struct(F.col("v").alias("b"), F.col("m").alias("a")))).alias("e")).select("e.a", "e.b")
        flat = staged(packed(hung.where("a <> b").distinct(), rows), "edges")
        before, state = state, _state(flat)
        if state == before:
            break
    return flat.select(F.col("b").alias("node"), F.col("a").alias("root"))


def extended(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The components of `roots`, as `components` gave them, with further edges (a, b)."""
    return components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(edges))
