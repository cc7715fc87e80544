"""Approximate and mergeable aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, e

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_by_bitmap(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Exact distinct count of whole numbers per key, as bitmaps of 32768 values each."""
    parts = df.groupBy(*keys, F.bitmap_bucket_number(item).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(item)).alias("__bits")
    )
    return parts.groupBy(*keys).agg(F.sum(F.bitmap_count("__bits")).alias("distinct_items"))


def daily_states(df: DataFrame, keys: Sequence[Column], value: str, user: str) -> DataFrame:
    """Pre-aggregated states that later merge into any coarser grain."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.hll_sketch_agg(user, F.lit(14)).alias("users"),
    )


def merge_states(states: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.round(F.sum("total"), 2).alias("total"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users"),
    )


def approx_top(df: DataFrame, item: str, k: int, tracked: int = 10_000) -> DataFrame:
    """The k most frequent items from a sketch; exact while there are fewer than `tracked` items."""
    one = df.agg(F.expr(f"approx_top_k({item}, {k}, {tracked})").alias("top"))
    return one.select(F.inline("top"))


def approx_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Greenwald-Khanna quantiles; the rank error is at most 1/accuracy of the group."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(value, p, accuracy).alias(n) for n, p in probs.items()])


def paged_arrays(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, page: int = 1000, hot_rows: int | None = None) -> DataFrame:
    """Ordered values per key as arrays of at most `page` elements, so that no row grows without bound."""
    from tidewater.operators.ordered import HOT_ROWS, ordered, running

    o = ordered(df, keys, order, hot_rows=hot_rows or HOT_ROWS)
    numbered = running(o, {"__rn": ("count", F.lit(1))}).result()
    paged = numbered.withColumn("page", F.floor((F.col("__rn") - 1) / page))
    listed = F.array_sort(F.collect_list(F.struct(F.col("__rn").alias("rn"), F.col(value).alias("v"))))
    return paged.groupBy(*keys, "page").agg(F.transform(listed, lambda s: s["v"]).alias("items"))


def _cells(item: str, depth: int, width: int) -> Column:
    """The cell of an item in each of `depth` rows."""
    return F.array(*[F.struct(F.lit(d).alias("row"), F.pmod(F.xxhash64(F.col(item), F.lit(d)), F.lit(width)).cast("int").alias("cell")) for d in range(depth)])


def count_min_states(df: DataFrame, keys: Sequence[Column], item: str, epsilon: float = 0.001, depth: int = 5, tracked: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Count-Min states of `item` per key, as rows, and the frequent items that each state has seen.

    The first table is `keys, row, cell, n` with at most depth * e / epsilon rows a
    key, whatever the number of items: counts are added up before the shuffle, so a
    busy item is one row a task.  The second holds a mergeable top list of `tracked`
    items per key, the heap that goes with the sketch.  A null item is not counted.
    """
    width = ceil(e / epsilon)
    named = df.where(F.col(item).isNotNull())
    # an item's occurrences first meet in their task, then each makes `depth` rows
    counted = named.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("__n"))
    names = [c for c in counted.columns if c not in (item, "__n")]
    cells = counted.select(*names, "__n", F.explode(_cells(item, depth, width)).alias("c")).groupBy(*names, "c.row", "c.cell").agg(F.sum("__n").alias("n"))
    heap = named.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate({item}, {tracked})").alias("top"))
    return cells, heap


def merge_count_min(cells: DataFrame, heap: DataFrame, keys: Sequence[Column], tracked: int = 1000) -> tuple[DataFrame, DataFrame]:
    """States of a coarser key: cells add up, top lists combine."""
    return cells.groupBy(*keys, "row", "cell").agg(F.sum("n").alias("n")), heap.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(top, {tracked})").alias("top"))


def count_min_estimates(cells: DataFrame, items: DataFrame, keys: Sequence[str], item: str, epsilon: float = 0.001, depth: int = 5) -> DataFrame:
    """`keys, item, estimate` for the (keys, item) rows asked: never below the count, above by more than epsilon * N with chance e^-depth at most."""
    width = ceil(e / epsilon)
    asked = items.select(*keys, item, F.explode(_cells(item, depth, width)).alias("c")).select(*keys, item, "c.row", "c.cell")
    # an empty cell is a count of nothing
    met = asked.join(cells, [*keys, "row", "cell"], "left")
    return met.groupBy(*keys, item).agg(F.coalesce(F.min(F.coalesce("n", F.lit(0))), F.lit(0)).alias("estimate"))


def heavy_hitters(cells: DataFrame, heap: DataFrame, keys: Sequence[str], item: str, share: float, epsilon: float = 0.001, depth: int = 5, tracked: int = 1000) -> DataFrame:
    """`keys, item, estimate, total`: items of the top lists whose estimate reaches the share of the key's total.

    Complete while a key's items fit its list or the share is above 1 / tracked.
    """
    listed = heap.select(*keys, F.explode(F.expr(f"approx_top_k_estimate(top, {tracked})")).alias("t")).select(*keys, F.col("t.item").alias(item))
    found = count_min_estimates(cells, listed, keys, item, epsilon, depth)
    totals = cells.where("row = 0").groupBy(*keys).agg(F.sum("n").alias("total"))
    return found.join(totals, list(keys)).where(F.col("estimate") >= F.lit(share) * F.col("total"))


def quantile_states(df: DataFrame, keys: Sequence[Column], value: str, size: int = 400) -> DataFrame:
    """KLL states of a number per key: `keys, n, state`; the rank error of one falls with 1 / size (below 1 % at 400)."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("state"))


def merge_quantiles(states: DataFrame, keys: Sequence[Column], probs: dict[str, float], size: int = 400) -> DataFrame:
    """Quantiles of a coarser key from the states below it; states of nothing are left out."""
    merged = states.where("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("state", F.lit(size)).alias("state"))
    return merged.withColumns({name: F.kll_sketch_get_quantile_double("state", F.lit(p)) for name, p in probs.items()}).drop("state")


def set_states(df: DataFrame, keys: Sequence[Column], item: str, lg_size: int = 14) -> DataFrame:
    """Theta states of the distinct items per key: `keys, items`."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(item, lg_size).alias("items"))


def set_changes(states: DataFrame, at: str, step: Column) -> DataFrame:
    """`at, size, kept, gained, lost`: estimates for each set against the one a step before, from the states alone.

    `step` is the place of the next state, given one; a first set has no set before
    it and a last one is not followed, so these measures are null there.
    """
    before = states.select(step.alias(at), F.col("items").alias("__before"))
    met = states.join(before, at, "left")
    size = F.theta_sketch_estimate
    return met.select(
        at, size("items").alias("size"), size(F.theta_intersection("items", "__before")).alias("kept"),
        size(F.theta_difference("items", "__before")).alias("gained"), size(F.theta_difference("__before", "items")).alias("lost"))
