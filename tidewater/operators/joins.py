"""Joins Spark has no keyword for: as-of, point in time, overlap, null-aware, weighted bridges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import HOT_ROWS, ordered, running
from tidewater.operators.ranking import latest
from tidewater.operators.skew import pairs_within
from tidewater.session import by_rows, cut_lineage


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: Column,
    right_at: Column,
    right_tiebreak: str,
    take: Sequence[str],
    tolerance: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every left row with the latest right row of its key at or before it, or nulls.

    Both sides are laid out on one time line per key; the latest right row so
    far is a running maximum.  One shuffle, and busy keys are cut into slices.
    """
    payload = F.struct(right_at.alias("at"), F.col(right_tiebreak).alias("tie"), *[F.col(c) for c in take])
    r = right.select(*keys, right_at.alias("__at"), F.lit(0).alias("__side"), payload.alias("__right"))
    l = left.select(*keys, left_at.alias("__at"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"))
    line = l.unionByName(r, allowMissingColumns=True)
    o = ordered(line, keys, ["__at", "__side"], hot_rows=hot_rows)
    joined = running(o, {"__last": ("max", F.col("__right"))}).result().where("__side = 1")
    last = F.col("__last")
    if tolerance is not None:
        last = F.when(F.col("__at") - F.col("__last.at") <= tolerance, last)
    return joined.select(*[F.col("__left")[c].alias(c) for c in left.columns], *[last[c].alias(c) for c in take])


def any_join(left: DataFrame, right: DataFrame, key: str, by: Sequence[str], how: str = "inner") -> DataFrame:
    """At most one partner per left row: the right row that sorts first by `by`."""
    return left.join(latest(right, [key], by, newest=False), key, how)


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """`column NOT IN (list)` with SQL null rules, as an anti join instead of a broadcast list.

    A null in the list lets no row pass; an empty list lets every row pass.
    """
    facts = listed.agg(F.count_if(F.col(listed_column).isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))
    values = listed.select(F.col(listed_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    nulls, n = facts.select("nulls").scalar(), facts.select("n").scalar()
    return df.join(values, column, "left_anti").where((nulls == 0) & (F.col(column).isNotNull() | (n == 0)))


def overlapping(df: DataFrame, keys: Sequence[str], item: str, start: str, end: str) -> DataFrame:
    """Pairs of intervals of a key that share at least one day: columns keys, a, b with a < b.

    Of two overlapping intervals the later one starts inside the earlier one.  So
    each interval is laid over cells of about the mean length, and meets only the
    starts that fall into its cells: copies stay below two per interval, and pairs
    that do not overlap are compared only near the borders of a cell.  An interval
    without an end is open: it reaches as far as the last start.
    """
    days = df.select(*keys, F.col(item).alias("__id"), F.unix_date(start).alias("__s"), F.unix_date(end).alias("__e"))
    last = days.agg(F.max("__s").alias("m")).first()["m"]
    days = days.withColumn("__e", F.coalesce("__e", F.greatest(F.col("__s"), F.lit(last))))
    days = days.where("__s <= __e")
    mean = days.agg(F.avg(F.col("__e") - F.col("__s") + 1).alias("m")).first()["m"]
    width = max(1, int(-(-(mean or 1) // 1)))
    cells = F.sequence(F.floor(F.col("__s") / width), F.floor(F.col("__e") / width))
    early = days.withColumn("__cell", F.explode(cells))
    late = days.select(*keys, F.col("__id").alias("__id2"), F.col("__s").alias("__s2"), F.floor(F.col("__s") / width).alias("__cell"))
    inside = (F.col("__s2") >= F.col("__s")) & (F.col("__s2") <= F.col("__e"))
    after = (F.col("__s2") > F.col("__s")) | (F.col("__id2") > F.col("__id"))
    met = early.join(late, [*keys, "__cell"]).where(inside & after & (F.col("__id") != F.col("__id2")))
    return met.select(*keys, F.least("__id", "__id2").alias("a"), F.greatest("__id", "__id2").alias("b"))


def basket_pairs(df: DataFrame, basket: str, item: str, top: int = 10, seed_items: int = 200) -> DataFrame:
    """The pairs of items most often found in the same basket.

    A pair is never more frequent than its rarer item.  The pairs among the most
    frequent items give a bound that the answer must reach; items below it are
    dropped before the full pairing, which cannot change the result.
    """
    spark = df.sparkSession
    named = df.select(F.col(basket).alias("__basket"), F.col(item).alias("__item")).where("__basket IS NOT NULL AND __item IS NOT NULL")
    # lines hardly repeat within a task: they meet by both columns first, so that no task holds more than its part
    spread = named.repartition(by_rows(spark, named.count()), "__basket", "__item")
    lines = cut_lineage(spread.distinct())  # read three times below
    support = lines.groupBy("__item").agg(F.count(F.lit(1)).alias("__n"))
    frequent = support.orderBy(F.desc("__n"), "__item").limit(seed_items).select("__item")
    few = lines.join(F.broadcast(frequent), "__item", "left_semi")  # at most seed_items rows per basket
    seeds = few.withColumnRenamed("__item", "a").join(few.withColumnRenamed("__item", "b"), "__basket").where("a < b")
    best = seeds.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(top).collect()
    bound = best[-1]["n"] if len(best) == top else 1
    if bound > 1 and not support.where(F.col("__n") < bound).isEmpty():
        lines = lines.join(support.where(F.col("__n") >= bound).select("__item"), "__item", "left_semi")
    n = F.col("__n").cast("double")
    made = lines.groupBy("__basket").agg(F.count(F.lit(1)).alias("__n")).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))).first()[0]
    pairs = pairs_within(lines, ["__basket"], "__item").repartition(by_rows(spark, int(made)), "a", "b")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("pair_count"))
    return counts.orderBy(F.desc("pair_count"), "a", "b").limit(top)


def in_validity(fact: DataFrame, dim: DataFrame, key: str, at: str, valid_from: str, valid_to: str) -> DataFrame:
    """Fact rows with the dimension version valid on their date (from inclusive, to exclusive)."""
    return fact.join(dim, key).where((F.col(at) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to))))


def drill_across(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Two facts, each already summed to the shared grain, side by side."""
    return left.join(right, list(on), "full")
