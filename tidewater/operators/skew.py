"""Joins and pairings that spread busy keys over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ordered import HOT_ROWS, hot_keys

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20  # of the rows written as JSON


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most `max_rows` rows of at most BROADCAST_BYTES together; reads no more rows than that to find out."""
    sizes = df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("size"))
    facts = sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    return facts["n"] <= max_rows and facts["size"] <= BROADCAST_BYTES


def lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a lookup table: broadcast when its checked size allows it, shuffled otherwise."""
    return big.join(F.broadcast(small) if is_small(small, max_rows) else small, on, how)


def bounded_cross(df: DataFrame, small: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Every row with every row of a checked small table, as an expansion of each row."""
    rows = small.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df.crossJoin(small)
    schema = T.ArrayType(small.schema)
    held = df.sparkSession.createDataFrame([(rows,)], T.StructType([T.StructField("__all", schema)]))
    literal = held.scalar()
    return df.select("*", F.inline(literal))


def _block_counts(keys: Sequence[str], hot: DataFrame, hot_rows: int, most: int | None = None) -> DataFrame:
    """Hot key -> number of blocks."""
    blocks = F.ceil(F.col("__n") / hot_rows).cast("int")
    return hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], (F.least(blocks, F.lit(most)) if most else blocks).alias("__blocks"))


def _with_blocks(df: DataFrame, keys: Sequence[str], counts: DataFrame) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (df[k] == counts[f"__h_{k}"])
    joined = df.join(F.broadcast(counts) if is_small(counts) else counts, cond, "left").drop(*[f"__h_{k}" for k in keys])
    return joined.withColumn("__blocks", F.coalesce("__blocks", F.lit(1)))


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], row_key: Column, how: str = "inner", hot_rows: int = HOT_ROWS, salts: int | None = None
) -> DataFrame:
    """Join that splits the hot keys of `big` by a hash of its row key.

    Only rows of hot keys get more than one salt, and only their partners are
    repeated; the hash of a row key gives a retried task the same salt.  Joins that
    keep unmatched rows of `small` are refused: its rows are repeated.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    hot = hot_keys(big, on, hot_rows)
    if hot is None:
        return big.join(small, list(on), how)
    counts = _block_counts(on, hot, hot_rows, salts)
    left = _with_blocks(big, on, counts).withColumn("__salt", F.pmod(F.xxhash64(row_key), F.col("__blocks")).cast("int"))
    right = _with_blocks(small, on, counts).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return left.drop("__blocks").join(right.drop("__blocks"), [*on, "__salt"], how).drop("__salt")


def split_hot_join(big: DataFrame, small: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join in two parts: hot keys against a broadcast of their few partners, the rest shuffled."""
    hot = hot_keys(big, [key], hot_rows)
    if hot is None:
        return big.join(small, key)
    picked = hot.select(key).where(F.col(key).isNotNull())
    picked = F.broadcast(picked) if is_small(picked) else picked
    partners = small.join(picked, key, "left_semi")
    busy = big.join(picked, key, "left_semi")
    rest = big.join(picked, key, "left_anti")
    heavy = busy.join(F.broadcast(partners), key) if is_small(partners, max_rows) else salted_join(busy, partners, [key], F.struct(*busy.columns), hot_rows=hot_rows)
    return heavy.unionByName(rest.join(small, key))


def pairs_within(df: DataFrame, keys: Sequence[str], item: str, hot_rows: int = 20_000, blocks: int = 1000) -> DataFrame:
    """All pairs a < b of `item` that share a key: columns keys, a, b.

    A key with many items is cut into blocks by hash, and every pair of blocks
    is its own join cell, so the pairs of one key are made by many tasks.
    """
    named = df.select(*keys, item).where(F.col(item).isNotNull())
    for k in keys:
        named = named.where(F.col(k).isNotNull())
    hot = hot_keys(named, keys, hot_rows)
    left = named.withColumnRenamed(item, "a")
    right = named.withColumnRenamed(item, "b")
    if hot is None:
        return left.join(right, list(keys)).where("a < b")
    counts = _block_counts(keys, hot, hot_rows, blocks)
    all_blocks = F.sequence(F.lit(0), F.col("__blocks") - 1)
    left = _with_blocks(left, keys, counts)
    left = left.withColumn("__x", F.pmod(F.xxhash64("a"), F.col("__blocks")).cast("int")).withColumn("__y", F.explode(all_blocks))
    right = _with_blocks(right, keys, counts)
    right = right.withColumn("__y", F.pmod(F.xxhash64("b"), F.col("__blocks")).cast("int")).withColumn("__x", F.explode(all_blocks))
    met = left.drop("__blocks").join(right.drop("__blocks"), [*keys, "__x", "__y"]).where("a < b")
    return met.drop("__x", "__y")


def skew_report(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The most frequent keys with their share of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.orderBy(F.desc("n"), key).limit(n).select(key, "n", (F.col("n") / total).alias("share"))
