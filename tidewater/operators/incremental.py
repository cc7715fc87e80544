"""Incremental, idempotent and configured loads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import missing_ranges
from tidewater.operators.quality import row_hash


@dataclass(frozen=True)
class Feed:
    """How a table is loaded: whole, or what is newer than a mark in the column `since`, in the order of that column and the keys."""

    table: str
    keys: tuple[str, ...]
    since: str | None = None


def newer_than(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    """Rows strictly after the last watermark."""
    return df.where(F.col(column) > watermark)


def next_watermark(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    """The watermark to store after the load: the newest value, or the old one when nothing came."""
    return df.where(F.col(column) > watermark).agg(F.coalesce(F.max(column), watermark).alias("watermark"), F.count(F.lit(1)).alias("loaded"))


def ingest(df: DataFrame, feed: Feed, mark: Column | None = None) -> DataFrame:
    """The rows of a feed that are due; without a mark, all of them."""
    if feed.since is None:
        return df
    due = df if mark is None else newer_than(df, feed.since, mark)
    order = [feed.since, *feed.keys]
    return due.repartitionByRange(*order).sortWithinPartitions(*order)


def unseen(batch: DataFrame, columns: Sequence[str], processed: DataFrame, hash_column: str = "record_hash") -> DataFrame:
    """Records whose hash was not processed before, each once."""
    hashed = batch.select(*columns).withColumn(hash_column, row_hash(columns))
    once = hashed.groupBy(hash_column).agg(*[F.min(c).alias(c) for c in columns])
    return once.join(processed.select(hash_column), hash_column, "left_anti").select(*columns, hash_column)


def apply_increment(existing: DataFrame, batch: DataFrame, strategy: str, keys: Sequence[str], partition: str | None = None) -> DataFrame:
    """The table after a load: append, merge by key, or delete+insert by partition."""
    if strategy == "append":
        return existing.unionByName(batch)
    by = list(keys) if strategy == "merge" else [partition]
    if strategy not in ("merge", "delete+insert"):
        raise ValueError(f"unknown strategy {strategy}")
    return existing.join(batch.select(*by).distinct(), by, "left_anti").unionByName(batch)


def backfill_ranges(df: DataFrame, date: str, done: DataFrame, done_date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Unbroken ranges of days between the first and last day of a key of `df` (or of all of it) that are not in the run log."""
    return missing_ranges(df, date, done, done_date, keys)
