"""Looking at plans and partitions."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What `explain` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def partitions_used(df: DataFrame, upper: int) -> DataFrame:
    """How many partitions hold rows, at most `upper`."""
    return partition_sizes(df).agg(F.least(F.count(F.lit(1)).cast("int"), F.lit(upper)).alias("partitions"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share before heavy work on each row.

    A small table may come as one split; it is redistributed by key.  A table
    with more splits than cores is left alone, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
