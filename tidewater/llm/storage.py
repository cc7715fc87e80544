"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

ROWS_TO_SEND = 200_000  # narrow rows of a table that every task may hold
ROWS_A_TASK, LEAST_TASKS = 20_000, 4

_local = threading.local()  # `scopes`: the paths staged in each open `settled`


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df`, written once and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if scopes := getattr(_local, "scopes", None):
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(df: DataFrame, rows: int) -> DataFrame:
    """`df`, to be sent to all tasks when its `rows`, which were counted or bounded before, are few."""
    return F.broadcast(df) if rows <= ROWS_TO_SEND else df


def packed(df: DataFrame, rows: int) -> DataFrame:
    """`df` of at most `rows` narrow rows in no more tasks than these need, however many a shuffle deals to."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // ROWS_A_TASK)))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `make` returns, staged; the tables that were staged on the way there are deleted, since nothing reads them again."""
    scopes = _local.scopes = getattr(_local, "scopes", None) or []
    scopes.append([])
    try:
        out = staged(make(), label)
    finally:
        paths = scopes.pop()
    for path in paths[:-1]:
        _delete(out.sparkSession, path)
    if scopes:
        scopes[-1].append(paths[-1])
    return out
