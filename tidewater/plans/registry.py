"""Named queries: each binds library operators to the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with the SQL that must agree with it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
