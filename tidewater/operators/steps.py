"""Transformations chosen by configuration: named DataFrame -> DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS: dict[str, Callable[..., DataFrame]] = {}


def step(name: str):
    def register(fn):
        STEPS[name] = fn
        return fn

    return register


@step("filter_min_amount")
def filter_min_amount(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.where(F.col(column) >= value)


@step("add_tier")
def add_tier(df: DataFrame, column: str, high: float) -> DataFrame:
    return df.withColumn("tier", F.when(F.col(column) >= high, "HIGH").otherwise("LOW"))


@step("uppercase")
def uppercase(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(column))


@step("high_value_flag")
def high_value_flag(df: DataFrame, column: str, value: float) -> DataFrame:
    return df.withColumn("is_high_value", F.col(column) >= value)


def run_steps(df: DataFrame, config: Iterable[dict]) -> DataFrame:
    """Apply configured steps in order; an unknown step name is an error."""
    for entry in config:
        options = dict(entry)
        df = df.transform(STEPS[options.pop("step")], **options)
    return df
