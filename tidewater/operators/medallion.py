"""Raw, cleaned and aggregated layers as Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import day
from tidewater.operators.ranking import latest


def bronze(df: DataFrame, path: str, ts: str) -> str:
    """Rows as they came, by day of arrival."""
    df.withColumn("ingest_day", day(ts)).write.mode("overwrite").partitionBy("ingest_day").parquet(path)
    return path


def silver(spark: SparkSession, source: str, path: str, keys: Sequence[str], valid: Column, order: Sequence[str]) -> str:
    """Valid rows, the newest per key by the `order` columns."""
    raw = spark.read.parquet(source)
    latest(raw.where(valid), keys, order).write.mode("overwrite").partitionBy("ingest_day").parquet(path)
    return path


def gold(spark: SparkSession, source: str, keys: Sequence[str], value: str) -> DataFrame:
    """Totals per day, read from the cleaned layer."""
    clean = spark.read.parquet(source)
    return clean.groupBy(*keys, F.col("ingest_day").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 2).alias("total"))
