"""Customer and user activity measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import day, month


def active_in_every_month(df: DataFrame, key: str, date: str, months: int = 12) -> DataFrame:
    """Key and year with orders in at least `months` different months."""
    seen = df.select(key, F.year(date).cast("bigint").alias("year"), F.month(date).alias("m")).distinct()
    return seen.groupBy(key, "year").agg(F.count(F.lit(1)).alias("months")).where(F.col("months") >= months)


def inactive(df: DataFrame, key: str, date: str, as_of: str, days: int, name: str = "last_seen") -> DataFrame:
    """Keys whose last date lies more than `days` before `as_of`."""
    last = df.groupBy(key).agg(F.max(date).alias(name))
    return last.where(F.col(name) < F.date_sub(F.lit(as_of).cast("date"), days))


def active_months(df: DataFrame, key: str, date: str, name: str = "m") -> DataFrame:
    return df.select(key, month(date).alias(name)).distinct()


def new_vs_returning(df: DataFrame, key: str, date: str) -> DataFrame:
    """Per month: customers in their first month, and customers seen before."""
    first = df.groupBy(key).agg(month(F.min(date)).alias("first_m"))
    flagged = active_months(df, key, date).join(first, key)
    return flagged.groupBy("m").agg(
        F.count_if(F.col("m") == F.col("first_m")).alias("new_customers"),
        F.count_if(F.col("m") > F.col("first_m")).alias("returning_customers"),
    )


def cohort_retention(df: DataFrame, key: str, date: str) -> DataFrame:
    """Customers of each first month active in each later month, as count and percent."""
    first = df.groupBy(key).agg(month(F.min(date)).alias("cohort_month"))
    active = active_months(df, key, date, "order_month").join(first, key)
    counts = active.groupBy("cohort_month", "order_month").agg(F.count(F.lit(1)).alias("active_customers"))
    # everyone is active in the own first month, so the diagonal is the cohort size
    size = counts.where("cohort_month = order_month").select("cohort_month", F.col("active_customers").alias("size"))
    pct = F.lit(100.0) * F.col("active_customers") / F.col("size")
    return counts.join(size, "cohort_month").select("cohort_month", "order_month", "active_customers", pct.alias("retention_pct"))


def stickiness(df: DataFrame, user: str, ts: str) -> DataFrame:
    """Daily over monthly active users; both counts come from one distinct (user, day)."""
    days = df.select(user, day(ts).alias("d")).distinct()
    dau = days.groupBy("d").agg(F.count(F.lit(1)).alias("dau"))
    months = days.select(user, month("d").alias("m")).distinct().groupBy("m").agg(F.count(F.lit(1)).alias("mau"))
    joined = dau.join(months, month("d") == F.col("m"))
    return joined.select("d", "dau", "mau", F.try_divide(F.col("dau").cast("double"), F.col("mau")).alias("stickiness"))


def ab_compare(df: DataFrame, variant: str, hit: str) -> DataFrame:
    """Rates of variants 0 and 1, relative lift and two-proportion z, from one aggregate."""
    a, b = F.col(variant) == 0, F.col(variant) == 1
    counts = df.agg(
        F.count_if(a).alias("na"),
        F.count_if(b).alias("nb"),
        F.sum(F.when(a, F.col(hit))).alias("xa"),
        F.sum(F.when(b, F.col(hit))).alias("xb"),
    )
    rate_a, rate_b = F.try_divide("xa", "na"), F.try_divide("xb", "nb")
    pooled = F.try_divide(F.col("xa") + F.col("xb"), F.col("na") + F.col("nb"))
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("na")) + F.try_divide(F.lit(1), F.col("nb"))))
    return counts.select(
        rate_a.alias("rate_a"),
        rate_b.alias("rate_b"),
        F.round(F.try_divide(rate_b, rate_a) - 1, 8).alias("lift"),
        F.round(F.try_divide(rate_b - rate_a, spread), 8).alias("z"),
    )


def variant_of(key: str, split_percent: int = 50) -> Column:
    """Stable assignment of a key to variant 0 or 1 by hash."""
    return F.when(F.pmod(F.xxhash64(key), F.lit(100)) < split_percent, 0).otherwise(1)
