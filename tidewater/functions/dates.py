"""Date and time expressions. Results are dates or bigints, never session-zone dependent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c: Column | str) -> Column:
    return _c(c).cast("date")


def month(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_c(c).cast("date"), "month")


def week(c: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(_c(c).cast("date"), "week")


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, without any time zone."""
    c = _c(c)
    minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.date_diff(_c(later), _c(earlier)).cast("bigint")


def to_utc(c: Column | str, zone: str) -> Column:
    """Wall-clock time in `zone` to wall-clock time in UTC, independent of the session zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(c))


def date_span(spark: SparkSession, first, last, name: str = "d") -> DataFrame:
    """One row per day from `first` to `last` inclusive."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))


def calendar_of(df: DataFrame, c: str, name: str = "d", keys: Sequence[str] = ()) -> DataFrame:
    """One row per day between the smallest and the largest day of column `c`, for each key."""
    bounds = df.groupBy(*keys).agg(F.min(day(c)).alias("lo"), F.max(day(c)).alias("hi")).where("lo is not null")
    return bounds.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


def missing_ranges(df: DataFrame, c: str, present: DataFrame, present_day: str, keys: Sequence[str] = ()) -> DataFrame:
    """`keys, range_start, range_end, days`: unbroken runs of the days of `calendar_of` on which `present` has no row of the key; a null key is a key.

    Days are held as words of 64 bits, filled before anything is shuffled, so a key
    has at most as many rows as its calendar has words and no day without a row is
    ever made.  The days just outside a key's bounds are marked like present ones: a
    run lies between two marked days that follow each other.
    """
    number = lambda d: F.unix_date(d).cast("bigint")
    bounds = df.groupBy(*keys).agg(F.min(number(day(c))).alias("__lo"), F.max(number(day(c))).alias("__hi")).where("__lo is not null")
    ends = bounds.select(*keys, F.explode(F.array(F.col("__lo") - 1, F.col("__hi") + 1)).alias("__n"), "__lo", "__hi")
    unknown = F.lit(None).cast("bigint")
    held = present.select(*keys, number(day(present_day)).alias("__n"), unknown.alias("__lo"), unknown.alias("__hi")).where("__n is not null")
    bit = F.expr("shiftleft(1L, CAST(pmod(__n, 64) AS INT))")
    words = held.union(ends).groupBy(*keys, F.floor(F.col("__n") / 64).alias("__w")).agg(
        F.bit_or(bit).alias("__bits"), F.max("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    here = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("__bits", i) == 1)
    marked = words.withColumn("__days", F.transform(here, lambda i: F.col("__w") * 64 + i))
    key = Window.partitionBy(*keys)
    last = F.lag(F.element_at("__days", -1)).over(key.orderBy("__w"))
    placed = marked.withColumns({"__last": last, "__lo": F.max("__lo").over(key), "__hi": F.max("__hi").over(key)})
    before = F.concat(F.array("__last"), F.slice("__days", F.lit(1), F.size("__days") - 1))
    met = placed.select(*keys, "__lo", "__hi", F.inline(F.arrays_zip(before.alias("p"), F.col("__days").alias("q"))).alias("__p", "__q"))
    runs = met.where("__q - __p > 1 AND __p >= __lo - 1 AND __q <= __hi + 1")
    at = lambda n: F.date_from_unix_date(n.cast("int"))
    return runs.select(*keys, at(F.col("__p") + 1).alias("range_start"), at(F.col("__q") - 1).alias("range_end"), (F.col("__q") - F.col("__p") - 1).alias("days"))


def days_without(df: DataFrame, c: str, present: DataFrame, present_day: str, keys: Sequence[str] = ()) -> DataFrame:
    """The days of `calendar_of` on which `present` has no row of the key; a null key is a key."""
    runs = missing_ranges(df, c, present, present_day, keys)
    return runs.select(*keys, F.explode(F.sequence("range_start", "range_end", F.expr("interval 1 day"))).alias("d"))


def date_attributes(df: DataFrame, d: str) -> DataFrame:
    """Calendar dimension attributes of a date column."""
    c = F.col(d)
    return df.select(
        c.alias("date_key"),
        F.year(c).cast("bigint").alias("year"),
        F.quarter(c).cast("bigint").alias("quarter"),
        F.month(c).cast("bigint").alias("month"),
        F.dayofmonth(c).cast("bigint").alias("day_of_month"),
        (F.weekday(c) + 1).cast("bigint").alias("iso_weekday"),
        (F.weekday(c) >= 5).alias("is_weekend"),
        (F.last_day(c) == c).alias("is_month_end"),
    )


def as_instant(c: Column | str) -> Column:
    """A wall-clock timestamp as a point in time, read as UTC; streams need this for watermarks."""
    return F.timestamp_micros(epoch_micros(c))


def as_wall_clock(c: Column | str) -> Column:
    """The UTC wall-clock reading of a point in time."""
    seconds = (F.unix_micros(_c(c)) / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01'") + F.make_dt_interval(secs=seconds)
