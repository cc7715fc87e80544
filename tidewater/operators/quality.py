"""Data-quality, reconciliation and drift checks, each in as few passes as it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum per column, in one pass."""
    aggs = []
    for c in columns:
        n = F.count(c)
        aggs += [
            n.alias(f"n:{c}"),
            (F.round(F.sum(F.col(c).cast("double")), 2) / n).alias(f"mean:{c}"),
            F.round(F.stddev_samp(c), 2).alias(f"sd:{c}"),
            F.min(c).cast("double").alias(f"lo:{c}"),
            F.max(c).cast("double").alias(f"hi:{c}"),
        ]
    line = lambda c: F.struct(
        F.lit(c).alias("column_name"), F.col(f"n:{c}").alias("n"), F.col(f"mean:{c}").alias("mean"),
        F.col(f"sd:{c}").alias("stddev"), F.col(f"lo:{c}").alias("min"), F.col(f"hi:{c}").alias("max"),
    )
    return df.agg(*aggs).select(F.inline(F.array(*[line(c) for c in columns])))


def quality_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, nulls per column and duplicate keys as (metric, value), in one scan.

    Grouping by the key first gives the distinct keys, counting a null key as one,
    and carries the null counts along.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in df.columns if c not in keys]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *nulls)
    key_nulls = [F.sum(F.when(F.col(k).isNull(), F.col("__n")).otherwise(0)).alias(f"null:{k}") for k in keys]
    rest = [F.sum(f"`null:{c}`").alias(f"null:{c}") for c in df.columns if c not in keys]
    one = per_key.agg(F.sum("__n").alias("total_rows"), (F.sum("__n") - F.count(F.lit(1))).alias("duplicate_keys"), *key_nulls, *rest)
    lines = [F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias("value")) for c in one.columns]
    return one.select(F.inline(F.array(*lines)))


def violations(df: DataFrame, row_id: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule and row; `rules` maps a message to the condition that breaks it."""
    found = F.filter(
        F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in rules.items()]), lambda r: r.isNotNull()
    )
    return df.select(*row_id, F.explode(found).alias("rule"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of rows that carry them."""
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def row_hash(columns: Sequence[str]) -> Column:
    """A canonical hash of named columns: sorted by name, nulls kept apart from text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def reconcile(left: DataFrame, right: DataFrame, key: str, compared: Sequence[str]) -> DataFrame:
    """Keys missing on one side or differing in a compared column."""
    l = left.select(F.col(key), F.struct(*compared).alias("l"))
    r = right.select(F.col(key), F.struct(*compared).alias("r"))
    status = (
        F.when(F.col("l").isNull(), "only_right").when(F.col("r").isNull(), "only_left")
        .when(~F.col("l").eqNullSafe(F.col("r")), "differs")
    )
    return l.join(r, key, "full").select(key, status.alias("status")).where("status IS NOT NULL")


def timeliness(df: DataFrame, keys: Sequence[str], happened: Column, arrived: Column, days: int) -> DataFrame:
    """`keys, n, late, timeliness`: the share of rows that arrived at most so many days after they happened; rows that have not arrived are late."""
    on_time = F.coalesce(F.date_diff(arrived, happened) <= days, F.lit(False))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(~on_time).alias("late"))
    return counted.withColumn("timeliness", F.round(1 - F.col("late") / F.col("n"), 6))


def volume_check(df: DataFrame, day_column: Column, back: int = 7) -> DataFrame:
    """Rows per day against the mean of the days before. The window is over one row per day."""
    daily = df.groupBy(day_column.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    past = Window.orderBy("d").rowsBetween(-back, -1)
    framed = daily.select("d", "n", F.sum("n").over(past).alias("s"), F.count("n").over(past).alias("c"))
    return framed.select("d", "n", (F.col("s") / F.col("c")).alias("usual"), (F.col("n") / (F.col("s") / F.col("c"))).alias("ratio"))


def psi(expected: Column, actual: Column) -> Column:
    """One bin's share of the population stability index, with empty bins floored."""
    floor = F.lit(1e-6)
    e, a = F.greatest(expected, floor), F.greatest(actual, floor)
    return (a - e) * F.ln(a / e)


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two label columns, from their contingency table."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    agree = cells.agg(F.sum("n").alias("total"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    left = cells.groupBy(F.col(a).alias("label")).agg(F.sum("n").alias("x"))
    right = cells.groupBy(F.col(b).alias("label")).agg(F.sum("n").alias("y"))
    chance = left.join(right, "label").agg(F.sum(F.col("x") * F.col("y")).alias("products"))
    po = F.col("same") / F.col("total")
    pe = F.col("products") / (F.col("total") * F.col("total"))
    return agree.select("total", "same", chance.scalar().alias("products")).select(
        po.alias("observed"), F.round((po - pe) / (1 - pe), 8).alias("kappa")
    )


def bin_shares(df: DataFrame, column: str, edges: Sequence[float], side: str) -> DataFrame:
    """Share of rows per bin; a bin is the number of edges below the value."""
    above = [F.when(F.col(column) > F.lit(float(e)), 1).otherwise(0) for e in edges]
    bin_no = F.lit(0)
    for a in above:
        bin_no = bin_no + a
    counts = df.where(F.col(column).isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias(f"{side}_n"))
    total = counts.agg(F.sum(f"{side}_n")).scalar()
    return counts.select("bin", f"{side}_n", (F.col(f"{side}_n") / total).alias(side))


def drift(baseline: DataFrame, current: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """PSI, KL divergence and chi-square of a feature between two frames, over fixed bins."""
    both = bin_shares(baseline, column, edges, "expected").join(bin_shares(current, column, edges, "actual"), "bin", "full")
    filled = both.fillna(0.0, ["expected", "actual"]).fillna(0, ["expected_n", "actual_n"])
    n = current.where(F.col(column).isNotNull()).agg(F.count(F.lit(1))).scalar()
    floor = F.lit(1e-6)
    e, a = F.greatest("expected", floor), F.greatest("actual", floor)
    return filled.agg(
        F.round(F.sum(psi(F.col("expected"), F.col("actual"))), 8).alias("psi"),
        F.round(F.sum(a * F.ln(a / e)), 8).alias("kl"),
        F.round(F.sum(F.pow(F.col("actual") - F.col("expected"), 2) / e) * F.max(n), 4).alias("chi_square"),
    ).withColumn("drifted", F.col("psi") > 0.2)


def unbalanced(entries: DataFrame, txn: str, amount: str) -> DataFrame:
    """Transactions whose entries do not sum to zero, in exact decimals."""
    exact = F.sum(F.col(amount).cast("decimal(20,4)"))
    return entries.groupBy(txn).agg(exact.alias("balance"), F.count(F.lit(1)).alias("entries")).where("balance <> 0")


def dataset_slo(df: DataFrame, keys: Sequence[str], lag_seconds: str, limit: float) -> DataFrame:
    """Rows, share within the limit and exact 95th percentile of a delay, per dataset."""
    from tidewater.operators.ranking import quantiles

    known = df.where(F.col(lag_seconds).isNotNull())
    shares = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col(lag_seconds) <= limit) / F.count(F.lit(1))).alias("within")
    )
    return shares.join(quantiles(known, keys, lag_seconds, {"p95": 0.95}), list(keys))
