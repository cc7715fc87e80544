"""Sessions, streaks, gaps, hierarchies and funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import day, days_between, days_without, epoch_micros
from tidewater.operators.ordered import HOT_ROWS, ordered, running, shift
from tidewater.session import cut_lineage

GAP_CHUNK = 10_000


def with_sessions(df: DataFrame, user: str, ts: str, tiebreak: str, gap_minutes: int = 30, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the sessions of a user; a gap strictly longer than the limit opens a new one."""
    timed = df.withColumn("__at", epoch_micros(ts))
    o = ordered(timed, [user], ["__at", tiebreak], hot_rows=hot_rows)
    o = shift(o, {"__prev": F.col("__at")}, ["__at", tiebreak])
    opens = F.col("__prev").isNull() | (F.col("__at") - F.col("__prev") > gap_minutes * 60_000_000)
    o = o.using(o.df.withColumn("__new", opens.cast("bigint")))
    return running(o, {"session_id": ("sum", F.col("__new"))}).result().drop("__at", "__prev", "__new")


def sessions(df: DataFrame, user: str, ts: str, tiebreak: str, gap_minutes: int = 30, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per session: start, end and number of events."""
    return with_sessions(df, user, ts, tiebreak, gap_minutes, hot_rows).groupBy(user, "session_id").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("events")
    )


def streaks(df: DataFrame, user: str, ts: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs of consecutive active days per user; several events on a day count once."""
    days = df.select(user, day(ts).alias("d")).distinct()
    o = running(ordered(days, [user], ["d"], hot_rows=hot_rows), {"__rn": ("count", F.lit(1))})
    island = F.date_sub("d", F.col("__rn").cast("int"))
    return o.result().withColumn("__island", island).groupBy(user, "__island").agg(
        F.min("d").alias("streak_start"), F.max("d").alias("streak_end"), F.count(F.lit(1)).alias("streak_length")
    ).drop("__island")


def day_gaps(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Neighbouring active days of a key (or of the whole table) that lie more than one day apart."""
    days = df.select(*keys, day(ts).alias("order_day")).distinct()
    o = shift(ordered(days, keys, ["order_day"]), {"previous_day": F.col("order_day")}, ["order_day"])
    gap = days_between("order_day", "previous_day")
    return o.result().withColumn("gap_days", gap).where("gap_days > 1").select(*keys, "previous_day", "order_day", "gap_days")


def missing_dates(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Calendar days between the first and last day of a key (or of the whole table) on which nothing happened."""
    return days_without(df, ts, df, ts, keys)


def missing_numbers(df: DataFrame, key: str) -> DataFrame:
    """Whole numbers between the smallest and largest key that do not occur.

    A wide gap is first cut into chunks, so no row ever holds a long list.
    """
    keys = df.select(F.col(key).cast("bigint").alias("k")).where("k IS NOT NULL").distinct()
    gaps = shift(ordered(keys, [], ["k"]), {"nk": F.col("k")}, ["k"], ahead=True).result().where("nk > k + 1")
    chunks = gaps.select("nk", F.explode(F.sequence(F.col("k") + 1, F.col("nk") - 1, F.lit(GAP_CHUNK))).alias("lo"))
    upto = F.least(F.col("lo") + GAP_CHUNK - 1, F.col("nk") - 1)
    return chunks.select(F.explode(F.sequence("lo", upto)).alias("missing"))


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, tiebreak: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Union of overlapping or touching intervals per key."""
    o = ordered(df, keys, [start, tiebreak], hot_rows=hot_rows)
    o = running(o, {"__reach": ("max", F.col(end))}, exclusive=True)
    opens = F.col("__reach").isNull() | (F.col(start) > F.col("__reach"))
    o = running(o.using(o.df.withColumn("__new", opens.cast("bigint"))), {"__island": ("sum", F.col("__new"))})
    return o.result().groupBy(*keys, "__island").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("merged")
    ).drop("__island")


def changed_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows that differ from the one before in any tracked column; a first row counts as changed."""
    state = F.struct(*[F.col(c) for c in tracked])
    o = shift(ordered(df, keys, order, hot_rows=hot_rows), {"__before": state}, order)
    return o.result().where(~F.col("__before").eqNullSafe(state)).drop("__before")


def window_funnel(
    df: DataFrame, user: str, ts: str, tiebreak: str, steps: Sequence[Column], window_seconds: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Deepest step each user reaches in order within the window that the first step opens.

    For an event of step k the latest opening that leads to it decides, because a
    later opening always leaves more time; that is a running maximum per step.
    """
    at = epoch_micros(ts)
    base = df.withColumn("__at", at).withColumn("__s1", F.when(steps[0], F.col("__at")))
    o = ordered(base, [user], ["__at", tiebreak], hot_rows=hot_rows)
    for k in range(2, len(steps) + 1):
        o = running(o, {f"__m{k}": ("max", F.col(f"__s{k - 1}"))}, exclusive=True)
        near = F.col("__at") - F.col(f"__m{k}") <= window_seconds * 1_000_000
        o = o.using(o.df.withColumn(f"__s{k}", F.when(steps[k - 1] & near, F.col(f"__m{k}"))))
    depth = F.lit(0)
    for k in range(1, len(steps) + 1):
        depth = F.when(F.col(f"__s{k}").isNotNull(), k).otherwise(depth)
    return o.result().groupBy(user).agg(F.max(depth).cast("bigint").alias("level"))


def sequence_match(df: DataFrame, user: str, ts: str, tiebreak: str, steps: Sequence[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """How often the steps occur directly after one another, per user that has them."""
    timed = df.withColumn("__at", epoch_micros(ts)).withColumn("__f1", steps[0])
    o = ordered(timed, [user], ["__at", tiebreak], hot_rows=hot_rows)
    for k in range(2, len(steps) + 1):
        o = shift(o, {f"__p{k}": F.col(f"__f{k - 1}")}, ["__at", tiebreak])
        o = o.using(o.df.withColumn(f"__f{k}", F.coalesce(F.col(f"__p{k}"), F.lit(False)) & steps[k - 1]))
    hits = F.count_if(F.col(f"__f{len(steps)}"))
    return o.result().groupBy(user).agg(hits.alias("matches")).where("matches > 0")


def ordered_chain(df: DataFrame, user: str, ts: str, steps: Sequence[Column]) -> DataFrame:
    """Users whose events contain the steps in order, other events between them allowed.

    The earliest event of each step after the step before decides, so every
    step is one aggregate with map-side combine.
    """
    timed = df.withColumn("__at", epoch_micros(ts))
    reached = timed.where(steps[0]).groupBy(user).agg(F.min("__at").alias("__t"))
    for s in steps[1:]:
        later = timed.where(s).join(reached, user).where(F.col("__at") > F.col("__t"))
        reached = later.groupBy(user).agg(F.min("__at").alias("__t"))
    return reached.select(user)


def hierarchy(df: DataFrame, node: str, parent: str, name: str) -> DataFrame:
    """Level, path and ancestors of every node that a root reaches, one join per level.

    Each level is checkpointed, so the plan stays short and a lost executor costs
    one level.  Any depth is followed; a node that is its own ancestor is an error.
    """
    nodes = cut_lineage(df.select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(name).alias("name")))
    none = F.array().cast(f"array<{df.schema[node].dataType.simpleString()}>")
    level = cut_lineage(
        nodes.where("parent IS NULL").select("node", "parent", "name", F.lit(1).cast("bigint").alias("level"), F.col("name").alias("path"), none.alias("ancestors"))
    )
    found = [level]
    while not level.isEmpty():
        if not level.where(F.array_contains("ancestors", F.col("node"))).isEmpty():
            raise ValueError("a node is its own ancestor")
        up = level.select(F.col("node").alias("parent"), "level", "path", "ancestors")
        level = cut_lineage(
            nodes.join(up, "parent").select(
                "node", "parent", "name",
                (F.col("level") + 1).alias("level"),
                F.concat_ws(" > ", "path", "name").alias("path"),
                F.array_append("ancestors", F.col("parent")).alias("ancestors"),
            )
        )
        found.append(level)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def total_reports(df: DataFrame, node: str, parent: str, name: str) -> DataFrame:
    """Direct and indirect reports of every node, zero included."""
    tree = hierarchy(df, node, parent, name)
    counts = tree.select(F.explode("ancestors").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return tree.select("node").join(counts, "node", "left").select(
        F.col("node").alias("manager_id"), F.coalesce("n", F.lit(0)).alias("total_reports")
    )
