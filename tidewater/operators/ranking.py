"""Ranks, top-n and exact quantiles that do not funnel a large group through one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ordered import HOT_ROWS, falling, hot_keys, numeric, ordered, running


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of each key. Spark trims every task to n rows per key before
    the shuffle (WindowGroupLimit), so a large key costs no more than a small one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank or "__rn", F.row_number().over(w)).where(F.col(rank or "__rn") <= n)
    return kept if rank else kept.drop("__rn")


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], newest: bool = True) -> DataFrame:
    """One whole row per key, with the largest (or smallest) `by`; combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max if newest else F.min
    lead = [F.col(b).alias(f"__by{i}") for i, b in enumerate(by)]
    one = df.groupBy(*keys).agg(pick(F.struct(*lead, *[F.col(c) for c in rest])).alias("__row"))
    return one.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def nth_highest(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """Rows whose value is the n-th distinct one from the top of its key; ties all stay.

    Distinct values are ranked, not rows, so tied rows never pile up in one task.
    """
    distinct = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    if keys:
        picked = distinct.withColumn("__rk", F.row_number().over(w)).where(F.col("__rk") == n).drop("__rk")
    else:
        best = distinct.orderBy(F.desc(value)).limit(n)
        picked = best.agg(F.min(value).alias(value), F.count(F.lit(1)).alias("__c")).where(F.col("__c") == n).drop("__c")
    named = picked.select(*[F.col(c).alias(f"__p_{c}") for c in [*keys, value]])
    cond = F.col(value) == F.col(f"__p_{value}")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__p_{k}"))
    return df.join(named, cond, "left_semi")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    outs: dict[str, str],
    descending: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `rank`, `dense_rank`, `cume_dist`, `percent_rank` columns (outs: name -> kind).

    Keys of ordinary size use the window functions.  A large key, or the whole
    table when there are no keys, is ranked from the counts of its distinct values.
    """
    order = F.desc(value) if descending else F.asc(value)
    if keys and hot_keys(df, keys, hot_rows) is None:
        w = Window.partitionBy(*keys).orderBy(order)
        fn = {"rank": F.rank, "dense_rank": F.dense_rank, "cume_dist": F.cume_dist, "percent_rank": F.percent_rank}
        long = {"rank", "dense_rank"}
        return df.withColumns({n: fn[k]().over(w).cast("bigint" if k in long else "double") for n, k in outs.items()})
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    along = numeric(df, value)
    o = ordered(counts, keys, [order], along=falling(along) if descending else along, hot_rows=hot_rows)
    cum = running(o, {"__cum": ("sum", F.col("__n")), "__dense": ("count", F.lit(1))}).result()
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    if keys:
        named = totals.select(*[F.col(k).alias(f"__t_{k}") for k in keys], "__total")
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
        cum = cum.join(named, cond)
    else:
        cum = cum.withColumn("__total", totals.scalar())
    first = F.col("__cum") - F.col("__n") + 1
    expr = {
        "rank": first,
        "dense_rank": F.col("__dense"),
        "cume_dist": F.col("__cum") / F.col("__total"),
        "percent_rank": F.when(F.col("__total") == 1, F.lit(0.0)).otherwise((first - 1) / (F.col("__total") - 1)),
    }
    table = cum.select(
        *[F.col(c).alias(f"__r_{c}") for c in [*keys, value]], *[expr[k].alias(n) for n, k in outs.items()]
    )
    cond = F.lit(True)
    for c in [*keys, value]:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return df.join(table, cond).drop(*[f"__r_{c}" for c in [*keys, value]])


def numbered(
    df: DataFrame,
    value: str,
    tiebreak: str,
    out: str,
    descending: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Row number over the whole frame by value and a unique tiebreak.

    When one value has too many ties for a task, it is the rank of the value plus
    the place among the ties, which are cut into slices of their own.
    """
    if hot_keys(df, [value], hot_rows) is None:
        along = falling(numeric(df, value)) if descending else numeric(df, value)
        o = ordered(df, [], [F.desc(value) if descending else F.asc(value), F.asc(tiebreak)], along=along, hot_rows=hot_rows)
        return running(o, {out: ("count", F.lit(1))}).result()
    base = ranked(df, [], value, {"__rank": "rank"}, descending, hot_rows)
    o = ordered(base, [value], [tiebreak], hot_rows=hot_rows)
    tied = running(o, {"__place": ("count", F.lit(1))}).result()
    return tied.withColumn(out, F.col("__rank") + F.col("__place") - 1).drop("__rank", "__place")


def ntile(df: DataFrame, value: str, tiebreak: str, buckets: int, out: str, descending: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equal-sized buckets over the whole frame; the first `rows mod buckets` get one row more."""
    rows = df.count()
    small, extra = divmod(rows, buckets)
    rn = F.col("__rn")
    head = extra * (small + 1)
    in_head = F.floor((rn - 1) / (small + 1)) + 1
    in_tail = F.floor((rn - 1 - head) / max(small, 1)) + 1 + extra
    tile = F.when(rn <= head, in_head).otherwise(in_tail).cast("bigint")
    return numbered(df, value, tiebreak, "__rn", descending, hot_rows).withColumn(out, tile).drop("__rn")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles per key (or one row for the whole frame).

    Ordinary keys use `percentile`; keys too large for that are answered from
    running counts of their distinct values.  The whole frame needs no sort at
    all: see `select_quantiles`.
    """
    if not keys:
        found = select_quantiles(df, value, list(probs.values()))
        schema = ", ".join(f"`{n}` double" for n in probs)
        return df.sparkSession.createDataFrame([tuple(found[p] for p in probs.values())], schema)
    known = df.where(F.col(value).isNotNull())
    if hot_keys(known, keys, hot_rows) is None:
        return known.groupBy(*keys).agg(*[F.percentile(value, p).alias(n) for n, p in probs.items()])
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    cum = running(ordered(counts, keys, [value], hot_rows=hot_rows), {"__cum": ("sum", F.col("__n"))}).result()
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    named = totals.select(*[F.col(k).alias(f"__t_{k}") for k in keys], "__total")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
    cum = cum.join(named, cond)
    aggs = []
    for n, p in probs.items():
        pos = F.lit(p) * (F.col("__total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        at = lambda i: F.max(F.when((F.col("__cum") > i) & (F.col("__cum") - F.col("__n") <= i), F.col(value)))
        aggs += [at(lo).alias(f"__lo_{n}"), at(hi).alias(f"__hi_{n}"), F.max(pos - lo).alias(f"__w_{n}")]
    ends = cum.groupBy(*keys).agg(*aggs)
    mid = lambda n: F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")
    return ends.select(*keys, *[mid(n).alias(n) for n in probs])


def select_quantiles(df: DataFrame, value: str, probs: Sequence[float], most: int = 50_000) -> dict[float, float | None]:
    """Exact interpolated quantiles of a whole column by narrowing, without sorting or shuffling rows.

    Approximate quantiles a little below and above each wanted one bracket it.  One
    aggregate then counts the rows between the brackets and the values inside them;
    when a bracket still has too many values it is narrowed again.  Each pass reads
    the column once and leaves about a thousandth of the rows inside the brackets.
    """
    spread = 0.0005
    x = F.col("x")
    known = df.select(F.col(value).cast("double").alias("x")).where("x IS NOT NULL")
    around = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-spread, spread)})
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, around, 10_000).alias("q")).first()
    n = facts["n"]
    if n == 0:
        return {p: None for p in probs}
    at = dict(zip(around, facts["q"]))
    brackets = _joined([(at[max(0.0, p - spread)], at[min(1.0, p + spread)]) for p in probs])
    ranks = sorted({r for p in probs for r in (floor(p * (n - 1)), ceil(p * (n - 1)))})
    most = max(most, 8 * len(ranks))  # a bracket narrowed all the way keeps a few values per rank
    while True:
        slot, inside = F.lit(0), F.lit(False)
        for lo, hi in brackets:
            slot = slot + F.when(x > hi, 1).otherwise(0)
            inside = inside | x.between(lo, hi)
        groups = known.groupBy(slot.alias("slot"), F.when(inside, x).alias("v")).agg(F.count(F.lit(1)).alias("c"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        lines = groups.limit(most + 1).collect()
        if len(lines) > most:
            smaller = _narrowed(known, brackets, ranks, spread)
            if smaller == brackets:
                raise RuntimeError("brackets cannot be narrowed further")
            brackets = smaller
            continue
        # a gap lies below the bracket of its slot
        lines.sort(key=lambda g: (g["slot"], g["v"] is not None, g["lo"]))
        found, missed, upto = {}, [], 0
        for g in lines:
            for r in ranks:
                if upto <= r < upto + g["c"]:
                    if g["v"] is None and g["lo"] < g["hi"]:
                        missed.append((g["lo"], g["hi"]))
                    else:
                        found[r] = g["lo"]
            upto += g["c"]
        if not missed:
            break
        brackets = _joined(brackets + missed)
    out = {}
    for p in probs:
        lo, hi = found[floor(p * (n - 1))], found[ceil(p * (n - 1))]
        out[p] = lo + (hi - lo) * (p * (n - 1) - floor(p * (n - 1)))
    return out


def _joined(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Overlapping brackets as one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _narrowed(known: DataFrame, brackets: list[tuple[float, float]], ranks: list[int], spread: float) -> list[tuple[float, float]]:
    """Smaller brackets around the wanted ranks, from approximate quantiles inside each bracket."""
    x = F.col("x")
    counts = known.agg(*[F.count_if(x < lo).alias(f"b{i}") for i, (lo, _) in enumerate(brackets)],
                       *[F.count_if(x.between(lo, hi)).alias(f"n{i}") for i, (lo, hi) in enumerate(brackets)]).first()
    aggs = []
    for i, (lo, hi) in enumerate(brackets):
        below, n = counts[f"b{i}"], counts[f"n{i}"]
        for r in ranks:
            if below <= r < below + n:
                p = (r - below) / max(1, n - 1)
                near = [max(0.0, p - spread), min(1.0, p + spread)]
                aggs.append(F.percentile_approx(F.when(x.between(lo, hi), x), near, 10_000).alias(f"q{len(aggs)}"))
    return _joined([tuple(q) for q in known.agg(*aggs).first()])
