"""Ordered computations inside keys that hold up when one key owns much of the table.

A plain `Window.partitionBy(key)` puts a whole key into one task.  Here the keys
with more rows than one task should sort are found first (one map-side combined
count).  When there are none, the plain window is used.  Otherwise the rows of
those keys are cut into slices along the ordering, each slice is computed by its
own task, and a small table of slice totals carries the state from slice to
slice.  Cut points are constants, so a retried task cuts the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.dates import epoch_micros
from tidewater.session import cut_lineage

HOT_ROWS = 2_000_000  # rows of one key that one task may sort
LISTED = 10_000  # hot keys that go through the driver; more stay a stored table
MAX_SLICE_BITS = 12  # up to 4096 slices per key

_SLICE = "__slice"
_CUTS = "__cuts"


@dataclass(frozen=True)
class Ordered:
    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str | Column, ...]
    sliced: bool = False
    steps: int = 0  # running columns added since the rows were last stored

    def window(self, reverse: bool = False):
        """Ascending by default; backwards only when the order is given by names."""
        parts = [*self.keys, _SLICE] if self.sliced else [*self.keys]
        order = [F.desc(c) for c in self.order] if reverse else list(self.order)
        return Window.partitionBy(*parts).orderBy(*order)

    def using(self, df: DataFrame) -> Ordered:
        return Ordered(df, self.keys, self.order, self.sliced, self.steps)

    def result(self) -> DataFrame:
        return self.df.drop(_SLICE)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, listed: int = LISTED) -> DataFrame | None:
    """`keys, __n` of all keys with more than `hot_rows` rows; None when there is none."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    few = counts.limit(listed + 1).collect()
    if not few:
        return None
    return df.sparkSession.createDataFrame(few, _nullable(counts.schema)) if len(few) <= listed else cut_lineage(counts)


def _sent(df: DataFrame) -> DataFrame:
    """Broadcast when that is known to be small."""
    from tidewater.operators.skew import is_small

    return F.broadcast(df) if is_small(df) else df


def common_prefix(df: DataFrame, name: str) -> int:
    """Bytes that all strings of a column begin with: those that the smallest and the largest share."""
    low, high = (x.encode() if x else b"" for x in df.agg(F.min(name), F.max(name)).first())
    return next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))


def numeric(df: DataFrame, name: str, skip: int = 0) -> Column:
    """A double that grows with the column, for cutting it into slices; of strings the six bytes after the first `skip`."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(name).cast("double")
    if isinstance(kind, T.StringType):
        first = F.hex(F.substring(F.encode(F.col(name), "utf-8"), skip + 1, 6))
        return F.conv(F.rpad(first, 12, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def falling(along: Column) -> Column:
    """A double that grows along the descending order: NaN comes first there, null last."""
    return F.when(along.isNull(), F.lit(float("inf"))).when(F.isnan(along), F.lit(float("-inf"))).otherwise(-along)


def _bits(rows: int, hot_rows: int, least: int) -> int:
    return min(MAX_SLICE_BITS, max(least, ceil(log2(max(1.0, rows / hot_rows))) + 1))


def _cut_points(along: Column, bits: int) -> Column:
    n = 1 << bits
    return F.percentile_approx(along, [i / n for i in range(1, n)], max(10_000, 8 * n))


def _slice_of(along: Column, cuts: Column, bits: int) -> Column:
    """How many cut points lie below the value: a binary search over 2^bits - 1 points."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < along, at + step).otherwise(at),
    )


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on shared column names."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    along: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> Ordered:
    """Prepare `df` for ordered work inside `keys` (no keys: over the whole frame).

    `along` must not decrease along `order`; it defaults to the first order column.
    """
    cols = tuple(order)
    hot = hot_keys(df, keys, hot_rows) if keys else None
    if keys and hot is None:
        return Ordered(df, tuple(keys), cols)
    if along is None:
        text = isinstance(df.schema[order[0]].dataType, T.StringType)
        along = numeric(df, order[0], common_prefix(df, order[0]) if text else 0)
    if not keys:
        fine = 9
        facts = df.agg(F.count(F.lit(1)).alias("n"), _cut_points(along, fine).alias("c")).first()
        bits = _bits(facts["n"], hot_rows, least=3)
        if bits > fine:
            cuts = df.agg(_cut_points(along, bits).alias("c")).first()["c"] or []
        else:
            every = 1 << (fine - bits)
            cuts = (facts["c"] or [])[every - 1 :: every]
        sliced = df.withColumn(_SLICE, _slice_of(along, F.lit(list(cuts)).cast("array<double>"), bits))
        return Ordered(sliced, (), cols, True)
    level = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("__n") / hot_rows))).cast("int") + 1
    sized = hot.withColumn("__bits", F.least(F.lit(MAX_SLICE_BITS), F.greatest(F.lit(3), level)))
    cuts = None  # in all about two numbers per `hot_rows` rows of the table
    bits = sorted(r[0] for r in sized.select("__bits").distinct().collect())
    for b in bits:
        picked = _sent(sized.where(F.col("__bits") == b).select(*keys))
        chosen = df.join(picked, same(df, picked, keys), "left_semi").groupBy(*keys).agg(_cut_points(along, b).alias(_CUTS))
        cuts = chosen if cuts is None else cuts.unionByName(chosen)
    cuts = cut_lineage(cuts)
    named = cuts.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], _CUTS)
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(named[f"__hot_{k}"])
    joined = df.join(_sent(named), cond, "left")
    sliced = joined.withColumn(
        _SLICE, F.when(F.col(_CUTS).isNull(), F.lit(0)).otherwise(_slice_of(along, F.col(_CUTS), max(bits)))  # the search stops early in the shorter lists of smaller keys
    )
    return Ordered(sliced.drop(_CUTS, *[f"__hot_{k}" for k in keys]), tuple(keys), cols, True)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


_FOLD = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _combine(kind: str, earlier: Column, local: Column) -> Column:
    if kind == "count":
        return F.coalesce(earlier, F.lit(0)) + local
    if kind == "sum":
        return F.coalesce(earlier + local, earlier, local)
    if kind == "max":
        return F.when(earlier > local, earlier).otherwise(F.coalesce(local, earlier))
    return F.when(earlier < local, earlier).otherwise(F.coalesce(local, earlier))


def running(
    o: Ordered,
    outs: dict[str, tuple[str, Column]],
    exclusive: bool = False,
    reverse: bool = False,
    peers: bool = False,
) -> Ordered:
    """Add running `sum`, `count`, `max` or `min` columns, as ROWS frames.

    With `peers` the rows that stand at the same place see each other (RANGE frames);
    a slice never parts them when they agree in what the slices are cut along.
    `exclusive` leaves the current row out; `reverse` runs from the end of the key,
    as a growing frame over the reversed order (a frame up to the end of the
    partition would be evaluated anew for every row).  Of several steps over slices,
    each after the first stores its rows, so the input is read twice however many
    steps there are.
    """
    if o.sliced and o.steps:  # rows and totals would both go back through the steps before
        o = Ordered(cut_lineage(o.df), o.keys, o.order, True)
    w = o.window(reverse)
    w = w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    local = {n: _FOLD[kind](c).over(w) for n, (kind, c) in outs.items()}
    if not o.sliced:
        return o.using(o.df.withColumns(local))
    marked = o.df.withColumns({f"__l_{n}": c for n, c in local.items()})
    parts = [*o.keys, _SLICE]
    totals = o.df.groupBy(*parts).agg(*[_FOLD[kind](c).alias(f"__t_{n}") for n, (kind, c) in outs.items()])
    along = F.desc(_SLICE) if reverse else F.asc(_SLICE)
    before = Window.partitionBy(*o.keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    carry_fold = {"count": F.sum}
    carried = totals.select(
        *[F.col(p).alias(f"__k_{p}") for p in parts],
        *[carry_fold.get(kind, _FOLD[kind])(f"__t_{n}").over(before).alias(f"__e_{n}") for n, (kind, _) in outs.items()],
    )
    cond = marked[_SLICE] == carried[f"__k_{_SLICE}"]
    for k in o.keys:
        cond = cond & marked[k].eqNullSafe(carried[f"__k_{k}"])
    joined = marked.join(carried, cond, "left")
    done = joined.withColumns({n: _combine(kind, F.col(f"__e_{n}"), F.col(f"__l_{n}")) for n, (kind, _) in outs.items()})
    extra = [f"__k_{p}" for p in parts] + [f"__{x}_{n}" for x in "le" for n in outs]
    return Ordered(done.drop(*extra), o.keys, o.order, True, o.steps + 1)


def shift(
    o: Ordered,
    outs: dict[str, Column],
    by: Sequence[str],
    ahead: bool = False,
    default: Column | None = None,
) -> Ordered:
    """Add the value of the previous row (or of the next one with `ahead`).

    `by` names the ascending order columns, which must be unique inside a key.
    """
    if not o.sliced:
        move = F.lead if ahead else F.lag
        made = {n: move(c, 1).over(o.window()) for n, c in outs.items()}
        if default is not None:
            numbered = move(F.lit(1), 1).over(o.window())
            made = {n: F.when(numbered.isNull(), default).otherwise(c) for n, c in made.items()}
        return o.using(o.df.withColumns(made))
    value = F.struct(*[F.col(b) for b in by], *[c.alias(f"__v_{n}") for n, c in outs.items()])
    kind = "min" if ahead else "max"
    run = running(o, {"__near": (kind, value)}, exclusive=True, reverse=ahead)
    made = {}
    for n in outs:
        got = F.col("__near")[f"__v_{n}"]
        made[n] = got if default is None else F.when(F.col("__near").isNull(), default).otherwise(got)
    return run.using(run.df.withColumns(made).drop("__near"))


def range_frame(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    back: int,
    outs: dict[str, tuple[str, Column]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`sum`, `count`, `max` or `min` over the rows of a key at `position - back` .. `position`.

    Positions are cut into cells as long as the frame, so a frame is the end of one
    cell and the beginning of the next.  Every row goes to its own cell and, moved
    on by `back`, to the next: there the moved rows from a position onward and the
    own rows up to it are two growing frames, and neither subtracts anything.  A
    busy key spreads over its cells, and a busy cell over slices, in the same way.
    Rows without a position see the rows of their key without one.
    """
    cell = max(1, back)
    taken = [n for n in ("__at", "__cell", "__own") if n in df.columns]
    if taken:
        raise ValueError(f"columns {taken} are used inside")
    inputs = {f"__i_{n}": c for n, (_, c) in outs.items()}
    placed = df.withColumns({"__at": position.cast("bigint"), **inputs})
    home = F.floor(F.col("__at") / cell)
    own = F.struct(home.alias("__cell"), F.col("__at").alias("__at"), F.lit(True).alias("__own"))
    moved = F.struct((home + 1).alias("__cell"), (F.col("__at") + back).alias("__at"), F.lit(False).alias("__own"))
    sides = F.when(F.col("__at").isNull(), F.array(own)).otherwise(F.array(own, moved))
    # of a moved row, only its values are needed
    rest = [F.when(F.col("__side.__own"), F.col(c)).alias(c) if c not in keys else F.col(c) for c in df.columns]
    copies = placed.withColumn("__side", F.explode(sides)).select(*rest, *inputs, "__side.*")
    o = ordered(copies, [*keys, "__cell"], ["__at"], hot_rows=hot_rows)
    of = lambda n, mine: F.when(F.col("__own") == mine, F.col(f"__i_{n}"))
    o = running(o, {f"__p_{n}": (kind, of(n, True)) for n, (kind, _) in outs.items()}, peers=True)
    o = running(o, {f"__s_{n}": (kind, of(n, False)) for n, (kind, _) in outs.items()}, reverse=True, peers=True)
    made = {n: _combine(kind, F.col(f"__s_{n}"), F.col(f"__p_{n}")) for n, (kind, _) in outs.items()}
    extra = [f"__{x}_{n}" for x in "ips" for n in outs]
    return o.result().where("__own").withColumns(made).drop("__at", "__cell", "__own", *extra)
