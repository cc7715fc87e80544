"""Patterns over the events of a user, by a finite automaton whose steps compose.

A pattern is a list of steps; the automaton's states are the sets of steps that the
events so far may have reached.  A stretch of events is a function from states to
states (with the number of matches it completes), and two stretches that follow
each other compose, whatever stands before them.  So stretches are worked out apart
and put together in the order of time: up to CHUNK events make one function, the
chunks of a slice one, and the slices of a user one.  Rows are read once, and a user
with most of the events is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.dates import epoch_micros
from tidewater.operators.ordered import HOT_ROWS, ordered, shift

CHUNK = 1000
MOST_STEPS = 8


@dataclass(frozen=True)
class Step:
    """An event that satisfies `cond`, `times` times.

    `after` says where the next one may stand: directly after the one before
    ("next") or anywhere later ("later").  With `within`, at most so many seconds
    lie between the event and the user's event before it.
    """

    cond: Column
    after: str = "later"
    times: int = 1
    within: float | None = None


class Automaton:
    """States and moves for a pattern; an event's kind has a bit for each of the pattern's steps."""

    def __init__(self, steps: Sequence[Step]):
        self.places = [(i, s.after) for i, s in enumerate(steps) for _ in range(s.times)]
        if not self.places or len(self.places) > MOST_STEPS or any(s.after not in ("next", "later") for s in steps):
            raise ValueError(f"a pattern has 1 to {MOST_STEPS} steps, each 'next' or 'later'")
        self.kinds = 1 << len(steps)

    def _moved(self, state: frozenset[int], kind: int) -> tuple[frozenset[int], bool]:
        """Reached places are counted from 0, nothing; a place waits if the one after it may stand anywhere."""
        after = {0} | {p for p in state if p < len(self.places) and self.places[p][1] == "later"}
        after |= {p + 1 for p in state if kind >> self.places[p][0] & 1}
        done = len(self.places) in after
        return (frozenset({0}) if done else frozenset(after)), done

    @cached_property
    def moves(self) -> tuple[list[int], list[int]]:
        """For state * kinds + kind: the next state, and whether a match ends there. State 0 is the beginning."""
        known, to, hits = [frozenset({0})], [], []
        for state in known:  # grows on the way
            for kind in range(self.kinds):
                after, done = self._moved(state, kind)
                if after not in known:
                    known.append(after)
                to.append(known.index(after))
                hits.append(int(done))
        return to, hits

    @property
    def size(self) -> int:
        return len(self.moves[0]) // self.kinds


def _identity(size: int) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("to"), F.lit(0).cast("bigint").alias("hits")) for s in range(size)])


def _composed(functions: Column, size: int) -> Column:
    """One function for an array of (order, function) structs."""
    put = lambda f, g: F.transform(f, lambda x: F.struct(F.get(g["f"], x["to"])["to"].alias("to"), (x["hits"] + F.get(g["f"], x["to"])["hits"]).alias("hits")))
    return F.aggregate(F.array_sort(functions), _identity(size), put)


def sequence_counts(
    df: DataFrame, user: str, ts: str, tiebreak: str, steps: Sequence[Step], hot_rows: int = HOT_ROWS, chunk: int = CHUNK
) -> DataFrame:
    """`user, events, matches`: how often the pattern occurs in each user's events, without overlaps, each match as early as it can end.

    Events are ordered by time and `tiebreak` (unique in a user); a condition that is
    null does not hold, and the first event has no event before it.  A null user is
    a user; events without a time come first.
    """
    automaton = Automaton(steps)
    to, hits = automaton.moves
    timed = df.select(F.col(user).alias("user"), epoch_micros(ts).alias("at"), F.col(tiebreak).alias("tie"), *[F.coalesce(s.cond, F.lit(False)).alias(f"c{i}") for i, s in enumerate(steps)])
    o = ordered(timed, ["user"], ["at", "tie"], hot_rows=hot_rows)
    if any(s.within is not None for s in steps):
        o = shift(o, {"before": F.col("at")}, ["at", "tie"])
    near = lambda s: F.lit(True) if s.within is None else F.coalesce(F.col("at") - F.col("before") <= F.lit(int(s.within * 1_000_000)), F.lit(False))
    kind = sum((F.when(F.col(f"c{i}") & near(s), F.lit(1 << i)).otherwise(F.lit(0)) for i, s in enumerate(steps)), F.lit(0))
    sliced = "__slice" in o.df.columns
    slice_ = F.col("__slice") if sliced else F.lit(0)
    parts = ["user", "__slice"] if sliced else ["user"]
    numbered = o.df.withColumn("kind", kind).withColumn("no", F.row_number().over(Window.partitionBy(*parts).orderBy("at", "tie")))
    events = numbered.groupBy(*parts, F.floor((F.col("no") - 1) / chunk).alias("chunk")).agg(F.collect_list(F.struct("no", "kind")).alias("events"), F.count(F.lit(1)).alias("n"))
    table = F.lit(to), F.lit(hits)
    move = lambda f, e: F.transform(f, lambda x: F.struct(F.get(table[0], x["to"] * automaton.kinds + e["kind"]).alias("to"), (x["hits"] + F.get(table[1], x["to"] * automaton.kinds + e["kind"])).alias("hits")))
    functions = events.select(*parts, "chunk", "n", F.aggregate(F.array_sort("events"), _identity(automaton.size), move).alias("f"))
    slices = functions.groupBy(*parts).agg(F.collect_list(F.struct(F.col("chunk").alias("no"), "f")).alias("fs"), F.sum("n").alias("n"))
    slices = slices.select("user", slice_.alias("no"), _composed(F.col("fs"), automaton.size).alias("f"), "n")
    users = slices.groupBy("user").agg(F.collect_list(F.struct("no", "f")).alias("fs"), F.sum("n").alias("events"))
    return users.select(F.col("user").alias(user), "events", F.get(_composed(F.col("fs"), automaton.size), F.lit(0))["hits"].alias("matches"))
