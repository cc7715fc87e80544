"""Mixing sources to target weights: balanced samples by the cube method.

Sources in order of their names (by code point, null last) have weights in turn,
and share the size of all documents by weight.  A target stops at `most` times
its source's size; what is over goes to the others by weight, until none is above.

A source whose target is r times its size takes every document floor(r) times, and
once more with probability r - floor(r).  Which ones is decided by the cube method:
the vector of probabilities moves inside the unit cube along the null space of the
constraints, so that the number of words and the number of documents taken stay
what the probabilities say, until each coordinate but a few is 0 or 1.  The move
goes either way with the odds that keep every document's probability.

Each source is cut into blocks of documents by hash, and every block is its own
flight, larger documents first.  Some documents of all sizes wait; these and the
one or two undecided of many blocks meet in blocks again, until each source has one
block left.  There the last fourteen at most are landed at once: of all ways to take
them, the one nearest to the words due, and to the documents due among these.

Draws come from a seed and the block, so reruns agree.  Null texts have size 0;
documents without words are taken, but bring no words.  Null ids and repeated rows
are documents of their own (equal rows may swap their copies); a null source is
a source.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import staged
from tidewater.operators.ordered import numeric, ordered, running
from tidewater.operators.skew import lookup_join

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 4096  # documents of one flight
SEED = 20_240_613
HELD = 12  # documents that wait for the landing
_SURE = 1e-9  # a probability this near to 0 or 1 is there


def word_count(text: str) -> Column:
    """Words between white space; a null text has none."""
    bare = F.regexp_replace(F.col(text), "^[\\x20\\x09-\\x0D]+", "")
    return F.coalesce(F.length(F.regexp_replace(bare, "[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*", "x")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`source, source_size, n_docs, weight, target` from `source, size` rows; each round of sharing is one aggregate."""
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    stored = staged(summed.withColumn("last", F.col("source").isNull().cast("int")).withColumn("name", F.coalesce("source", F.lit(""))), "source-sizes")
    along = F.when(F.col("last") == 1, F.lit(float("inf"))).otherwise(numeric(stored, "name"))
    placed = running(ordered(stored, [], ["last", "name"], along), {"place": ("count", F.lit(1))}).result()
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = staged(placed.select("source", "source_size", "n_docs", turn.alias("weight")), "source-weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0  # of the weight of one; grows from round to round
    roof = F.col("source_size") * most
    while total:
        over = F.col("weight") * F.lit(share) > roof
        facts = table.agg(F.sum(F.when(over, roof)).alias("fixed"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        grown = (total - int(facts["fixed"] or 0)) / int(facts["weight"]) if facts["weight"] else share
        if grown <= share:
            break
        share = grown
    return table.withColumn("target", F.least(F.col("weight") * F.lit(float(share)), roof.cast("double")))


def flight(chances: np.ndarray, sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Move `chances` along the null space of the sizes and of ones until at most two coordinates are undecided.

    Works on three undecided coordinates, one more than there are constraints; a
    decided one gives its place to the next.
    """
    out = chances.astype(np.float64).copy()
    values = sizes.astype(np.float64).tolist()
    active: list[int] = []
    undecided = iter(np.flatnonzero((out > _SURE) & (out < 1 - _SURE)).tolist())
    p = out.tolist()
    odds = iter(draw.random(len(p) + 1).tolist())
    while True:
        while len(active) < 3 and (i := next(undecided, None)) is not None:
            active.append(i)
        if len(active) < 3:
            break
        a, b, c = (values[i] for i in active)
        step = (b - c, c - a, a - b) if a != b or b != c else (1.0, -1.0, 0.0)  # neither words nor documents change
        up = min((1 - p[i]) / s if s > 0 else -p[i] / s for i, s in zip(active, step) if s)
        down = min(p[i] / s if s > 0 else (p[i] - 1) / s for i, s in zip(active, step) if s)
        by = up if next(odds) * (up + down) < down else -down
        left = []
        for i, s in zip(active, step):
            x = p[i] + by * s
            if x <= _SURE or x >= 1 - _SURE:
                p[i] = float(x > 0.5)
            else:
                p[i] = x
                left.append(i)
        active = left
    return np.array(p)


def held_flight(chances: np.ndarray, sizes: np.ndarray, draw: np.random.Generator, held: int = HELD) -> np.ndarray:
    """A flight without `held` coordinates spread over all sizes, so that at most two more are left."""
    p = chances.astype(np.float64).copy()
    undecided = np.flatnonzero((p > _SURE) & (p < 1 - _SURE))
    waiting = min(held, len(undecided))
    early = np.delete(undecided, ((np.arange(waiting) + 0.5) * len(undecided) / max(1, waiting)).astype(int))
    p[early] = flight(p[early], sizes[early], draw)
    return p


def landing(chances: np.ndarray, sizes: np.ndarray, draw: np.random.Generator, held: int = HELD) -> np.ndarray:
    """Decide all: after a flight, take of what is left what comes nearest to the words due, then to the documents due."""
    p = held_flight(chances, sizes, draw, held)
    left = np.flatnonzero((p > _SURE) & (p < 1 - _SURE))
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words, count = np.abs((choices - p[left]) @ sizes[left]), np.abs((choices - p[left]).sum(axis=1))
    p[left] = choices[np.lexsort([count, np.round(words, 6)])[0]]
    return np.round(p)


def _fly(units: DataFrame, seed: int) -> DataFrame:
    """One flight for each (source, block); a source of one block lands."""

    def group(table: pa.Table) -> pa.Table:
        size, mark = table.column("size").to_numpy(), table.column("mark").to_numpy()
        order = np.lexsort([mark, -size])
        own = [int(table.column(c)[0].as_py() or 0) for c in ("source_hash", "block", "round")]
        draw = np.random.default_rng([seed, *[x & 0xFFFFFFFF for x in own], (own[0] >> 32) & 0xFFFFFFFF])
        last = table.column("blocks")[0].as_py() == 1
        ends = (landing if last else held_flight)(table.column("chance").to_numpy()[order], size[order], draw)
        back = np.empty(len(order))
        back[order] = ends
        return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(back))

    return units.groupBy("source", "block").applyInArrow(group, units.schema)


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """`doc_id, source, size, source_size, target, times, taken`: how often each document is taken, and the words that brings."""
    sized = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(F.col(text)).alias("mark")), "sized")
    key = F.to_json(F.struct("source"))  # nulls meet
    targets = staged(source_targets(sized, weights, most).withColumn("key", key).drop("source", "weight"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = lookup_join(sized.withColumn("key", key), targets, "key").withColumn("ratio", ratio)
    # documents without words are not worth a place in a flight
    whole = F.when(F.col("ratio") - F.floor("ratio") > 1 - _SURE, F.ceil("ratio")).otherwise(F.floor("ratio")).cast("bigint")
    chance = F.when((F.col("size") > 0) & (F.abs(F.col("ratio") - F.round("ratio")) > _SURE), F.col("ratio") - F.floor("ratio")).otherwise(F.lit(0.0))
    blocks = F.ceil(F.col("n_docs") / block).cast("bigint")
    units = joined.select(
        "doc_id", "source", "size", "source_size", "target", whole.alias("whole"), chance.alias("chance"), F.lit(0).alias("round"),
        F.xxhash64("doc_id", "mark").alias("mark"), F.xxhash64("key").alias("source_hash"), blocks.alias("blocks"),
    ).withColumn("block", F.pmod(F.xxhash64("mark", F.lit(seed)), F.col("blocks")))
    result = [units.where("chance = 0").select("doc_id", "source", "size", "source_size", "target", "whole", "chance")]
    open_ = units.where("chance > 0")
    turn = 0
    while not open_.isEmpty():
        flown = staged(_fly(open_, seed), "flown")
        result.append(flown.where("chance = 0 OR chance = 1").select("doc_id", "source", "size", "source_size", "target", "whole", "chance"))
        turn += 1
        # of a block, at most HELD + 2 documents are undecided
        fewer = F.ceil(F.col("blocks") / max(2, block // (HELD + 2))).cast("bigint")
        open_ = flown.where("chance > 0 AND chance < 1").withColumns({"round": F.lit(turn), "block": F.floor(F.col("block") * fewer / F.col("blocks")).cast("bigint")}).withColumn("blocks", fewer)
    out = result[0]
    for more in result[1:]:
        out = out.unionByName(more)
    times = F.col("whole") + F.col("chance").cast("bigint")
    return out.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"))


def fetched(docs: DataFrame, mix: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents of a mix (unique ids), each as many rows as it is taken, numbered by `copy`."""
    times = mix.where("times > 0").select(F.col("doc_id").alias(doc_id), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return docs.join(times, doc_id)
