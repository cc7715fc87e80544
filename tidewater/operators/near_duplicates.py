"""Groups of nearly equal records: shared rare trigrams or MinHash bands find candidates, exact similarity decides, components make the groups."""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import trigrams
from tidewater.operators.graphs import components
from tidewater.operators.ordered import HOT_ROWS
from tidewater.operators.skew import is_small, pairs_within
from tidewater.session import cut_lineage

MISSED = 1e-4  # share of pairs just at the threshold that no band may find
KEYS = 128  # sets of rare trigrams that one record may be found by
SAME = 3  # trigrams of such a set, fewer where that would be too many sets
COMMON = 4096  # trigrams that are told apart by their frequency; all others count as rare
CROWD = 1000  # records of a bucket that meet each other at once
_EDGE = 1e-9  # a similarity of just the threshold counts, however it is rounded


def bands_for(threshold: float, rows: int, missed: float = MISSED) -> int:
    """Bands of `rows` MinHash values after which a pair at the threshold is missed with at most the given chance."""
    return max(1, ceil(log(missed) / log(1 - threshold**rows)))


def min_hashes(shingles: Column, n: int) -> list[Column]:
    """`n` independent minima over an array of shingle hashes."""
    hashed = lambda i: F.transform(shingles, lambda h: F.xxhash64(h, F.lit(i)))
    return [F.array_min(hashed(i)) for i in range(n)]


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike; a busy record is split by the adaptive skew join."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("set").alias(f"s_{name}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    common, both = F.size(F.array_intersect("s_a", "s_b")), F.size("s_a") + F.size("s_b")
    return met.where(common >= F.lit(threshold) * (both - common) - _EDGE).select("a", "b")


def _level(n: int, threshold: float) -> int:
    """Sizes of similar sets are of the same level or of neighbouring ones."""
    return n if threshold >= 1 else floor(log(n) / -log(threshold) + _EDGE)


def _shared(level: int, threshold: float) -> int:
    """How many trigrams make a key of pairs whose smaller set is of this level; 0 where that would be too many keys."""
    low, high = (level, level) if threshold >= 1 else (ceil(threshold**-level - 1e-6), floor(threshold ** -(level + 2) + 1e-6))
    spare = max(n - ceil(threshold * n - _EDGE) for n in [0, *range(max(1, low), high + 1)])
    most = min(SAME, max(1, ceil(threshold * low - _EDGE)))
    return next((k for k in range(most, min(2, most) - 1, -1) if comb(spare + k, k) <= KEYS), 0)  # one trigram alone is no key where two are shared


def _plans(threshold: float) -> list[int]:
    """`_shared` of all levels up to the first that has too many keys, at most 64."""
    out: list[int] = []
    while len(out) < 64 and (k := _shared(len(out), threshold)):
        out.append(k)
    return out


def _picked(places: Column, level: Column, spare: Column, k: int) -> Column:
    """Hashes of the members at the places that lie within the first `spare + k`."""
    fit = F.filter(places, lambda x: x[k - 1] < spare + k)
    return F.transform(fit, lambda x: F.xxhash64(level, *[F.get("set", x[i]) for i in range(k)]))


def _subset_keys(plans: list[int], threshold: float) -> Column:
    """Keys that any two similar sets share, one of them at least, if the smaller one's level has a plan.

    Two sets with `c` common members of which each may miss `spare` share their `k`
    first common members, in any order of all, among their first `spare + k`: that
    is why these are taken in the order of rarity.
    """
    level = F.when(F.lit(threshold >= 1), F.col("n")).otherwise(F.floor(F.ln("n") / -log(min(threshold, 1 - 1e-12)) + _EDGE)).cast("int")
    spare = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - _EDGE).cast("int")
    none = F.array().cast("array<bigint>")
    made = []
    for c in (level, level - 1):
        kind, found = F.coalesce(F.get(F.lit(plans).cast("array<int>"), c), F.lit(0)), none
        for k in sorted(set(plans)):
            # of combinations by their last place, the first ones are those of any shorter beginning
            width = max(p for p in range(k, KEYS + k) if comb(p, k) <= KEYS)
            places = F.array(*[F.array(*map(F.lit, x)) for x in sorted(combinations(range(width), k), key=lambda x: x[::-1])])
            found = F.when(kind == k, _picked(places, c, spare, k)).otherwise(found)
        made.append(found)
    return F.concat(*made)


def _alike(a: Column, b: Column, threshold: float) -> Column:
    """Whether two records (n, sketch) may be similar: each member that only one set has turns one bit at most."""
    na, nb = a["n"], b["n"]
    turned = F.bit_count(a["sketch"].bitwiseXOR(b["sketch"]))
    return (F.least(na, nb) >= F.lit(threshold) * F.greatest(na, nb) - _EDGE) & (turned <= F.lit((1 - threshold) / (1 + threshold)) * (na + nb) + 1e-6)


def near_duplicate_groups(df: DataFrame, key: str, text: Column, threshold: float = 0.8, rows: int = 4, hot_rows: int = HOT_ROWS, block: int = 20_000) -> DataFrame:
    """`key, group_id`: the smallest key of each record's group.

    Texts are compared by the Jaccard similarity of their letter trigrams (blanks
    around, case ignored); equal texts share one representative before anything
    else, so copies make no pairs.  Candidates share some of their rarest trigrams,
    which finds every pair; long texts, for which that would be too many keys, share
    a band of MinHash values.  A sketch in 64 bits is compared where candidates meet,
    so pairs that only look alike by their key leave no row.  In a crowded bucket
    everyone first meets its smallest member, which settles a bucket of near copies
    with as many pairs as members; then only members of different components meet,
    block by block where a bucket is large.  A null or empty text is a group of its
    own; rows without a key are left out.
    """
    named = df.select(F.col(key).alias("id"), F.lower(text).alias("text")).where("id IS NOT NULL")
    spoken = named.where("text <> ''")
    reps = cut_lineage(spoken.groupBy("text").agg(F.min("id").alias("node")))
    hashed = F.transform(trigrams("text"), lambda g: F.xxhash64(g))
    grams = reps.repartition("node").select("node", "text", F.explode(F.array_distinct(hashed)).alias("g"))
    often = cut_lineage(grams.groupBy("g").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "g").limit(COMMON))
    members = F.transform(F.sort_array(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "g"))), lambda x: x["g"])
    listed = grams.join(F.broadcast(often), "g", "left").groupBy("node", "text").agg(members.alias("set"))  # an id may have several texts
    folded = F.aggregate("set", F.lit(0).cast("bigint"), lambda bits, g: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(g, F.lit(64)).cast("int"))))
    sets = cut_lineage(listed.select("node", F.size("set").alias("n"), folded.alias("sketch"), "set"))
    plans = _plans(threshold)
    keys = _subset_keys(plans, threshold)
    longest = sets.agg(F.max("n")).first()[0] or 1
    if _level(longest, threshold) >= len(plans):
        bands = bands_for(threshold, rows)
        values = min_hashes(F.col("set"), bands * rows)
        far = F.array(*[F.xxhash64(F.lit(b), *values[b * rows : (b + 1) * rows]) for b in range(bands)])  # a band's number is part of its key
        least = next(n for n in range(1, longest + 1) if _level(n, threshold) >= len(plans))
        keys = F.concat(keys, F.when(F.col("n") >= least, far).otherwise(F.array().cast("array<bigint>")))
    record = F.struct("root", "node", "n", "sketch").alias("m")
    keyed = lambda placed: placed.select(F.explode(keys).alias("bucket"), record)
    alone = keyed(sets.withColumn("root", F.col("node")))
    crowds = cut_lineage(alone.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.min("m").alias("low")).where(F.col("c") > CROWD))
    crowds = F.broadcast(crowds) if is_small(crowds) else crowds
    stars = alone.join(crowds, "bucket").where((F.col("m.node") > F.col("low.node")) & _alike(F.col("m"), F.col("low"), threshold))
    links = cut_lineage(_similar(stars.select(F.col("low.node").alias("a"), F.col("m.node").alias("b")).distinct(), sets, threshold))
    # what is still apart within a bucket
    placed = cut_lineage(sets.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node")))
    again = keyed(placed)
    settled = cut_lineage(again.join(crowds, "bucket", "left_semi").groupBy("bucket").agg(F.min("m.root").alias("x"), F.max("m.root").alias("y")).where("x = y").select("bucket"))
    apart = again.join(F.broadcast(settled) if is_small(settled) else settled, "bucket", "left_anti")
    a, b = F.col("a"), F.col("b")
    met = pairs_within(apart, ["bucket"], "m", block).where((a["root"] != b["root"]) & _alike(a, b, threshold))
    fresh = met.select(F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b")).distinct().join(links, ["a", "b"], "left_anti")
    links = cut_lineage(links.unionByName(_similar(fresh, sets, threshold)))
    facts = cut_lineage(reps.join(components(links), "node", "left").select("text", F.coalesce("root", "node").alias("group_id")))
    silent = named.where("text IS NULL OR text = ''").select("id", F.col("id").alias("group_id"))
    found = spoken.join(facts, "text").select("id", "group_id").unionByName(silent)
    return found.withColumnRenamed("id", key)
