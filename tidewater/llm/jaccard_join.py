"""Documents whose sets of word shingles have a high Jaccard similarity: an exact self-join, and its components.

Shingles are hashed into DIMENSIONS groups; a document is the point of its counts
per group.  For two points the sum of the coordinate minima bounds the overlap
from above, and so does, for a point and a box of an R-tree, the sum of minima
with the box's upper corner.  Pairs that the bound lets through are verified on
the sets.

To bring the points of a possible pair together, each set is also cut by hash into
a few more parts than elements can differ: at least one non-empty part is then
equal, and its hash is a bucket that both share.  Equal sets are one point.  In
every bucket the members are first compared with its smallest document; buckets
that still hold several components get an R-tree over their points, and members
outside the largest component search it for partners in other components, the
closest first, in rounds, until none is left untested.  Links inside a component
change nothing and are not made; no link between components is left out.  Large
buckets are cut into blocks, every pair of blocks being a task of its own.

Words are compared as 64-bit hashes.  A null or empty text has the empty set and
is linked with nothing.  Rows that share a doc_id are one document; a row without
doc_id takes its class but links nothing.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.graphs import components, extended
from tidewater.llm.storage import ROWS_TO_SEND, packed, sent, staged
from tidewater.llm.words import LOWER, SAME, VISIBLE, Words, bounds, mixed, run_hashes, slices, windows, words

SHINGLE = 3
PERCENT = 90
DIMENSIONS = 64
FINE = 16  # shingles of a group of a fine point, at most; a set of up to DIMENSIONS * FINE has none
BLOCK = 3_000  # members of a bucket that one task indexes
LEAF, FAN = 16, 8
IDS_TO_SEND = 2_000_000  # 16 MB of candidate ids
HOME = 2_000_000  # shingles of the sets that are verified together


def _pow(values: np.ndarray, k: int) -> np.ndarray:
    return values.astype(np.uint64) * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1))


def sets_of(w: Words, rows: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted within each, and how many each row has."""
    grams, first = windows(w, size)
    begin = bounds(w.doc, rows)
    short = np.flatnonzero((np.diff(begin) > 0) & (np.diff(begin) < size))
    whole = [run_hashes(w.hash, begin[[i]], int(begin[i + 1] - begin[i])) for i in short.tolist()]
    grams = np.concatenate([grams, *whole])
    doc = np.concatenate([w.doc[first], short]) if len(short) else w.doc[first]
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[keep], np.bincount(doc[keep], minlength=rows)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Levels:
    """Ranges of set sizes that are cut into the same number of parts."""

    def __init__(self, percent: int):
        self.percent = percent
        differ = lambda n: (100 - percent) * (100 * n // percent) // 100  # elements in which a set of n and a larger partner can differ
        first = next((n for n in range(1, 10_000) if differ(n)), 1 << 40)
        start = [first]
        while start[-1] < 1 << 40:
            start.append(max(start[-1] + 1, start[-1] * 3 // 2))
        self.start = np.array(start)
        self.differ = np.array([differ(b - 1) for b in start[1:]])
        least = -(-percent * self.start[:-1] // 100)  # the smallest set that is cut at a level
        self.parts = np.array([self._parts(int(d), int(n)) for d, n in zip(self.differ, least)])

    @staticmethod
    def _parts(differ: int, least: int) -> int:
        """A few more than elements can differ; when so many would mostly leave too few filled, as many as fill enough."""
        parts = differ + 1 + max(1, -(-differ // 50))
        filled = lambda p: -p * math.expm1(-least / p)
        if filled(parts) < differ + 1:
            while filled(parts) < differ + 1 + parts**0.5 / 2 and parts < 4 * least:
                parts += max(1, parts // 50)
        return parts

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the levels each meets its partners at: its own, and the next when a partner may reach it."""
        rows = np.flatnonzero(sizes >= self.start[0])
        own = np.searchsorted(self.start, sizes[rows], "right") - 1
        reach = 100 * sizes[rows] // self.percent >= self.start[own + 1]
        return np.concatenate([rows, rows[reach]]), np.concatenate([own, own[reach] + 1])


def bucket_keys(grams: np.ndarray, sizes: np.ndarray, levels: Levels) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bucket keys.  Two sets that may be linked share one: of their parts at most `differ` are unlike.

    Equal empty parts tell nothing, so a set with too many of them is cut again by
    another hash; the first cut without too many is one that both sets have made.
    """
    begin = np.cumsum(sizes) - sizes
    row, level = levels.of(sizes)
    out_rows, out_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    seed = 0
    while len(row):
        n, parts = sizes[row], levels.parts[level]
        base = np.cumsum(parts) - parts
        element = np.arange(int(n.sum())) + np.repeat(begin[row] - (np.cumsum(n) - n), n)
        g = grams[element]
        place = (mixed(g + np.uint64(seed * 2 + 1)) >> np.uint64(32)) * np.repeat(parts, n).astype(np.uint64) >> np.uint64(32)
        at = place.astype(np.int64) + np.repeat(base, n)
        content, held = np.zeros(int(parts.sum()), np.uint64), np.bincount(at, minlength=int(parts.sum()))
        np.add.at(content, at, mixed(g ^ np.uint64(0x5851F42D4C957F2D)))
        owner = np.repeat(np.arange(len(row)), parts)
        number = np.arange(len(owner)) - base[owner]
        key = mixed(content + _pow(level[owner], 1) + _pow(number, 2) + _pow(np.full(len(owner), seed), 3))
        full = held > 0
        out_rows.append(row[owner[full]])
        out_keys.append(key[full])
        empty = parts - np.bincount(owner[full], minlength=len(row))
        again = empty > parts - levels.differ[level] - 1
        row, level, seed = row[again], level[again], seed + 1
    rows, keys = np.concatenate(out_rows), np.concatenate(out_keys)
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order]


SKETCH = "doc_id bigint, n_shingles bigint, sig_a bigint, sig_b bigint, point binary, fine binary"


def fine_point(grams: np.ndarray) -> bytes | None:
    """Counts of a large set's shingles in so many groups, a power of two, that the counts of unlike sets differ."""
    if len(grams) <= DIMENSIONS * FINE:
        return None
    bits = (len(grams) // FINE).bit_length()
    return np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u4").tobytes()


def may_link(left: bytes | None, right: bytes | None, percent: int) -> bool:
    """Whether the sum of the minima of two fine points allows a link; the finer one is folded to the other's groups."""
    if left is None or right is None:
        return True
    a, b = np.frombuffer(left, "<u4").astype(np.int64), np.frombuffer(right, "<u4").astype(np.int64)
    groups = min(len(a), len(b))
    shared = np.minimum(a.reshape(groups, -1).sum(axis=1), b.reshape(groups, -1).sum(axis=1)).sum()
    return bool((100 + percent) * shared >= percent * (a.sum() + b.sum()))


def sketches(docs: DataFrame, doc_id: str, text: str, size: int, fold: np.ndarray) -> DataFrame:
    """Per document: the size of its set, two hashes of the set, its point, and the fine point of a large set."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = batch.num_rows
            grams, sizes = sets_of(words(batch.column("text"), VISIBLE, fold), rows, size)
            doc = np.repeat(np.arange(rows), sizes)
            points = np.bincount(doc * DIMENSIONS + (grams >> np.uint64(58)).astype(np.int64), minlength=rows * DIMENSIONS).astype("<u4").reshape(rows, DIMENSIONS)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(_sums(mixed(grams), sizes).view(np.int64)),
                    pa.array(_sums(mixed(grams ^ np.uint64(0xBF58476D1CE4E5B9)), sizes).view(np.int64)),
                    pa.array([p.tobytes() for p in points], pa.binary()),
                    pa.array([fine_point(grams[e - n : e]) for e, n in zip(np.cumsum(sizes).tolist(), sizes.tolist())], pa.binary()),
                ],
                ["doc_id", "n_shingles", "sig_a", "sig_b", "point", "fine"],
            )

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(make, SKETCH)


def keyed_documents(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, size: int, percent: int, fold: np.ndarray) -> DataFrame:
    """`doc_id, key`: the bucket keys of the documents in `ids`, made from their texts and written nowhere."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(percent)
        for batch in slices(batches, "text"):
            row, keys = bucket_keys(*sets_of(words(batch.column("text"), VISIBLE, fold), batch.num_rows, size), levels)
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), pa.array(keys.view(np.int64))], ["doc_id", "key"])

    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    few = F.broadcast(ids) if ids.count() <= IDS_TO_SEND else ids
    return named.join(few, "doc_id", "left_semi").mapInArrow(make, "doc_id bigint, key bigint")


class CountTree:
    """An R-tree over count vectors, packed by splitting at the median of the widest coordinate.

    Only upper corners and size ranges are kept: the bound needs no more.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.concatenate([np.array(x) for x in self._split(points, np.arange(len(points)))])
        self.points, self.sizes = points[self.order].astype(np.int64), sizes[self.order]
        self.levels = [(self.points, self.sizes, self.sizes)]  # upper corners, smallest and largest sizes
        fan = LEAF
        while len(self.levels[-1][0]) > LEAF:
            corner, low, high = self.levels[-1]
            at = np.arange(0, len(corner), fan)
            self.levels.append((np.maximum.reduceat(corner, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
            fan = FAN

    def _split(self, points: np.ndarray, members: np.ndarray) -> list[np.ndarray]:
        if len(members) <= LEAF:
            return [members]
        own = points[members]
        wide = int((own.max(axis=0) - own.min(axis=0)).argmax())
        members = members[np.argsort(own[:, wide], kind="stable")]
        half = -(-len(members) // (2 * LEAF)) * LEAF
        return self._split(points, members[:half]) + self._split(points, members[half:])

    def search(self, point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that the bound cannot exclude, and their bounds."""
        p = self.percent
        least, most = -(-p * size // 100), 100 * size // p
        at = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[k]
            bound = np.minimum(corner[at], point).sum(axis=1)
            fits = (high[at] >= least) & (low[at] <= most) & ((100 + p) * bound >= p * (size + np.maximum(low[at], least)))
            at, bound = at[fits], bound[fits]
            if k:
                fan = LEAF if k == 1 else FAN
                at = (at[:, None] * fan + np.arange(fan)).ravel()
                at = at[at < len(self.levels[k - 1][0])]
        return self.order[at], bound


def partners(points: np.ndarray, sizes: np.ndarray, docs: np.ndarray, roots: np.ndarray, firsts: np.ndarray, percent: int, begin: int, end: int) -> tuple[list[tuple[int, int]], bool]:
    """Possible links between different components of one bucket; whether there are more.

    Everyone outside the component that was the largest in the first round (by `firsts`,
    the roots then) searches the tree and gives out its candidates at the places `begin`
    to `end`, closest first.  The places do not depend on the components and who searches
    has always searched, so that rounds over one place after another meet every
    candidate once.
    """
    tree = CountTree(points, sizes, percent)
    names, counts = np.unique(firsts, return_counts=True)
    main = roots[np.flatnonzero(firsts == names[counts.argmax()])[0]]
    out, more = [], False
    for i in np.flatnonzero(roots != main).tolist():
        found, bound = tree.search(points[i].astype(np.int64), int(sizes[i]))
        found = found[np.lexsort((docs[found], -bound / (sizes[found] + sizes[i])))]
        other = roots[found] != roots[i]
        more = more or bool(other[end:].any())
        out += [(min(docs[i], docs[j]), max(docs[i], docs[j])) for j in found[begin:end][other[begin:end]].tolist()]
    return out, more


def _searched(members: DataFrame, percent: int, begin: int, end: int) -> DataFrame:
    """`key, a, b, more` from all cells of buckets: members of a cell follow each other."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell: tuple | None = None

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            points = np.frombuffer(b"".join(t.column("point").to_pylist()), "<u4").reshape(-1, DIMENSIONS)
            pairs, more = partners(points, t.column("n_shingles").to_numpy(), t.column("doc_id").to_numpy(), t.column("root").to_numpy(), t.column("first").to_numpy(), percent, begin, end)
            pairs = pairs or ([(None, None)] if more else [])
            return pa.record_batch([pa.array([cell[0]] * len(pairs), pa.int64()), pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64()), pa.array([more] * len(pairs), pa.bool_())], ["key", "a", "b", "more"])

        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy() for c in ("key", "x", "y")], axis=1)
            starts = np.concatenate([[0], np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1, [len(cells)]]) if len(cells) else []
            for s, e in zip(starts[:-1], starts[1:]):
                if cell != (now := tuple(cells[s].tolist())) and held:
                    yield flush()
                    held = []
                cell = now
                held.append(batch.slice(int(s), int(e - s)))
        if held:
            yield flush()

    ordered = members.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "doc_id")
    return ordered.mapInArrow(search, "key bigint, a bigint, b bigint, more boolean")


def at_home(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """`a, b, home`: the pairs and the groups they are verified in.

    Pairs go to the home of `b`, that of its smallest partner, so a group of near
    copies is mostly in one place and each of its sets is sent once.  A smallest
    partner with many others has several homes.
    """
    n = pairs.count()
    weights = points.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("weight"))
    near = weights.join(sent(packed(pairs.groupBy("b").agg(F.min("a").alias("near")), n), n), "b")
    load = staged(packed(near.groupBy("near").agg(F.sum("weight").alias("load")), n), "loads")
    total = load.agg(F.coalesce(F.sum("load"), F.lit(0)).alias("n")).first()["n"]
    most = min(HOME, max(HOME // 40, total // int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    piece = F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / most))
    homes = near.join(sent(load, n), "near").select("b", F.pmod(F.xxhash64("near", piece), F.lit(total // most + 1)).alias("home"))
    return packed(pairs.join(sent(homes, n), "b").select("a", "b", "home"), n)


def verified(pairs: DataFrame, points: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int, percent: int, fold: np.ndarray) -> DataFrame:
    """The pairs (a, b) whose sets, made again from the texts, are similar enough.

    Sets are sent to the homes of their pairs and written nowhere else.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams, sizes = sets_of(words(batch.column("text"), VISIBLE, fold), batch.num_rows, size)
            ends = np.cumsum(sizes)
            own = pa.array([grams[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), batch.column("home"), own], ["doc_id", "home", "set"])

    def compare(sets: pa.Table, near: pa.Table) -> pa.Table:
        held: dict[int, list[np.ndarray]] = {}
        for doc, x in zip(sets.column("doc_id").to_pylist(), sets.column("set")):
            held.setdefault(doc, []).append(np.frombuffer(x.as_buffer(), np.uint64))

        def linked(left: np.ndarray, right: np.ndarray) -> bool:
            both = np.concatenate([left, right])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            return 100 * shared >= percent * (len(both) - shared)

        a, b = near.column("a").to_pylist(), near.column("b").to_pylist()
        keep = [any(linked(x, y) for x in held[i] for y in held[j]) for i, j in zip(a, b)]
        return near.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    placed = staged(at_home(pairs, points), "placed")
    rows = 2 * placed.count()
    ids = staged(packed(placed.select("home", F.explode(F.array("a", "b")).alias("doc_id")).distinct(), rows), "candidates")
    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    few = F.broadcast(ids) if ids.count() <= IDS_TO_SEND else ids
    sets = named.join(few, "doc_id").select("doc_id", "home", "text").mapInArrow(make, "doc_id bigint, home bigint, set binary")
    return sets.groupBy("home").cogroup(placed.groupBy("home")).applyInArrow(compare, "a bigint, b bigint")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs that the sums of coordinate minima cannot exclude, of points and then of fine points."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, DIMENSIONS).astype(np.int64)
            left, right = side("point_a"), side("point_b")
            n = left.sum(axis=1) + right.sum(axis=1)
            fits = (100 + percent) * np.minimum(left, right).sum(axis=1) >= percent * n
            for i in np.flatnonzero(fits).tolist():
                fits[i] = may_link(batch.column("fine_a")[i].as_py(), batch.column("fine_b")[i].as_py(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    n = pairs.count()
    side = lambda end: points.select(F.col("doc_id").alias(end), F.col("point").alias(f"point_{end}"), F.col("fine").alias(f"fine_{end}"))
    if n <= ROWS_TO_SEND:  # then only the points of these pairs are shuffled
        met = side("a").join(F.broadcast(pairs), "a").join(side("b").join(F.broadcast(pairs), "b"), ["a", "b"])
    else:
        met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = packed(met.select("a", "b", "point_a", "point_b", "fine_a", "fine_b"), n)
    return packed(met.mapInArrow(bound, "a bigint, b bigint").distinct(), n)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, lower: bool = True, block: int = BLOCK) -> DataFrame:
    """`doc_id, n_shingles, component_id` of every row: the smallest doc_id that links of at least `percent` reach."""
    fold = LOWER if lower else SAME
    table = staged(sketches(docs, doc_id, text, size, fold), "sketches")
    filled = table.where("n_shingles > 0")
    classes = staged(filled.groupBy("sig_a", "sig_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    ids = classes.select(F.col("rep").alias("doc_id")).where("doc_id is not null").distinct()
    points = staged(filled.join(ids, "doc_id", "left_semi").select("doc_id", "n_shingles", "point", "fine"), "points")

    keyed = keyed_documents(docs, ids, doc_id, text, size, percent, fold).repartition("key")
    buckets = keyed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("members")).where("low <> high")
    members = staged(keyed.join(buckets.hint("shuffle_hash"), "key").select("key", "doc_id", "low", "members"), "buckets")

    same = lambda pairs: verified(pairs, points, docs, doc_id, text, size, percent, fold)
    tested = staged(members.where("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct(), "met")
    links = staged(same(staged(_bounded(tested, points, percent), "pairs")), "links")
    roots = components(links)
    firsts, n_firsts = roots.select(F.col("node").alias("doc_id"), F.col("root").alias("first")), roots.count()

    begin, end = 0, 1
    crowd = members.where("members > 2").select("key", "doc_id")
    while True:
        rows, n_roots = crowd.count(), roots.count()
        now = sent(roots.select(F.col("node").alias("doc_id"), "root"), n_roots)
        placed = crowd.join(now, "doc_id", "left").join(sent(firsts, n_firsts), "doc_id", "left").withColumns({"root": F.coalesce("root", "doc_id"), "first": F.coalesce("first", "doc_id")})
        mixed_ = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("rows")).where("r0 <> r1").select("key", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
        mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
        cells = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        spread = placed.join(sent(packed(mixed_, rows), rows), "key").withColumn("mine", mine).withColumn("other", cells)
        spread = spread.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "doc_id", "root", "first")
        found = staged(_searched(spread.join(points.drop("fine"), "doc_id"), percent, begin, end), "partners")
        given = found.count()
        unfinished = staged(packed(found.where("more").select("key").distinct(), given), "unfinished")
        many = unfinished.count()
        fresh = packed(found.where("a is not null").select("a", "b").distinct(), given)
        fresh = staged(packed(fresh.join(tested, ["a", "b"], "left_anti"), given), "pairs")
        if not fresh.isEmpty():
            tested = tested.unionByName(fresh)
            links = staged(same(staged(_bounded(fresh, points, percent), "pairs")), "links")
            roots = roots if links.isEmpty() else extended(roots, links)
        elif not many:
            break
        # components only grow: a bucket without further candidates for others never gets any
        crowd = members.join(F.broadcast(unfinished) if many <= IDS_TO_SEND else unfinished, "key", "left_semi").select("key", "doc_id")
        begin, end = end, end * 8

    named = classes.join(roots, classes["rep"] == roots["node"], "left").select("sig_a", "sig_b", "n_shingles", F.coalesce("root", "rep").alias("class_root"))
    joined = table.join(named, ["sig_a", "sig_b", "n_shingles"], "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("class_root", "doc_id").alias("component_id"))
