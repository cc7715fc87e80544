"""Product codes of vectors: each part of a vector is replaced by the index of a codebook entry near it.

Components become whole numbers, `floor(scale * x)`, and a vector is cut into equal
consecutive parts (zeros fill the last one).  The codebooks start as the parts of
the first vectors by id and improve in rounds: every part goes to its nearest
entry (ties to the lower index), and an entry becomes the floored mean of its
parts; an entry without parts stays.

A task keeps the distinct parts of its vectors with their multiplicities, sorted,
which makes each position's parts a trie of dimensions.  It is walked depth first:
a node adds its dimension to the distances that its prefix has to all entries, so
parts that begin alike share that work; the leaves take the nearest entry and add
their weights to its sums.  Copies of a vector, however many, are one leaf a task,
and only sums (entries x dimensions) leave a task, so nothing is shuffled by key.

Dropped: null vectors, empty ones, those that hold null, NaN or infinite
components, and those whose length is not that of the first kept id.  A null id
comes after all others; equal ids are ordered by their vectors.  Repeated rows
count each.  An empty table gives no rows.  Whole numbers end at +-2^62; sums past
64 bits are exact, and an error past 64 bits is cut to the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.storage import staged
from tidewater.operators.skew import lookup_join

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
HELD = 1 << 16  # distinct parts of one position that a task holds before it writes them
LEAVES = 1 << 12  # leaves of a subtree that is walked level by level
END = 1 << 62
LARGEST = (1 << 63) - 1
_NARROW = 1 << 24  # components up to here: no sum of squares of 8192 dimensions passes 64 bits


@dataclass
class Codebooks:
    """`entries[part]`: the whole numbers of that part's entries, one row each."""

    entries: list[np.ndarray]
    length: int  # dimensions of a vector; a last part may reach beyond it

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def numbers(self) -> list[int]:
        return [int(x) for table in self.entries for x in table.reshape(-1)]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.numbers())).encode()).hexdigest()


def _rows(table: np.ndarray) -> np.ndarray:
    """Where each row begins that differs from the one before, in sorted rows."""
    new = np.ones(len(table), bool)
    new[1:] = (table[1:] != table[:-1]).any(axis=1)
    return np.flatnonzero(new)


def distinct_parts(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order and their summed weights."""
    order = np.lexsort(values.T[::-1])
    values = values[order]
    weights = np.ones(len(values), np.int64) if weights is None else weights[order]
    first = _rows(values)
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


def nearest(values: np.ndarray, book: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row and its squared distance; rows that begin alike stand together.

    A walk over the trie of the rows, depth first: (dimension, first row, last row,
    distances of the common prefix to all entries).  A subtree of few leaves is
    done level by level at once.  Equal prefixes that do not stand together are
    only worked out again.
    """
    n, width = values.shape
    if max(np.abs(values).max(initial=0), np.abs(book).max(initial=0)) > _NARROW:
        values, book = values.astype(object), book.astype(object)
    code, distance = np.zeros(n, np.int64), np.zeros(n, values.dtype)
    stack = [(0, 0, n, np.zeros(len(book), values.dtype))] if n else []
    while stack:
        depth, low, high, shared = stack.pop()
        if high - low <= leaves or depth == width:
            near = shared[None, :]
            node = np.zeros(high - low, np.int64)  # the prefix that each leaf goes through
            for d in range(depth, width):
                x = values[low:high, d]
                opens = np.ones(high - low, bool)
                opens[1:] = (node[1:] != node[:-1]) | (x[1:] != x[:-1])
                at = np.flatnonzero(opens)
                off = x[at, None] - book[None, :, d]
                near = near[node[at]] + off * off
                node = np.cumsum(opens) - 1
            best = near.argmin(axis=1)
            code[low:high] = best[node]
            distance[low:high] = near[np.arange(len(best)), best][node]
            continue
        x = values[low:high, depth]
        ends = np.append(np.flatnonzero(x[1:] != x[:-1]) + 1, high - low)  # of the children
        children, at = [], 0
        while at < high - low:
            reach = int(np.searchsorted(ends, at + leaves, "right"))
            upto = int(ends[reach - 1]) if reach else at
            if upto > at:  # small children that stand together
                children.append((depth, low + at, low + upto, shared))
            else:
                upto = int(ends[np.searchsorted(ends, at, "right")])
                off = x[at] - book[:, depth]
                children.append((depth + 1, low + at, low + upto, shared + off * off))
            at = upto
        stack += reversed(children)
    return code, distance


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """`floor(scale * x)` as long, cut at +-2^62."""
    return np.clip(np.floor(vectors.astype(np.float64) * scale), -float(END), float(END)).astype(np.int64)


def _cut(matrix: np.ndarray, parts: int) -> np.ndarray:
    """(vectors, parts, width)"""
    width = -(-matrix.shape[1] // parts)
    if width * parts > matrix.shape[1]:
        matrix = np.concatenate([matrix, np.zeros((len(matrix), width * parts - matrix.shape[1]), np.int64)], axis=1)
    return matrix.reshape(len(matrix), parts, width)


def _lists(table: np.ndarray) -> pa.Array:
    places = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(np.ascontiguousarray(table).reshape(-1)))


def _usable(df: DataFrame, vector: str, length: int | None = None) -> DataFrame:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity
    usable = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    return usable if length is None else usable.where(F.size(vector) == length)


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            piece = batch.slice(at, 8192)
            flat = pc.list_flatten(piece.column("vector")).to_numpy(zero_copy_only=False)
            yield piece, flat.reshape(piece.num_rows, length)


def part_tries(vectors: DataFrame, length: int, parts: int, scale: int, held: int = HELD) -> DataFrame:
    """`part, value, weight`: each task's distinct parts, sorted, in runs of at most about `held` rows a part."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        own: list[tuple[np.ndarray, np.ndarray] | None] = [None] * parts

        def merge() -> None:
            cubes = _cut(np.concatenate(waiting), parts)
            waiting.clear()
            for p in range(parts):
                more = distinct_parts(cubes[:, p, :])
                own[p] = more if own[p] is None else distinct_parts(np.concatenate([own[p][0], more[0]]), np.concatenate([own[p][1], more[1]]))

        def give(p: int) -> pa.RecordBatch:
            values, weights = own[p]
            own[p] = None
            return pa.record_batch([pa.array(np.full(len(values), p, np.int32)), _lists(values), pa.array(weights)], ["part", "value", "weight"])

        for _, matrix in _matrices(batches, length):
            waiting.append(whole_numbers(matrix, scale))
            if sum(map(len, waiting)) >= held // 2:
                merge()
                yield from (give(p) for p in range(parts) if len(own[p][0]) >= held)
        if waiting:
            merge()
        yield from (give(p) for p in range(parts) if own[p] is not None)

    return vectors.mapInArrow(distinct, "part int, value array<bigint>, weight bigint")


def _sums(tries: DataFrame, books: Codebooks) -> DataFrame:
    """`part, entry, n, total`: what every entry got, added up in the tasks and then by Spark."""
    parts, width = len(books.entries), books.width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [[0] * len(t) for t in books.entries]
        total = [[[0] * width for _ in t] for t in books.entries]
        for batch in batches:
            part = batch.column("part").to_numpy()
            values = pc.list_flatten(batch.column("value")).to_numpy().reshape(-1, width)
            weights = batch.column("weight").to_numpy()
            for p in np.unique(part).tolist():
                mine = part == p
                v, w = values[mine], weights[mine]
                code, _ = nearest(v, books.entries[p])
                wide = int(np.abs(v).max(initial=0)) * int(w.sum()) >= END
                weighted = v.astype(object) * w.astype(object)[:, None] if wide else v * w[:, None]
                for e in np.unique(code).tolist():
                    own = code == e
                    count[p][e] += int(w[own].sum())
                    for d, x in enumerate(weighted[own].sum(axis=0).tolist()):
                        total[p][e][d] += int(x)
        rows = [(p, e, d) for p in range(parts) for e in range(len(count[p])) if count[p][e] for d in range(width)]
        yield pa.record_batch(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()),
             pa.array([count[p][e] for p, e, _ in rows], pa.int64()), pa.array([str(total[p][e][d]) for p, e, d in rows], pa.string())],
            ["part", "entry", "at", "n", "total"])

    found = tries.mapInArrow(add, "part int, entry int, at int, n bigint, total string")
    return found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def fit(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks of all usable vectors; None without any.

    The driver holds parts x entries x width numbers (one codebook) and the first
    `entries` vectors, whatever the table's size.
    """
    named = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    first = _usable(named, "vector").orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = len(first[0]["vector"])
    usable = _usable(named, "vector", length)
    seeds = np.array([r["vector"] for r in usable.orderBy(*order).limit(entries).collect()], np.float64)
    books = Codebooks([np.ascontiguousarray(c) for c in _cut(whole_numbers(seeds, scale), parts).transpose(1, 0, 2)], length)
    tries = staged(part_tries(usable.select("vector"), length, parts, scale), "part-tries")
    for _ in range(rounds):
        tables = [t.copy() for t in books.entries]
        for r in _sums(tries, books).toLocalIterator():
            tables[r["part"]][r["entry"], r["at"]] = int(r["total"]) // r["n"]
        books = Codebooks(tables, length)
    return books


def encoded(df: DataFrame, books: Codebooks, vec_id: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = (), scale: int = SCALE) -> DataFrame:
    """`vec_id, *keep, codes, error`: the entries of every usable vector and its squared distance from them."""
    parts, length = len(books.entries), books.length
    named = df.select(F.col(vec_id).alias("__id"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keep)], F.col(vector).alias("vector"))
    usable = _usable(named, "vector", length)
    kept = [f for f in usable.schema.fields if f.name != "vector"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, matrix in _matrices(batches, length):
            cube = _cut(whole_numbers(matrix, scale), parts)
            codes, error = np.zeros(cube.shape[:2], np.int64), np.zeros(len(cube), object)
            for p in range(parts):
                order = np.lexsort(cube[:, p, :].T[::-1])
                values = cube[order, p, :]
                at = _rows(values)
                code, distance = nearest(values[at], books.entries[p])
                leaf = np.cumsum(np.bincount(at, minlength=len(values))) - 1
                codes[order, p] = code[leaf]
                error[order] += distance[leaf].astype(object)
            short = np.minimum(error, LARGEST).astype(np.int64)
            yield pa.record_batch([*[piece.column(f.name) for f in kept], _lists(codes.astype(np.int32)), pa.array(short)], [*[f.name for f in kept], "codes", "error"])

    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    out = usable.mapInArrow(encode, f"{layout}, codes array<int>, error bigint")
    return out.withColumnsRenamed({"__id": vec_id, **{f"__k{i}": k for i, k in enumerate(keep)}})


def decoded(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """Adds `vector`: the entries that the codes name, as numbers again."""
    table = F.lit([[[float(x) / scale for x in entry] for entry in t] for t in books.entries])
    pieces = F.transform("codes", lambda c, p: F.element_at(F.element_at(table, p + 1), c + 1))
    return codes.withColumn("vector", F.slice(F.flatten(pieces), 1, books.length))


def hex_code(codes: str = "codes") -> F.Column:
    """Two lower-case hex digits for each part."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """Adds `label_error`, the summed error of the rows with the same label (nulls together); rows must be stored already."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")
    key = F.to_json(F.struct(F.col(label)))  # nulls meet
    totals = staged(codes.groupBy(key.alias("__label")).agg(total.alias("label_error")), "label-errors")
    return lookup_join(codes.withColumn("__label", key), totals, "__label").drop("__label")
