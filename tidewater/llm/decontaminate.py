"""Benchmark passages in documents: a prefix-filtered join of word shingles, verified over item-sized windows.

Every item is cut into windows of WINDOW consecutive words (a shorter item is one
window).  A window's set are its SHINGLE-word shingles.  An occurrence contains
all of them, so one necessary shingle is enough as its prefix: the rarest, by
counts over all documents.  The documents give the places of prefix shingles
(found through a Bloom filter, which only saves rows), the join brings them
together with their windows, the length and position of the window in the
document are bounded, and the words themselves decide.

Words are compared as 64-bit hashes, one for each word of a window.  A null or
empty text has no words and no hits; items without words have no windows.  Hits
of an item without id count as hits, but not as items.  Repeated rows of either
table count each; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.storage import staged
from tidewater.llm.words import LETTERS, LOWER, Words, bounds, run_hashes, slices, words

WINDOW = 10
SHINGLE = 5
MOST_BITS = 1 << 30  # of the Bloom filter: 128 MB


def _list(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`item_id, words`: the distinct windows of each item, as word hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), LETTERS, LOWER)
            begin = bounds(w.doc, batch.num_rows)
            rows = [(i, w.hash[at : at + window].view(np.int64)) for i in range(batch.num_rows) for at in range(begin[i], max(begin[i] + 1, begin[i + 1] - window + 1)) if begin[i] < begin[i + 1]]
            rows = [(i, h[: begin[i + 1] - begin[i]]) for i, h in rows]
            if rows:
                ids = batch.column("item_id").take(pa.array([i for i, _ in rows]))
                yield pa.record_batch([ids, _list(np.concatenate([h for _, h in rows]), np.cumsum([len(h) for _, h in rows]))], ["item_id", "words"])

    named = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return named.mapInArrow(cut, "item_id string, words array<bigint>").distinct()


def _shingles(table: DataFrame, shingle: int) -> DataFrame:
    """`window, size, offset, token` of every shingle of every window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for number, held in zip(batch.column("window").to_pylist(), batch.column("words").to_pylist()):
                h = np.array(held, np.int64).view(np.uint64)
                size = min(shingle, len(h))
                tokens = run_hashes(h, np.arange(len(h) - size + 1), size).view(np.int64)
                out += [(number, size, i, int(t)) for i, t in enumerate(tokens)]
            cols = np.array(out, np.int64).reshape(-1, 4)
            yield pa.record_batch([pa.array(cols[:, 0]), pa.array(cols[:, 1].astype(np.int32)), pa.array(cols[:, 2].astype(np.int32)), pa.array(cols[:, 3])], ["window", "size", "offset", "token"])

    return table.mapInArrow(cut, "window bigint, size int, offset int, token bigint")


class Filter:
    """A Bloom filter of 64-bit tokens with two places each."""

    def __init__(self, bits: int):
        self.bits = bits
        self.field = np.zeros(bits // 8, np.uint8)

    def _places(self, tokens: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64(self.bits - 1)
        return [tokens & mask, (tokens >> np.uint64(33)) * np.uint64(0x9E3779B1) & mask]

    def add(self, tokens: np.ndarray) -> None:
        for p in self._places(tokens):
            np.bitwise_or.at(self.field, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def __contains__(self, _):
        raise TypeError("use found()")

    def found(self, tokens: np.ndarray) -> np.ndarray:
        """The index of each token that may be in the set."""
        a, b = self._places(tokens)
        hit = lambda p: self.field[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1
        first = np.flatnonzero(hit(a))
        return first[hit(b[first]) > 0]


def filter_of(tokens: DataFrame) -> Filter:
    """The filter of a column `token`; some tasks fill a filter each, the driver unites these few."""
    n = tokens.count()
    bits = min(MOST_BITS, 1 << max(16, (64 * n - 1).bit_length() if n else 16))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(bits)
        for batch in batches:
            own.add(batch.column("token").to_numpy().view(np.uint64))
        yield pa.record_batch([pa.array([own.field.tobytes()], pa.binary())], ["field"])

    out = Filter(bits)
    for row in tokens.select("token").coalesce(4).mapInArrow(fill, "field binary").toLocalIterator():
        out.field |= np.frombuffer(row["field"], np.uint8)
    return out


def _runs(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(w.doc) - size + 1
    first = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
    return run_hashes(w.hash, first, size), first


def token_counts(docs: DataFrame, text: str, sizes: list[int], wanted: Filter) -> DataFrame:
    """`token, n`: how often the wanted shingles (and few others) occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), LETTERS, LOWER)
            for size in sizes:
                tokens, _ = _runs(w, size)
                held, times = np.unique(tokens[wanted.found(tokens)], return_counts=True)
                yield pa.record_batch([pa.array(held.view(np.int64)), pa.array(times.astype(np.int64))], ["token", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, doc_id: str, text: str, sizes: list[int], wanted: Filter, window: int = WINDOW) -> DataFrame:
    """One row per document: `row, doc_id, n_words, found` with the places of the wanted shingles and the words around them."""
    ahead = window - 1
    around = np.arange(-ahead, window)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), LETTERS, LOWER)
            begin = bounds(w.doc, batch.num_rows)
            tokens, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for size in sizes:
                t, first = _runs(w, size)
                hit = wanted.found(t)
                tokens.append(t[hit])
                at.append(first[hit])
            token, place = np.concatenate(tokens), np.concatenate(at)
            order = np.argsort(place, kind="stable")
            token, place = token[order], place[order]
            near = place[:, None] + around
            own = (near >= 0) & (near < len(w.doc))
            context = np.where(own, w.hash[np.clip(near, 0, max(0, len(w.doc) - 1))] if len(w.doc) else 0, 0).astype(np.uint64)
            doc = w.doc[place]
            found = pa.StructArray.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(place - begin[doc]), _list(context.view(np.int64).ravel(), np.arange(1, len(place) + 1) * len(around))],
                ["token", "at", "context"],
            )
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            rows = row + np.arange(batch.num_rows, dtype=np.int64)
            row += batch.num_rows
            yield pa.record_batch([pa.array(rows), batch.column("doc_id"), pa.array(np.diff(begin)), pa.ListArray.from_arrays(pa.array(ends), found)], ["row", "doc_id", "n_words", "found"])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(docs.dtypes)[doc_id]
    return named.mapInArrow(find, f"row bigint, doc_id {kind}, n_words bigint, found array<struct<token:bigint,at:bigint,context:array<bigint>>>")


def occurrences(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """All documents (`row, doc_id, n_words`), and every occurrence of a window in them (`row, item_id, first, last`)."""
    cut = item_windows(items, item_id, item_text, window).withColumn("window", F.xxhash64("item_id", "words"))
    cut = staged(cut, "windows")
    grams = staged(_shingles(cut.select("window", "words"), shingle), "shingles")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most `shingle` numbers
    counts = token_counts(docs, text, sizes, filter_of(grams.select("token")))
    rarity = grams.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rarity.groupBy("window").agg(F.min(F.struct("n", "token", "offset")).alias("p")).where("p.n > 0")
    prefix = staged(rarest.join(cut, "window").select("item_id", "words", F.col("p.token").alias("token"), F.col("p.offset").alias("offset")), "prefixes")
    found = staged(places(docs, doc_id, text, sizes, filter_of(prefix.select("token")), window), "places")
    candidate = found.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    first, size = F.col("at") - F.col("offset"), F.size("words")
    met = candidate.join(prefix, "token").where((first >= 0) & (first + size <= F.col("n_words")))
    hits = met.where(F.slice("context", F.lit(window) - F.col("offset"), size) == F.col("words"))
    return found.select("row", "doc_id", "n_words"), hits.select("row", "item_id", first.alias("first"), (first + size - 1).alias("last"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: words, words inside occurrences, items that occur, and whether it is contaminated."""
    all_docs, hits = occurrences(docs, items, doc_id, text, item_id, item_text, window, shingle)
    hits = staged(hits, "hits")
    places_ = hits.groupBy("row", "first").agg(F.max("last").alias("last"))  # an occurrence that many items share is one place
    before = Window.partitionBy("row").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.max("last").over(before), F.lit(-1))
    new = places_.withColumn("new", F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, upto)))
    covered = new.groupBy("row").agg(F.sum("new").alias("n_hit"))
    held = hits.select("row", "item_id").distinct().groupBy("row").agg(F.count("item_id").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return (
        all_docs.join(covered, "row", "left")
        .join(held, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", none).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
