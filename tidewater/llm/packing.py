"""Packing documents into training windows: cut what is too long, then best fit, longest pieces first.

Documents are encoded where they are read; only piece sizes are shuffled.  Pieces
are dealt out evenly into shards of at most about SHARD pieces and each shard is
packed by one task, so at most a few windows per shard stay open.

A null text is empty: its document is the end id alone.  Repeated rows are packed
as often as they occur, a null doc_id stays null, an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.encoders import SLICE, encoder
from tidewater.llm.storage import staged
from tidewater.llm.words import slices

WINDOW = 2048
SHARD = 40_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.json", end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Encode, append the end id, and cut each document into full windows and a rest: columns of PIECES."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            ids, begin = encoder(vocabulary).encode(batch.column("text"))
            rows: list[tuple[int, int, int, int, int]] = []
            for i in range(batch.num_rows):
                own = np.append(ids[begin[i] : begin[i + 1]], np.uint32(end_id)).astype("<u4")
                rows += [(i, at, len(own[at : at + window]), zlib.crc32(own[at : at + window].tobytes()), len(own)) for at in range(0, len(own), window)]
            table = np.array(rows, np.int64)
            yield pa.record_batch([batch.column("doc_id").take(pa.array(table[:, 0])), *[pa.array(table[:, k]) for k in range(1, 5)]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


class OpenWindows:
    """A segment tree over remaining capacities: the tightest open window that still takes a piece.

    Leaf c counts the open windows with c places left, an inner node those below it.
    """

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, number: int) -> None:
        self.windows[capacity].append(number)
        self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) with the smallest capacity of at least `least`."""
        node = self.size + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up until an open window lies to the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The window of each piece (from 0) and its place there; pieces of equal length go by their order."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, made = OpenWindows(window), 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = sizes[i]
        if found := opened.take(n):
            left, at = found
        else:
            left, at = window, made
            made += 1
        number[i], offset[i] = at, window - left
        if left > n:
            opened.put(left - n, at)
    return number, offset


def pack(pieces: DataFrame, length: str = "length", window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces of 1 to `window` tokens; other columns stay as they are.

    The shards are dealt out row by row, so that a document repeated often fills no
    shard alone.  `pieces` should be a stored table: it is counted first.
    """
    shards = max(1, -(-pieces.count() // shard))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        number, offset = best_fit_decreasing(table.column(length).to_numpy(), window)
        number = number * shards + TaskContext.get().partitionId()
        table = table.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))
        yield from table.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.repartition(shards).mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def packed_documents(docs: DataFrame, window: int = WINDOW, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1, shard: int = SHARD) -> DataFrame:
    """All documents cut and packed; the pieces are stored once, without their ids."""
    pieces = staged(cut_pieces(docs, vocabulary=vocabulary, end_id=end_id, window=window), "pieces")
    return pack(pieces, window=window, shard=shard)


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences, tokens and padding: a sequence is filled up to the window unless its size is a power of two."""
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    fill = F.when(F.bit_count("n") == 1, F.lit(0)).otherwise(window - F.col("n"))
    return sizes.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(fill).alias("padding"))
