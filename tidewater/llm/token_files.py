"""Token ids of a corpus in binary files of patched frame-of-reference blocks.

A block holds BLOCK ids: their minimum is subtracted, the rest packed at the bit
width that a given percentile of them needs, and the ids that need more are kept
in an exception list.  A file has a directory of its documents and an index of
block starts, so that a range of ids is read without the rest.  Files hold whole
documents in ascending doc_id order; the order of files is that of their names.

A null text is empty: its document is the end id alone.  A null doc_id comes
first; rows with one doc_id are ordered by a hash of their text and stay apart.
An empty table gives no files and no rows.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.encoders import encoder
from tidewater.llm.storage import staged
from tidewater.llm.words import slices
from tidewater.session import scratch_path

BLOCK = 1024
PERCENTILE = 90
FILE_IDS = 4_000_000

_HEAD = struct.Struct("<4sIQQI")  # magic, block size, documents, ids, blocks
_BLOCK_HEAD = struct.Struct("<IBxH")  # minimum, width, exceptions
_MAGIC = b"PFR1"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2^width as rows of bytes, lowest bit first."""
    bits = ((values[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _unpacked(rows: np.ndarray, width: int, count: int) -> np.ndarray:
    bits = np.unpackbits(rows, axis=1, count=count * width, bitorder="little").reshape(len(rows), count, width)
    out = np.zeros((len(rows), count), np.uint32)
    for k in range(width):
        out |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
    return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of `block` ids, the last one shorter."""
    out: list[bytes] = [b""] * -(-len(ids) // block)
    full = len(ids) // block
    groups = [(np.arange(full), ids[: full * block].reshape(full, block))]
    if len(ids) > full * block:
        groups.append((np.array([full]), ids[full * block :][None, :]))
    for numbers, rows in groups:
        if not len(rows):
            continue
        least = rows.min(axis=1)
        rest = rows - least[:, None]
        wanted = np.partition(rest, (at := min(rest.shape[1] - 1, int(rest.shape[1] * percentile / 100))), axis=1)[:, at]
        widths = _widths(wanted)
        for width in np.unique(widths).tolist():
            picked = np.flatnonzero(widths == width)
            for part in np.array_split(picked, -(-len(picked) // 256)):
                over = rest[part] >> np.uint32(width) > 0 if width < 32 else np.zeros(rest[part].shape, bool)
                body = _packed(np.where(over, 0, rest[part]).astype(np.uint32), width) if width else np.zeros((len(part), 0), np.uint8)
                for j, i in enumerate(part.tolist()):
                    at_ = np.flatnonzero(over[j])
                    out[int(numbers[i])] = _BLOCK_HEAD.pack(int(least[i]), width, len(at_)) + body[j].tobytes() + at_.astype("<u2").tobytes() + rest[i][at_].astype("<u4").tobytes()
    return out


def decode_blocks(data: memoryview, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts` and hold `sizes` ids."""
    out = np.zeros(int(sizes.sum()), np.uint32)
    begin = np.cumsum(sizes) - sizes
    heads = [_BLOCK_HEAD.unpack_from(data, int(s)) for s in starts]
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, (_, width, _) in enumerate(heads):
        kinds.setdefault((width, int(sizes[i])), []).append(i)
    raw = np.frombuffer(data, np.uint8)
    for (width, count), members in kinds.items():
        n = -(-count * width // 8)
        for at in range(0, len(members), 256):
            part = members[at : at + 256]
            places = starts[part].astype(np.int64) + _BLOCK_HEAD.size
            values = _unpacked(raw[places[:, None] + np.arange(n)], width, count) if width else np.zeros((len(part), count), np.uint32)
            for j, i in enumerate(part):
                least, _, k = heads[i]
                if k:
                    where = int(places[j]) + n
                    values[j, np.frombuffer(data, "<u2", k, where)] = np.frombuffer(data, "<u4", k, where + 2 * k)
                out[begin[i] : begin[i] + count] = values[j] + np.uint32(least)
    return out


def file_bytes(doc_ids: list, sizes: list[int], ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    blocks = encode_blocks(ids, block, percentile)
    head = _HEAD.pack(_MAGIC, block, len(doc_ids), len(ids), len(blocks))
    directory = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is not None for d in doc_ids], "u1").tobytes() + np.array(sizes, "<u8").tobytes()
    begin = len(head) + len(directory) + 8 * (len(blocks) + 1)
    index = (begin + np.concatenate([[0], np.cumsum([len(b) for b in blocks])])).astype("<u8").tobytes()
    return b"".join([head, directory, index, *blocks])


class TokenFile:
    """A file's directory and index; `ids(a, b)` decodes only the blocks that hold those ids."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.block, docs, self.n_ids, blocks = _HEAD.unpack_from(self.data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        known = np.frombuffer(self.data, "u1", docs, at + 8 * docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(self.data, "<i8", docs, at), known)]
        self.sizes = np.frombuffer(self.data, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.starts = np.frombuffer(self.data, "<u8", blocks + 1, at + 17 * docs).astype(np.int64)

    def ids(self, begin: int, end: int) -> np.ndarray:
        first, last = begin // self.block, -(-end // self.block)
        sizes = np.minimum(self.block, self.n_ids - np.arange(first, last) * self.block)
        return decode_blocks(self.data, self.starts[first:last], sizes)[begin - first * self.block : end - first * self.block]


FILES = "part int, number int, path string, n_docs bigint, n_ids bigint"


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "word_bpe_49k.json", end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write all documents below `folder`; returns the files, in order of (part, number).

    A task's files are written beside their place and then moved there, with names and
    bytes that a repeated task makes alike.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, where = _filesystem(folder)
        part = TaskContext.get().partitionId()
        doc_ids: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        total = number = 0

        def close() -> pa.RecordBatch:
            name = f"{where}/{part:06d}-{number:06d}.pfr"
            store.create_dir(where, recursive=True)
            with store.open_output_stream(draft := f"{name}.{uuid.uuid4().hex}") as out:
                out.write(file_bytes(doc_ids, sizes, np.concatenate(held)))
            store.move(draft, name)
            path = f"{folder}/{part:06d}-{number:06d}.pfr"
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([path]), pa.array([len(doc_ids)], pa.int64()), pa.array([total], pa.int64())], ["part", "number", "path", "n_docs", "n_ids"])

        for batch in slices(batches, "text"):
            ids, begin = encoder(vocabulary).encode(batch.column("text"))
            for i, d in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[begin[i] : begin[i + 1]], np.uint32(end_id))
                if total and total + len(own) > file_ids:
                    yield close()
                    number += 1
                    doc_ids, sizes, held, total = [], [], [], 0
                doc_ids.append(d)
                sizes.append(len(own))
                held.append(own)
                total += len(own)
        if doc_ids:
            yield close()

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = named.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return staged(ordered.select("doc_id", "text").mapInArrow(write, FILES), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of each document, from the files; one task holds one file at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                store, where = _filesystem(path)
                with store.open_input_file(where) as source:
                    file = TokenFile(source.read())
                ids = file.ids(0, file.n_ids).astype("<u4")
                ends = np.cumsum(file.sizes)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), file.sizes.tolist())]
                yield pa.record_batch([pa.array(file.doc_ids, pa.int64()), pa.array(before + ends - file.sizes), pa.array(file.sizes), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    spread = placed.select("path", "before").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return scratch_path(spark, "tokens")
