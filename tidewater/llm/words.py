"""Words of Arrow text columns as numpy arrays: places and 64-bit hashes, without a Python loop over words.

A hash stands for its word.  Two different words share one with a probability of
2^-64 per pair; where that matters the caller compares the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text worked on at once
_SPAN = 1 << 20  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(accept) -> np.ndarray:
    return np.array([bool(accept(b)) for b in range(256)])


#: Bytes of words that white space (blank, tab to carriage return) separates.
VISIBLE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words of digits, letters and everything beyond ASCII; case is folded first.
LETTERS = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A)
#: A-Z to a-z.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
SAME = np.arange(256, dtype=np.uint8)


@dataclass
class Words:
    start: np.ndarray  # byte places in the buffer
    end: np.ndarray
    doc: np.ndarray  # the row each word belongs to
    hash: np.ndarray


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after the other, and where each row begins (one more at the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text, whole rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _grown(table: np.ndarray, factor: int, size: int) -> np.ndarray:
    if len(table) >= size:
        return table
    powers = np.full(max(size, _SPAN + 1), factor, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in a copy)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """A hash of the folded bytes of each span; spans are in order and do not overlap."""
    global _powers, _inverses
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        upto = max(at + 1, int(np.searchsorted(end, low + _SPAN, "right")))
        size = int(end[upto - 1]) - low
        _powers, _inverses = _grown(_powers, _BASE, size), _grown(_inverses, _INVERSE, size)
        values = fold[data[low : low + size]].astype(np.uint64)
        values += np.uint64(1)
        values *= _powers[:size]
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        s, e = start[at:upto] - low, end[at:upto] - low
        out[at:upto] = (total[e] - total[s]) * _inverses[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        at = upto
    return mixed(out)


def spans(data: np.ndarray, offsets: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of accepted bytes inside each row: start, end, row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = accept[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | border[1:-1]
    closes[:-1] &= ~inside[1:] | border[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def words(column: pa.Array, accept: np.ndarray = VISIBLE, fold: np.ndarray = SAME) -> Words:
    data, offsets = text_buffer(column)
    start, end, doc = spans(data, offsets, accept)
    return Words(start, end, doc, hashes(data, start, end, fold))


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a row, and the index of each run's first word."""
    n = len(w.doc) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    return run_hashes(w.hash, first, size), first


def run_hashes(hashes_: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(first), np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes_[first + i]
    return mixed(out + np.uint64(size))


def joint_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the values in each span, in their order; spans may overlap."""
    global _powers, _inverses
    _powers, _inverses = _grown(_powers, _BASE, len(values)), _grown(_inverses, _INVERSE, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values) * _powers[: len(values)], out=total[1:])
    return mixed((total[end] - total[start]) * _inverses[start] + (end - start).astype(np.uint64))


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given spans one after the other, and where each begins (one more at the end)."""
    sizes = end - start
    places = np.zeros(len(start) + 1, np.int64)
    np.cumsum(sizes, out=places[1:])
    return data[np.arange(places[-1]) + np.repeat(start - places[:-1], sizes)], places


def strings(data: np.ndarray, places: np.ndarray) -> pa.Array:
    """Bytes of whole characters as an Arrow column."""
    return pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data))


def bounds(doc: np.ndarray, rows: int) -> np.ndarray:
    """Where the words of each row begin; one more at the end."""
    return np.searchsorted(doc, np.arange(rows + 1))
