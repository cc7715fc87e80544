"""Token ids of whole texts by public vocabularies, each distinct stretch of text encoded once.

The vocabularies never merge across the borders used here, so that the ids of a
text are the ids of its stretches one after the other.  Byte-level BPE starts a
token at the last blank before a word; stretches begin there.  The other two drop
white space or treat each word alone; their stretches are words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidewater.llm.words import VISIBLE, hashes, spans, text_buffer

MOST_STRETCHES = 1_200_000  # remembered by a worker
MOST_IDS = 8_000_000
SLICE = 1 << 20  # bytes of text encoded at once: what is made on the way takes some fifty times as much, in every worker

_BLANK = ~VISIBLE
#: Bytes that surely begin something else than white space: ASCII, or a lead byte of no white space beyond ASCII.
_SURE = np.array([bool(VISIBLE[b]) and b not in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])


def vocabulary(name: str) -> str:
    """The place of a public vocabulary; a name with a folder is a place already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """`encode(texts)` gives the ids of all rows and where each row's ids begin."""

    def __init__(self, name: str):
        path = vocabulary(name)
        self.pieces = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = False
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = True  # their strings in a text are ordinary text
            self.whole = self.model.encode(" a", add_special_tokens=False).ids != self.model.encode("a", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.place = np.zeros(0, np.int64)  # of each, its entry in begin and length
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def stretches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.whole:
            return spans(data, offsets, VISIBLE)
        if not len(data):
            return spans(data, offsets, VISIBLE)
        cut = np.zeros(len(data), bool)
        cut[:-1] = _BLANK[data[:-1]] & _SURE[data[1:]]
        first = offsets[:-1][offsets[:-1] < len(data)]
        cut[first[first > 0] - 1] = False  # what follows belongs to another row
        cut[first] = True
        start = np.flatnonzero(cut)
        return start, np.append(start[1:], len(data)), np.searchsorted(offsets, start, "right") - 1

    def _fresh(self, texts: list[str]) -> list:
        if self.pieces is not None:
            return self.pieces.encode(texts, num_threads=1)
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each stretch; new ones are encoded and remembered."""
        key = hashes(data, start, end)
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MOST_STRETCHES or len(self.ids) > MOST_IDS:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        seen = np.zeros(len(distinct), bool)
        within = at < len(self.known)
        seen[within] = self.known[at[within]] == distinct[within]
        new = np.flatnonzero(~seen)
        slot = np.empty(len(distinct), np.int64)
        slot[seen] = self.place[at[seen]]
        if len(new):
            raw = data.tobytes()
            found = self._fresh([raw[s:e].decode("utf-8", "replace") for s, e in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
            slot[new] = len(self.begin) + np.arange(len(new))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(sizes) - sizes])
            self.length = np.concatenate([self.length, sizes])
            self.ids = np.concatenate([self.ids, flat])
            self.known = np.insert(self.known, at[new], distinct[new])
            self.place = np.insert(self.place, at[new], slot[new])
        return slot[back]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (uint32), and where each row's begin (one more at the end); a null text has none."""
        data, offsets = text_buffer(column)
        start, end, doc = self.stretches(data, offsets)
        slot = self._slots(data, start, end)
        sizes = self.length[slot]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.begin[slot] - (ends - sizes), sizes)]
        before = np.concatenate([[0], ends])
        return ids, before[np.searchsorted(doc, np.arange(len(offsets)))]

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Ids per row."""
        data, offsets = text_buffer(column)
        start, end, doc = self.stretches(data, offsets)
        slot = self._slots(data, start, end)
        sizes = self.length[slot]
        return np.bincount(doc, weights=sizes, minlength=len(offsets) - 1).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]
