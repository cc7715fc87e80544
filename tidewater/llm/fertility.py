"""Quality rules on tokeniser fertility, with rejection bands per language or script.

Two public vocabularies read every text: characters per token of both, and of the
one with byte fallback the share of byte tokens and the entropy of the token
distribution.  Documents that lie far outside what their language usually shows
are rejected: symbols, capitals and noise break words into many short tokens,
repeated text has a low entropy for its length.

The bands come from the whole table: for each language (or script, where the
language is null) the quartiles of each measure, widened by FENCE times their
distance.  Every document has a band.  Quartiles of a group count as its documents,
those of the next wider group as LEAST_DOCS more: language, script, whole table.
So a rare language or one document more changes a band by little, and nothing
switches it off.  The quartiles come from documents of LEAST_TOKENS tokens and more
(from all, if none is so long); for a shorter document the distances grow with its
sampling error, as the root of LEAST_TOKENS by its tokens.  Entropy is compared
inside classes of sizes, whatever their size: language and class, script and class,
class, and the classes around it.

A null or empty text has no words: it fails the base rules.  Repeated rows are
judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.encoders import SLICE, encoder
from tidewater.llm.storage import staged
from tidewater.llm.words import VISIBLE, hashes, mixed, slices, spans, text_buffer, words, windows

LEAST_TOKENS = 128
LEAST_DOCS = 50
FENCE = 3.0
FALLBACK = "piece_bpe_32k.model"  # a vocabulary with byte fallback
SECOND = "byte_bpe_50k.json"
MEASURES = ("chars_per_token", "chars_per_token_2", "byte_share", "entropy")
BY_SIZE = ("entropy",)  # grows with the text, so it is compared among texts of a size

SYMBOLS = np.array([chr(b) in "#*$%&|<>" for b in range(256)])
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])
_ANY = np.array([b != 0x0A for b in range(256)])
#: Script by the first byte of a character.
_SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "east asian", "other")
_SCRIPT = np.full(256, -1)
for _first, _last, _number in ((0x41, 0x5A, 0), (0x61, 0x7A, 0), (0xC3, 0xC9, 0), (0xCD, 0xCF, 1), (0xD0, 0xD4, 2), (0xD7, 0xD7, 3), (0xD8, 0xDB, 4), (0xE0, 0xE0, 5), (0xE3, 0xED, 6), (0xF0, 0xF4, 7)):
    _SCRIPT[_first : _last + 1] = _number


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _combined(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mixed(values + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, repeated lines and words in repeated 5-word windows, per row."""
    data, offsets = text_buffer(column)
    rows = len(offsets) - 1
    per_row = lambda doc: np.bincount(doc, minlength=rows).astype(np.int64)
    w = words(column)
    start, end, doc = spans(data, offsets, _ANY)
    seen = np.concatenate([[0], np.cumsum(VISIBLE[data], dtype=np.int64)])
    filled = seen[end] > seen[start]
    start, end, doc = start[filled], end[filled], doc[filled]
    _, first = np.unique(_combined(hashes(data, start, end), doc), return_index=True)
    grams, at = windows(w, 5)
    _, back, times = np.unique(_combined(grams, w.doc[at]), return_inverse=True, return_counts=True)
    again = at[times[back] > 1]
    cover = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 5, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": per_row(w.doc),
        "word_chars": _per_row(_LEAD[data] & VISIBLE[data], offsets),
        "n_symbols": _per_row(SYMBOLS[data], offsets),
        "n_dup_lines": per_row(doc) - per_row(doc[first]),
        "n_repeat_words": per_row(w.doc[repeated]),
    }


def _scripts(column: pa.Array) -> list[str | None]:
    data, offsets = text_buffer(column)
    counts = np.stack([_per_row(_SCRIPT[data] == k, offsets) for k in range(len(_SCRIPTS))], axis=1)
    return [_SCRIPTS[int(c.argmax())] if c.any() else None for c in counts]


def token_measures(column: pa.Array, characters: np.ndarray, fallback: str = FALLBACK, second: str = SECOND) -> dict[str, np.ndarray]:
    """Tokens, characters per token, share of byte tokens and entropy in bits, per row."""
    model = encoder(fallback)
    ids, begin = model.encode(column)
    sizes = np.diff(begin)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    is_byte = np.array([model.pieces.is_byte(i) for i in range(model.pieces.get_piece_size())])
    pair, times = np.unique(doc.astype(np.int64) << 32 | ids, return_counts=True)
    own = pair >> 32
    n = np.maximum(sizes, 1)
    entropy = np.log2(n) - np.bincount(own, weights=times * np.log2(times), minlength=len(sizes)) / n
    return {
        "n_tokens": sizes.astype(np.int64),
        "chars_per_token": characters / n,
        "chars_per_token_2": characters / np.maximum(encoder(second).lengths(column), 1),
        "byte_share": np.bincount(doc[is_byte[ids]], minlength=len(sizes)) / n,
        "entropy": entropy,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fallback: str = FALLBACK, second: str = SECOND) -> DataFrame:
    """One row per document with the counts, the measures, its group (language or script) and its script."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            column = batch.column("text")
            counts = base_counts(column)
            found = token_measures(column, counts["word_chars"], fallback, second)
            scripts = _scripts(column)
            group = [lang or script for lang, script in zip(batch.column("lang").to_pylist(), scripts)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(group, pa.string()), pa.array(scripts, pa.string()), *[pa.array(v) for v in (*counts.values(), *found.values())]], ["doc_id", "kind", "script", *counts, *found])

    schema = "doc_id bigint, kind string, script string, " + ", ".join(f"{c} bigint" for c in (*COUNTS, "n_tokens")) + ", " + ", ".join(f"{m} double" for m in MEASURES)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return named.mapInArrow(measure, schema)


def _size_class() -> Column:
    return F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")


#: The least distance of quartiles: measures hardly vary in some groups.
_NARROWEST = {"chars_per_token": 0.1, "chars_per_token_2": 0.1, "byte_share": 0.02, "entropy": 0.2}


def _quartiles(table: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """`n` and the quartiles of each measure in each group."""
    both = [F.percentile_approx(m, [0.25, 0.75], 1000) for m in measures]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[q.alias(m) for q, m in zip(both, measures)])


def _drawn(groups: DataFrame, wider: DataFrame, on: list[str], measures: list[str], least_docs: int) -> DataFrame:
    """The groups' quartiles, drawn towards those of the wider groups as by `least_docs` documents of theirs."""
    names = [F.col(c).alias(f"wide_{c}") for c in on]
    above = wider.select(*names, *[F.col(m).alias(f"wide_{m}") for m in measures])
    at = F.lit(True)
    for c in on:
        at = at & F.col(c).eqNullSafe(F.col(f"wide_{c}"))
    share = F.col("n") / (F.col("n") + least_docs)
    mean = lambda m: F.transform(F.arrays_zip(F.col(m).alias("own"), F.col(f"wide_{m}").alias("wide")), lambda q: share * q["own"] + (1 - share) * q["wide"])
    return groups.join(above, at).select(*[c for c in groups.columns if c not in measures], *[F.coalesce(mean(m), f"wide_{m}").alias(m) for m in measures])


def _around(table: DataFrame, measures: list[str], least_docs: int) -> DataFrame:
    """Quartiles of each size class, from the nearest classes that have `least_docs` documents together (or from all).

    There are as many classes as powers of two, so few rows meet.
    """
    counts = table.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"))
    mine, other = counts.select("size_class"), counts.select(F.col("size_class").alias("other"), "n")
    apart = mine.join(other).withColumn("far", F.abs(F.col("size_class") - F.col("other")))
    rings = apart.groupBy("size_class", "far").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("size_class").orderBy("far")
    reach = rings.withColumn("upto", F.sum("n").over(upto)).groupBy("size_class").agg(F.coalesce(F.min(F.when(F.col("upto") >= least_docs, F.col("far"))), F.max("far")).alias("reach"))
    near = F.broadcast(apart.join(reach, "size_class").where("far <= reach").select("size_class", "other"))
    return _quartiles(table.withColumnRenamed("size_class", "other").join(near, "other"), ["size_class"], measures)


def bands(table: DataFrame, by_size: bool, measures: list[str], least_tokens: int = LEAST_TOKENS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The quartiles of each measure for every language and script, and size class if `by_size`: `band_<group column>`, `low_<measure>`, `high_<measure>`."""
    size = ["size_class"] if by_size else []
    if by_size:
        judges, widest = table, _around(table, measures, least_docs)
    else:
        judges = table.where(F.col("n_tokens") >= least_tokens)
        widest = _drawn(_quartiles(judges, [], measures), _quartiles(table, [], measures), [], measures, least_docs)
    here = table.select("kind", "script", *size).distinct()

    def with_own(groups: DataFrame, by: list[str]) -> DataFrame:
        """All groups, also those without a document that can judge."""
        found = _quartiles(judges, by, measures).select(*[F.col(c).alias(f"own_{c}") for c in by], "n", *measures)
        at = F.lit(True)
        for c in by:
            at = at & F.col(c).eqNullSafe(F.col(f"own_{c}"))
        return groups.join(found, at, "left").select(*groups.columns, F.coalesce("n", F.lit(0)).alias("n"), *measures)

    by_script = _drawn(with_own(here.select("script", *size).distinct(), ["script", *size]), widest, size, measures, least_docs)
    found = _drawn(with_own(here, ["kind", *size]), by_script, ["script", *size], measures, least_docs)
    ranges = [c for m in measures for c in (F.col(m)[0].alias(f"low_{m}"), F.col(m)[1].alias(f"high_{m}"))]
    return found.select(*[F.col(c).alias(f"band_{c}") for c in ("kind", "script", *size)], *ranges)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fence: float = FENCE, least_tokens: int = LEAST_TOKENS, least_docs: int = LEAST_DOCS, **vocabularies: str) -> DataFrame:
    """Counts, measures, `base_failed`, the `reasons` and `kept` of every document."""
    table = staged(measured(docs, doc_id, text, lang, **vocabularies).withColumn("size_class", _size_class()), "fertility")
    limits = (least_tokens, least_docs)
    any_size = staged(bands(table, False, [m for m in MEASURES if m not in BY_SIZE], *limits), "bands")
    by_size = staged(bands(table, True, list(BY_SIZE), *limits), "bands").withColumnsRenamed({"band_kind": "band_kind_2", "band_script": "band_script_2"})
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    at = F.col("kind").eqNullSafe(F.col("band_kind")) & F.col("script").eqNullSafe(F.col("band_script"))
    at_size = F.col("kind").eqNullSafe(F.col("band_kind_2")) & F.col("script").eqNullSafe(F.col("band_script_2")) & (F.col("size_class") == F.col("band_size_class"))
    error = F.sqrt(F.greatest(F.lit(1.0), least_tokens / F.greatest("n_tokens", F.lit(1))))
    wide = {m: fence * error * F.greatest(F.col(f"high_{m}") - F.col(f"low_{m}"), F.lit(_NARROWEST[m])) for m in MEASURES}
    outside = [F.when((F.col(m) < F.col(f"low_{m}") - wide[m]) | (F.col(m) > F.col(f"high_{m}") + wide[m]), F.lit(m)) for m in MEASURES]
    return (
        table.join(any_size, at, "left")
        .join(by_size, at_size, "left")
        .withColumns({"base_failed": base_failed, "reasons": F.array_compact(F.array(*outside))})
        .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
        .select("doc_id", *COUNTS, "base_failed", "kept", "n_tokens", *MEASURES, "reasons")
    )
