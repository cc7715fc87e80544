"""Collocations by prefix-free parsing: phrases are counted in a dictionary of distinct chunks.

A text is cut into pieces at punctuation and line breaks, and a piece into chunks
before every word whose hash triggers a cut; so equal passages are cut alike
wherever they stand.  A chunk also holds the first words of what follows it in the
piece, so that every phrase lies whole in the chunk where it begins; there alone
it is counted, which assigns the overlaps once.  The dictionary has each distinct
chunk with its frequency in the parse, and a phrase's count is the sum of the
frequencies of the chunks it begins in.  Passages that many documents share cost
one chunk.

Phrases grow by a word a pass.  One of k words can reach the least count only if
both phrases of k - 1 words inside it do, so a Bloom filter of these (a bounded
size; it only saves rows) stands before the count.  Counts are added up by the
phrases' texts; inside a task, equal 64-bit hashes stand for equal phrases.

A null text has no words; a null language is `und`.  Repeated rows count each.  A
piece without a trigger is one chunk, however long; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.decontaminate import Filter, filter_of
from tidewater.llm.storage import staged
from tidewater.llm.words import LOWER, hashes, joined, joint_hashes, mixed, run_hashes, slices, spans, strings, text_buffer
from tidewater.operators.ranking import top_n

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a candidate
PERCENT = 100  # of its count that a longer candidate must reach to replace a phrase
BEST = 2000  # phrases of a language
TRIGGER = 16  # one word in so many begins a chunk
HEAVY = 50_000  # at most so many phrases of one length are looked up in a broadcast
GATHERED = 8 << 20  # bytes of chunks that are counted at once

_CUT = np.array([chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
_WORD = np.array([b not in (0x20, 0x09) for b in range(256)]) & ~_CUT
_FULL = np.array([b != 0x20 for b in range(256)])
_LANG = np.uint64(0xC2B2AE3D27D4EB4F)


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """A code for each row, the values, and a hash for each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    coded = column.dictionary_encode()
    data, offsets = text_buffer(coded.dictionary)
    code = coded.indices.to_numpy()
    return code, coded.dictionary, hashes(data, offsets[:-1], offsets[1:])[code]


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct key and its summed weight."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    return order[first], np.add.reduceat(weights[order], first)


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, trigger: int = TRIGGER) -> DataFrame:
    """`lang, own, chunk, n`: distinct chunks, how many of their words are their own (the rest belong to the next), and their frequency.

    Every word of a chunk is followed by one blank.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_buffer(batch.column("text"))
            start, end, doc = spans(data, offsets, _WORD)
            if not len(start):
                continue
            piece = np.searchsorted(np.flatnonzero(_CUT[data]), start)
            opens = np.ones(len(start), bool)
            opens[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
            pieces = np.append(np.flatnonzero(opens), len(start))
            word = hashes(data, start, end, LOWER)
            first = np.flatnonzero(opens | (word % np.uint64(trigger) == 0))
            upto = np.append(first[1:], len(start))
            own = upto - first
            upto = np.minimum(upto + longest - 1, pieces[np.searchsorted(pieces, first, "right")])
            code, names, salt = _codes(batch.column("lang"))
            key = mixed(joint_hashes(word, first, upto) + salt[doc[first]] * _LANG + own.astype(np.uint64))
            at, times = _added(key, np.ones(len(key), np.int64))
            # the words of the distinct chunks, each with the byte after it, which becomes a blank
            sizes = (upto - first)[at]
            ends = np.cumsum(sizes)
            index = np.arange(ends[-1]) + np.repeat(first[at] - ends + sizes, sizes)
            padded = np.append(LOWER[data], np.uint8(0x20))
            body, places = joined(padded, start[index], end[index] + 1)
            body[places[1:] - 1] = 0x20
            chunks = strings(body, places[np.concatenate([[0], ends])])
            yield pa.record_batch([names.take(pa.array(code[doc[first[at]]])), pa.array(own[at].astype(np.int32)), chunks, pa.array(times)], ["lang", "own", "chunk", "n"])

    named = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return named.mapInArrow(parse, "lang string, own int, chunk string, n bigint").groupBy("lang", "own", "chunk").agg(F.sum("n").alias("n"))


def _gathered(batches: Iterator[pa.RecordBatch], most: int = GATHERED) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("chunk").nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def phrase_counts(dictionary: DataFrame, size: int, least: int, shorter: Filter | None) -> DataFrame:
    """`lang, phrase, token, f`: phrases of `size` words with at least `least` occurrences; `shorter` knows those of one word less."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            data, offsets = text_buffer(batch.column("chunk"))
            start, end, row = spans(data, offsets, _FULL)
            if len(start) < size:
                continue
            code, names, salt = _codes(batch.column("lang"))
            word = hashes(data, start, end)
            begin = np.searchsorted(row, np.arange(batch.num_rows))
            salted = (salt * _LANG)[row]
            tokens = lambda first, k: mixed(run_hashes(word, first, k) + salted[first])
            n = len(start) - size + 1
            whole = (row[:n] == row[size - 1 :]) & (np.arange(n) - begin[row[:n]] < batch.column("own").to_numpy()[row[:n]])
            first = np.flatnonzero(whole)
            if shorter is not None:
                m = n + 1  # where phrases of one word less can begin
                known = np.zeros(m, bool)
                known[shorter.found(tokens(np.arange(m), size - 1))] = True
                first = first[known[first] & known[first + 1]]
            key = tokens(first, size)
            at, f = _added(key, batch.column("n").to_numpy()[row[first]])
            body, places = joined(data, start[first[at]], end[first[at] + size - 1])
            yield pa.record_batch([names.take(pa.array(code[row[first[at]]])), strings(body, places), pa.array(key[at].view(np.int64)), pa.array(f)], ["lang", "phrase", "token", "f"])

    found = dictionary.mapInArrow(count, "lang string, phrase string, token bigint, f bigint")
    return found.groupBy("lang", "phrase", "token").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """`lang, phrase, size, f` of all phrases of up to `longest` words with at least `least` occurrences, and `lang, n` of all words."""
    dictionary = staged(chunk_dictionary(docs, text, lang, longest, trigger), "dictionary")
    words = staged(dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n")), "words")
    tables, shorter = [], None
    for size in range(1, longest + 1):
        held = staged(phrase_counts(dictionary, size, least, shorter), f"phrases-{size}")
        tables.append(held.select("lang", "phrase", F.lit(size).alias("size"), "f"))
        if size < longest:
            shorter = filter_of(held)
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out, words


def _looked_up(rows: DataFrame, phrases: DataFrame, part: str, out: str, bound: int) -> DataFrame:
    """Adds the count of the phrase in column `part`; rows must be stored.

    A phrase is part of at most its count by `least` candidates.  The most frequent
    ones, of which there cannot be many, are broadcast; the others meet by shuffle.
    """
    named = phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
    heavy = named.where(F.col(out) >= bound)
    near = rows.join(F.broadcast(heavy), ["lang", part], "left")
    far = near.where(F.col(out).isNull()).drop(out).join(named.where(F.col(out) < bound), ["lang", part])
    return near.where(F.col(out).isNotNull()).unionByName(far)


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, percent: int = PERCENT, best: int = BEST
) -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: the phrases that hold together best, by their weakest cut.

    A cut into a first part of l and a rest of r occurrences scores
    floor(1000 * a * n / (l * r)), in whole decimals of 38 digits.
    """
    phrases, words = frequent_phrases(docs, text, lang, longest, least)
    total = words.agg(F.sum("n")).first()[0] or 0
    candidates = phrases.where("size >= 2").withColumnRenamed("f", "a")
    # a phrase that a longer one replaces is replaced by one of just one word more
    w = F.split("phrase", " ")
    shorter = F.array(F.array_join(F.slice(w, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(w, F.lit(2), F.col("size") - 1), " "))
    longer = candidates.where("size >= 3").select("lang", F.explode(shorter).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where((100 * F.coalesce("longer", F.lit(0))) < (percent * F.col("a")))
    pieces = lambda k: F.struct(k.alias("cut"), F.array_join(F.slice(w, F.lit(1), k), " ").alias("head"), F.array_join(F.slice(w, k + 1, F.col("size") - k), " ").alias("rest"))
    cuts = staged(kept.select("lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), F.col("size") - 1), pieces))), "cuts")
    bound = max(least, total // HEAVY)
    both = _looked_up(staged(_looked_up(cuts, phrases, "head", "l", bound), "heads"), phrases, "rest", "r", bound)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = both.join(words, "lang").withColumn("over", wide("a") * wide("n") * F.lit(1000)).withColumn("under", wide("l") * wide("r"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("over div under").alias("score"), "cut", "l", "r")).alias("w"))
    table = weakest.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    ranked = top_n(table, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], best, rank="rank")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
