"""A stored inverted index with word positions, and searches that read only the lists of their terms.

Postings (term, document, positions) lie in folders by a hash of the term and are
sorted by term inside the files, so a search prunes folders and row groups.  The
documents are dealt into cells by a hash of their id; a block is one term's
postings in one cell, with the largest share a document of it can score.  A frequent
term is thereby spread over many blocks and files.  For the best k documents,
the sum of the blocks' shares bounds what a cell can hold: the most promising cells
give k scores, and only cells that can reach the k-th of them are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import words
from tidewater.operators.control import spread
from tidewater.operators.ranking import top_n
from tidewater.operators.skew import is_small
from tidewater.session import cut_lineage, scratch_path

K1, B = 1.2, 0.75  # fixed values: the usual BM25 parameters
BUCKETS = 64
CELL_DOCS = 1024
PACK_WORDS = 500_000  # of the documents that are packed together
SLACK = 1e-7  # scores are compared after rounding to 8 digits


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class SearchIndex:
    spark: SparkSession
    path: str
    buckets: int
    n_docs: int
    n_words: int

    @property
    def mean(self) -> float:
        return self.n_words / self.n_docs if self.n_words else 1.0

    def _of(self, table: str, terms: Sequence[str]) -> DataFrame:
        """The rows of some terms; the folders are constants of the plan."""
        asked = self.spark.createDataFrame([(t,) for t in terms], "term string")
        folders = sorted({r[0] for r in asked.select(_bucket(F.col("term"), self.buckets)).collect()})
        return self.spark.read.parquet(f"{self.path}/{table}").where(F.col("bucket").isin(folders) & F.col("term").isin(list(terms)))

    def postings(self, terms: Sequence[str]) -> DataFrame:
        """`term, doc, n_words, tf, positions, cell`"""
        return self._of("postings", terms).drop("bucket")

    def blocks(self, terms: Sequence[str]) -> DataFrame:
        """`term, cell, docs, best`: documents of a block and the largest share of one."""
        return self._of("blocks", terms).drop("bucket")


def _share(tf: Column, n_words: Column, mean: float) -> Column:
    return tf * (K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * n_words / F.lit(mean)))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document and folder: its terms joined by blanks, and the positions of each from its start on.

    So a word costs the shuffle a position, and only a document's distinct terms their letters.
    """
    for whole in batches:
        upto = np.cumsum(pc.list_value_length(whole.column("w")).to_numpy(zero_copy_only=False))
        at = 0
        while at < whole.num_rows:  # documents of about PACK_WORDS words at a time
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + PACK_WORDS, "right")))
            batch, at = whole.slice(at, end - at), end
            flat, sizes = batch.column("w").flatten(), pc.list_value_length(batch.column("w")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            named = flat.dictionary_encode()
            code, bucket = named.indices.to_numpy(), batch.column("b").flatten().to_numpy()
            order = np.lexsort((code, bucket, row))  # stable: positions stay ascending
            row, code, bucket, place = row[order], code[order], bucket[order], place[order].astype(np.int32)
            term = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (code[1:] != code[:-1])]))
            r, b = row[term], bucket[term]
            group = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (b[1:] != b[:-1])]))
            cuts = pa.array(np.append(group, len(term)).astype(np.int32))
            starts = (term - np.repeat(term[group], np.diff(np.append(group, len(term))))).astype(np.int32)
            letters = pc.binary_join(pa.ListArray.from_arrays(cuts, named.dictionary.take(pa.array(code[term]))), " ")
            places = pa.ListArray.from_arrays(pa.array(np.append(term[group], len(row)).astype(np.int32)), pa.array(place))
            of = pa.array(r[group])
            out = [batch.column("doc").take(of), batch.column("cell").take(of), pa.array(sizes[r[group]].astype(np.int32)), pa.array(b[group].astype(np.int32)), letters, pa.ListArray.from_arrays(cuts, pa.array(starts)), places]
            yield pa.record_batch(out, ["doc", "cell", "n_words", "bucket", "terms", "starts", "positions"])


def build_index(df: DataFrame, doc: str, text: str, path: str | None = None, buckets: int = BUCKETS, cell_docs: int = CELL_DOCS) -> SearchIndex:
    """Write the index of all texts below `path`; one shuffle brings the terms of a document, with their positions, to their (folder, cell).

    Documents without an id are left out; a null or empty text is a document without words.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "search-index")
    texts = df.where(F.col(doc).isNotNull())
    n_docs = texts.count()
    cells = max(1, -(-n_docs // cell_docs))
    tokens = spread(texts.select(F.col(doc).alias("doc"), F.col(text).alias("text")), "doc").select("doc", F.pmod(F.xxhash64("doc"), F.lit(cells)).cast("int").alias("cell"), words("text").alias("w"))
    dealt = tokens.where("size(w) > 0").withColumn("b", F.transform("w", lambda t: _bucket(t, buckets)))
    kind = dict(dealt.dtypes)["doc"]
    packed = dealt.mapInArrow(_packed, f"doc {kind}, cell int, n_words int, bucket int, terms string, starts array<int>, positions array<int>")
    each = packed.repartition("bucket", "cell").select("bucket", "cell", "doc", "n_words", "starts", "positions", F.posexplode(F.split("terms", " ")).alias("i", "term"))
    start = F.get("starts", F.col("i"))
    tf = F.coalesce(F.get("starts", F.col("i") + 1), F.size("positions")) - start
    met = each.select("bucket", "cell", "term", "doc", "n_words", F.slice("positions", start + 1, tf).alias("positions"))
    if not texts.groupBy(doc).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():  # rows of one id and length are one document
        met = met.groupBy("bucket", "cell", "term", "doc", "n_words").agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
    rows = met.select("term", "cell", "doc", "n_words", F.size("positions").alias("tf"), "positions", "bucket")
    rows.sortWithinPartitions("bucket", "term", "cell", "doc").write.partitionBy("bucket").parquet(f"{path}/postings")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/postings")
    n_words = stored.agg(F.sum("tf")).first()[0] or 0
    share = _share(F.col("tf"), F.col("n_words"), n_words / n_docs if n_words else 1.0)
    blocks = stored.groupBy("bucket", "term", "cell").agg(F.count(F.lit(1)).alias("docs"), F.max(share).alias("best"))
    blocks.repartition("bucket").sortWithinPartitions("bucket", "term", "cell").write.partitionBy("bucket").parquet(f"{path}/blocks")
    return SearchIndex(spark, path, buckets, n_docs, n_words)


_kept: dict[tuple, SearchIndex] = {}


def index_of(df: DataFrame, doc: str, text: str, buckets: int = BUCKETS) -> SearchIndex:
    """The index of a stored table, built once in an application for the files as they are."""
    file = F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    state = df.select(file.alias("f")).distinct().agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("f"))).first()
    key = (df.sparkSession.sparkContext.applicationId, doc, text, buckets, *state)
    if key not in _kept:
        _kept[key] = build_index(df, doc, text, buckets=buckets)
    return _kept[key]


def _scored(index: SearchIndex, queries: DataFrame, terms: Sequence[str], cells: DataFrame) -> DataFrame:
    """`query, doc, score` in the given (query, cell) rows; `queries` has query, term, idf."""
    few = F.broadcast(cells) if is_small(cells) else cells
    rows = index.postings(terms).select("term", "cell", "doc", "n_words", "tf").join(F.broadcast(queries), "term").join(few, ["query", "cell"])
    share = F.col("idf") * _share(F.col("tf"), F.col("n_words"), index.mean)
    return rows.groupBy("query", "doc").agg(F.round(F.sum(share), 8).alias("score"))


def bm25_search(index: SearchIndex, queries: dict[int, Sequence[str]], k: int, doc: str = "doc") -> DataFrame:
    """The k best documents per query with score and rank; the same rows as scoring every document."""
    terms = sorted({t for q in queries.values() for t in q})
    blocks = cut_lineage(index.blocks(terms))
    held = {r["term"]: r["n"] for r in blocks.groupBy("term").agg(F.sum("docs").alias("n")).collect()}  # a row a term
    idf = {t: math.log((index.n_docs - held.get(t, 0) + 0.5) / (held.get(t, 0) + 0.5) + 1) for t in terms}
    asked = index.spark.createDataFrame([(q, t, idf[t]) for q, own in queries.items() for t in own], "query bigint, term string, idf double")
    reach = cut_lineage(blocks.join(F.broadcast(asked), "term").groupBy("query", "cell").agg(F.sum(F.col("idf") * F.col("best")).alias("reach")))
    first = top_n(reach, ["query"], [F.desc("reach"), F.asc("cell")], k).select("query", "cell")
    ranked = top_n(_scored(index, asked, terms, first), ["query"], [F.desc("score"), F.asc("doc")], k, rank="rank")
    least = ranked.where(F.col("rank") == k).select("query", F.col("score").alias("least"))
    rest = reach.join(F.broadcast(least), "query", "left").where(F.col("reach") >= F.coalesce("least", F.lit(0.0)) - SLACK).select("query", "cell")
    best = top_n(_scored(index, asked, terms, cut_lineage(rest)), ["query"], [F.desc("score"), F.asc("doc")], k, rank="rank")
    return best.select("query", F.col("doc").alias(doc), "score", F.col("rank").cast("bigint").alias("rank"))


def search(index: SearchIndex, must: Sequence[str], phrase: str | None = None, exclude: Sequence[str] = (), k: int = 10) -> DataFrame:
    """`doc, rank_score`: documents with all terms and the phrase and none of the excluded terms, best share of matches first.

    The documents of the rarest needed term lead; the other lists are cut to these
    before they meet.  The phrase is an intersection of positions.
    """
    spoken = phrase.split(" ") if phrase else []
    needed = sorted({*must, *spoken})
    blocks = index.blocks([*needed, *exclude])
    held = {r["term"]: r["n"] for r in blocks.groupBy("term").agg(F.sum("docs").alias("n")).collect()}
    rarest = min(needed, key=lambda t: (held.get(t, 0), t))
    lead = index.postings([rarest]).select("cell", "doc")
    if not is_small(lead):
        rows = index.postings([*needed, *exclude]).join(lead, ["cell", "doc"], "left_semi")
    else:
        rows = index.postings([*needed, *exclude]).join(F.broadcast(lead), ["cell", "doc"], "left_semi")
    at = {t: F.max(F.when(F.col("term") == t, F.col("positions"))).alias(f"p{i}") for i, t in enumerate(needed)}  # one row of a term in a document
    unwanted = F.count_if(F.col("term").isin(list(exclude))) if exclude else F.count_if(F.lit(False))
    docs = rows.groupBy("doc").agg(F.first("n_words").alias("n_words"), unwanted.alias("unwanted"), *at.values())
    col = {t: F.col(f"p{i}") for i, t in enumerate(needed)}
    good = F.col("unwanted") == 0
    for t in needed:
        good = good & col[t].isNotNull()
    if spoken:
        back = lambda t, i: F.transform(col[t], lambda x: x - i)
        starts = col[spoken[0]]
        for i, t in enumerate(spoken[1:], 1):
            starts = F.array_intersect(starts, back(t, i))
        good = good & (F.size(starts) > 0)
    matches = sum((F.size(col[t]) for t in must), F.lit(0))
    return docs.where(good).select("doc", F.round(matches / F.col("n_words"), 8).alias("rank_score")).orderBy(F.desc("rank_score"), "doc").limit(k)


def with_headline(found: DataFrame, df: DataFrame, doc: str, text: str, term: str) -> DataFrame:
    """Adds a snippet around the term; only the found documents are read."""
    ids = [r["doc"] for r in found.select("doc").collect()]  # as many as the search was asked for
    at = F.instr(F.lower(text), term)
    snippets = df.where(F.col(doc).isin(ids)).select(doc, F.substring(F.col(text), F.greatest(at - 20, F.lit(1)), F.lit(60)).alias("headline"))
    return found.withColumnRenamed("doc", doc).join(F.broadcast(snippets), doc)
