"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, packing.

Every stage works on all that its predecessor kept and returns the columns of its
input; the last one returns packed pieces.  Where a verdict is about a row, rows
are told apart by a hash of doc_id and text, so null and repeated ids are judged
by their own text.  An empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, fertility, jaccard_join, line_dedup, packing
from tidewater.llm.storage import settled, staged
from tidewater.sources.tables import Tables

IDS_TO_SEND = 2_000_000  # 16 MB of row hashes or ids

WORDS, PERCENT = 5, 80  # shingles and similarity of near duplicates

_KEY = "__row"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.xxhash64("doc_id", "text"))


def _without(docs: DataFrame, judged: Callable[[], DataFrame], key: str) -> DataFrame:
    """Rows whose key `judged` does not give; these are sent to all tasks only when they are known to be few.

    What the operator wrote on its way is deleted as soon as its verdict is stored.
    """
    gone = settled(lambda: judged().distinct(), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= IDS_TO_SEND else gone, key, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    keyed = _keyed(docs)
    rejected = lambda: fertility.judged(keyed, doc_id=_KEY).where(~F.col("kept")).select(F.col("doc_id").alias(_KEY))
    return _without(keyed, rejected, _KEY).select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has; those left without words go."""
    return line_dedup.without_repeated_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest doc_id, of every group of near duplicates; equal rows of an id become one.

    Near duplicates share at least PERCENT of their shingles of WORDS words.
    Documents without doc_id belong to no group and stay.
    """
    later = lambda: jaccard_join.jaccard_components(docs, size=WORDS, percent=PERCENT).where("doc_id <> component_id").select("doc_id")
    kept = _without(docs, later, "doc_id")
    again = staged(docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id"), "repeated")
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    keyed = _keyed(docs)
    found = lambda: decontaminate.contamination(keyed, Tables(spark, sf_dir).benchmark, doc_id=_KEY).where("contaminated").select(F.col("doc_id").alias(_KEY))
    return _without(keyed, found, _KEY).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 tokens over what is left."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: Tokens cannot be made in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
