"""Exact histogram of encoded document lengths, with suffix sums that answer every context limit.

Null and empty texts have length 0 and count as documents.  Repeated rows count
as often as they occur.  An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.encoders import encoder
from tidewater.llm.storage import staged
from tidewater.llm.words import slices

CELL = 1024  # lengths summed together on the upper level


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """`n_tokens, n_docs`: how many documents have each length; every task adds up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in slices(batches, "text"):
            sizes, times = np.unique(encoder(vocabulary).lengths(batch.column("text")), return_counts=True)
            for n, k in zip(sizes.tolist(), times.tolist()):
                total[n] = total.get(n, 0) + k
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["n_tokens", "n_docs"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens bigint, n_docs bigint")
    return parts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length the documents and tokens at that length or above, and what a limit of that length keeps.

    `docs_at_least, tokens_at_least` are the suffix sums, `docs_total, tokens_total`
    the sums over all lengths, `tokens_kept` the total after cutting every document
    to this length, `docs_cut` the documents that lose tokens, `share_up_to` the
    share of documents that fit.  Sums run inside cells of lengths; one row per
    cell carries the rest, so that no task sees all lengths.
    """
    cell = F.floor(F.col("n_tokens") / CELL)
    base = staged(histogram.withColumns({"tokens": F.col("n_tokens") * F.col("n_docs"), "cell": cell}), "lengths")
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = base.groupBy("cell").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    carried = sums.select(
        F.col("cell"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(every).alias("docs_total"),
        F.sum("t").over(every).alias("tokens_total"),
    )
    inside = Window.partitionBy("cell").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumns({"docs_in": F.sum("n_docs").over(inside), "tokens_in": F.sum("tokens").over(inside)})
    docs, tokens = F.col("docs_above") + F.col("docs_in"), F.col("tokens_above") + F.col("tokens_in")
    cut = docs - F.col("n_docs")
    return local.join(carried, "cell").select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        "docs_total",
        "tokens_total",
        cut.alias("docs_cut"),
        (F.col("tokens_total") - tokens + F.col("n_tokens") * docs).alias("tokens_kept"),
        ((F.col("docs_total") - cut) / F.col("docs_total")).alias("share_up_to"),
    )


def at_limits(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """One row per context limit from the suffix sums: documents cut, tokens kept and lost."""
    asked = table.withColumn("context", F.explode(F.array(*[F.lit(int(n)) for n in limits]).cast("array<bigint>")))
    first = F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(F.col("n_tokens") > F.col("context"), F.col("n_tokens")))
    totals = asked.groupBy("context").agg(first.alias("over"), F.max("docs_total").alias("docs_total"), F.max("tokens_total").alias("tokens_total"))
    over = F.coalesce(F.col("over.docs_at_least"), F.lit(0))
    lost = F.coalesce(F.col("over.tokens_at_least"), F.lit(0)) - F.col("context") * over
    return totals.select("context", over.alias("docs_cut"), (F.col("tokens_total") - lost).alias("tokens_kept"), lost.alias("tokens_lost"))


def length_quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least each share of the documents does not exceed."""
    asked = table.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    return asked.groupBy("share").agg(F.min(F.when(F.col("share_up_to") >= F.col("share"), F.col("n_tokens"))).alias("n_tokens"))
