"""Python functions for where no built-in expression fits. Arrow batches, never single rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAX_RATE = 0.18


def with_tax(c: Column | str) -> Column:
    """The built-in form, which is the one to use."""
    return (F.col(c) if isinstance(c, str) else c) * F.lit(1 + TAX_RATE)


@F.pandas_udf(T.DoubleType())
def add_tax(amount: pd.Series) -> pd.Series:
    return amount * (1 + TAX_RATE)


@F.udf(T.StringType(), useArrow=True)
def initials(name: str) -> str | None:
    return None if name is None else "".join(w[0] for w in name.split() if w).upper()


def weighted_mean(value: str, weight: str) -> Column:
    """Weighted mean as a formula of two sums, which Spark combines map-side; no Python aggregate needed."""
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


@F.udtf(returnType=T.StructType([T.StructField("position", T.IntegerType()), T.StructField("token", T.StringType())]))
class SplitTokens:
    """One row per token of a separated text."""

    def eval(self, text: str, separator: str):
        if text is not None:
            for i, token in enumerate(text.split(separator)):
                yield i, token


def in_batches(df: DataFrame, score, schema: str) -> DataFrame:
    """Apply a function to Arrow batches of records; their size is spark.sql.execution.arrow.maxRecordsPerBatch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield score(batch)

    return df.mapInPandas(run, schema)


def hashing_vectors(batch: pd.DataFrame, text: str = "text", width: int = 16) -> pd.DataFrame:
    """A deterministic stand-in for a model: signed counts of hashed words, scaled to length 1."""
    import zlib

    out = []
    for doc in batch[text]:
        v = np.zeros(width)
        for w in (doc or "").lower().split():
            h = zlib.crc32(w.encode())
            v[h % width] += 1 if h & 0x80000000 else -1
        norm = np.linalg.norm(v)
        out.append((v / norm if norm else v).tolist())
    return batch.drop(columns=[text]).assign(vector=out)
