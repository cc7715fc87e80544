"""Pages by key instead of by offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def before(columns: Sequence[str], values: Sequence[Column]) -> Column:
    """Row comparison (a, b) < (x, y), spelled out so that its parts can be pushed down."""
    cond = F.lit(False)
    for name, value in reversed(list(zip(columns, values))):
        cond = (F.col(name) < value) | ((F.col(name) == value) & cond)
    return cond & (F.col(columns[0]) <= values[0])


def keyset_page(df: DataFrame, columns: Sequence[str], last_seen: Sequence[Column], size: int) -> DataFrame:
    """The next `size` rows below the last row seen, newest first."""
    return df.where(before(columns, last_seen)).orderBy(*[F.desc(c) for c in columns]).limit(size)
