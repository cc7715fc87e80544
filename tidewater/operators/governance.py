"""Access policies, personal data, lineage, deletion and cost reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import cut_lineage

# Patterns for the kinds of personal data that are looked for.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ipv4": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "phone": r"\+?[0-9][0-9 ()-]{8,}[0-9]",
}


def secured_view(df: DataFrame, row_filter: Column, masks: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """What one principal may see: some rows, some columns, some of them masked."""
    return df.where(row_filter).withColumns(masks).select(*columns)


def pii_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Matches and matching rows of every pattern in every column, in one pass."""
    aggs = []
    for c in columns:
        for kind, pattern in PII_PATTERNS.items():
            hits = F.regexp_count(F.col(c), F.lit(pattern))
            aggs.append(F.sum(hits).cast("bigint").alias(f"m:{c}:{kind}"))
            aggs.append(F.count_if(hits > 0).alias(f"r:{c}:{kind}"))
    one = df.agg(*aggs)
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.col(f"m:{c}:{kind}").alias("matches"), F.col(f"r:{c}:{kind}").alias("matching_rows"))
        for c in columns
        for kind in PII_PATTERNS
    ]
    return one.select(F.inline(F.array(*lines)))


def redact(c: Column) -> Column:
    """Replace personal data in text by a tag naming its kind."""
    for kind, pattern in PII_PATTERNS.items():
        c = F.regexp_replace(c, pattern, f"[{kind}]")
    return c


def token_of(c: Column, salt: str) -> Column:
    """A stable stand-in for an identifier; the same input always gives the same token."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def upstream(edges: DataFrame, target: str) -> DataFrame:
    """Direct sources of one dataset."""
    return edges.where(F.col("target") == target).select("source").distinct()


def upstream_all(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """All sources of every dataset, with the shortest distance; cycles do not loop."""
    direct = cut_lineage(edges.select(F.col(source).alias("source"), F.col(target).alias("target")).distinct())
    seen = direct.withColumn("distance", F.lit(1).cast("bigint"))
    frontier = seen
    depth = 1
    while not frontier.isEmpty():
        depth += 1
        step = frontier.select(F.col("source").alias("mid"), "target").join(
            direct.select("source", F.col("target").alias("mid")), "mid"
        )
        fresh = step.select("source", "target").distinct().join(seen, ["source", "target"], "left_anti")
        frontier = cut_lineage(fresh.withColumn("distance", F.lit(depth).cast("bigint")))
        seen = cut_lineage(seen.unionByName(frontier))
    return seen


def delete_subjects(df: DataFrame, key: str, subjects: DataFrame, subject: str) -> DataFrame:
    """The table without the rows of the given subjects."""
    gone = subjects.select(F.col(subject).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(gone, key, "left_anti")
