"""Parity of two tables by checksums: compare totals of buckets level by level, and rows only where totals differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import by_rows, cut_lineage

BUCKETS = 4096
FAN = 16


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket of a row by its keys; write it as a partition column and only differing folders are read again."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def checksums(df: DataFrame, keys: Sequence[str], compared: Sequence[str], buckets: int = BUCKETS, bucket: str | None = None) -> DataFrame:
    """`bucket, n, total, mixed, sums`: rows, sum and exclusive or of row hashes, and the sum of every compared number.

    One scan, added up before anything is shuffled.  The sum of hashes tells repeated
    rows apart, which an exclusive or alone does not.
    """
    row = F.xxhash64(*keys, *compared)
    numbers = [c for c in compared if df.schema[c].simpleString().split(":")[-1].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")]
    sums = F.struct(*[F.sum(F.col(c).cast("double")).alias(c) for c in numbers]) if numbers else F.lit(None)
    where = F.col(bucket) if bucket else bucket_of(keys, buckets)
    return df.groupBy(where.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(row).alias("mixed"), sums.alias("sums"))


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS, fan: int = FAN) -> tuple[list[int], list[int]]:
    """Buckets whose totals differ, and how many nodes each level of the tree compared.

    From the root down: a node whose totals agree is not opened.  The tables are at
    most `buckets` rows each.
    """
    facts = lambda df, node: df.groupBy(node.alias("node")).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"))
    above, width = buckets, buckets
    opened: list[int] | None = None
    compared = []
    while True:
        node = F.floor(F.col("bucket") / width).cast("int")
        sides = [facts(df if opened is None else df.where(F.floor(F.col("bucket") / above).cast("int").isin(opened)), node) for df in (left, right)]
        l, r = (s.select("node", F.struct("n", "total", "mixed").alias(name)) for s, name in zip(sides, "lr"))
        rows = l.join(r, "node", "full").select("node", (~F.col("l").eqNullSafe(F.col("r"))).alias("differs")).collect()
        compared.append(len(rows))
        opened = sorted(x["node"] for x in rows if x["differs"])
        if width == 1 or not opened:
            return opened if width == 1 else [], compared
        above, width = width, max(1, width // fan)


def differing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], compared: Sequence[str], buckets: int = BUCKETS, bucket: str | None = None
) -> DataFrame:
    """`keys, status`: keys with rows that the other side lacks, or lacks as often; only rows of differing buckets are shuffled.

    `bucket` names a stored column of both sides (see `bucket_of`); with it, the scan
    itself is pruned.  Null keys are keys; repeated rows are counted.
    """
    sums = [cut_lineage(checksums(df, keys, compared, buckets, bucket).drop("sums")) for df in (left, right)]
    differing, _ = differing_buckets(*sums, buckets)
    where = (F.col(bucket) if bucket else bucket_of(keys, buckets)).isin(differing) if differing else F.lit(False)
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(compared)])
    sided = lambda df, side: df.where(where).select(*keys, row.alias("row"), F.lit(side).alias("side"))
    # rows hardly repeat within a task: they meet by key first, so that no task counts more than its part
    parts = by_rows(left.sparkSession, sum(s.agg(F.sum("n")).first()[0] or 0 for s in sums))
    met = sided(left, 1).unionByName(sided(right, -1)).repartition(parts, *keys)
    both = met.groupBy(*keys, "row").agg(F.sum("side").alias("over"), F.max("side").alias("l"), F.min("side").alias("r"))
    by_key = both.groupBy(*keys).agg(F.max("l").alias("l"), F.min("r").alias("r"), F.max(F.abs("over")).alias("over"))
    status = F.when(F.col("l") < 0, "only_right").when(F.col("r") > 0, "only_left").otherwise("differs")
    return by_key.where("over <> 0").select(*keys, status.alias("status"))
