"""Writing Parquet and other files: partitioned, replaced by partition, sized, compacted, clustered, bucketed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ordered import numeric
from tidewater.session import scratch_path


def _by_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value; adaptive execution splits a large value over tasks and joins small ones."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", rows_per_file: int = 0) -> str:
    """Overwrite `path`, one folder per partition value, few files in each."""
    writer = _by_partition(df, by).write.mode("overwrite").partitionBy(*by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.format(fmt).save(path)
    return path


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Replace only the partitions that occur in `df`; the others stay."""
    _by_partition(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 << 20) -> str:
    """Rewrite many small files as few large ones in a new folder; the source is not touched.

    A task reads the files that make up its own one, and no row is shuffled.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(source)
    size = files.agg(F.sum("length").alias("b")).first()["b"] or 0
    spark.read.parquet(source).coalesce(max(1, -(-size // file_bytes))).write.mode("overwrite").parquet(target)
    return target


def spread_bits(c: Column, bits: int = 16) -> Column:
    """The bits of a whole number with a zero between each two, for interleaving."""
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint")), 2 * i))
    return out


def z_value(a: Column, b: Column) -> Column:
    """Place of a pair of 16-bit numbers on the Z curve."""
    return spread_bits(a).bitwiseOR(F.shiftleft(spread_bits(b), 1))


SAMPLED = 4096  # about so many distinct strings place the cuts of a column


def rank_cuts(df: DataFrame, column: str, bits: int = 8) -> list:
    """Values that cut a column into 2^bits runs of about as many rows, in order.

    Numbers and times by approximate quantiles.  Strings by the rows of a sample of
    distinct values, taken by hash; it moves the cuts, and no row is left out.
    """
    n = 1 << bits
    if isinstance(df.schema[column].dataType, T.StringType):
        every = max(1, (df.agg(F.approx_count_distinct(column)).first()[0] or 0) // SAMPLED)
        held = df.where(F.pmod(F.xxhash64(column), F.lit(every)) == 0).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        rows = [(r[column], r["n"]) for r in held.collect() if r[column] is not None]
        rows.sort(key=lambda r: r[0].encode())
        total, seen, cuts = sum(r[1] for r in rows), 0, []
        for value, count in rows:
            if (seen + count) * n // max(1, total) > seen * n // max(1, total):
                cuts.append(value)
            seen += count
        return cuts[:-1]
    along = numeric(df, column)
    found = df.agg(F.percentile_approx(along, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    return sorted(set(found))


def rank_of(df: DataFrame, column: str, cuts: list, bits: int = 8) -> Column:
    """How many cuts lie below a value, by binary search; null before all."""
    text = isinstance(df.schema[column].dataType, T.StringType)
    value, points = F.col(column) if text else numeric(df, column), F.lit(cuts).cast("array<string>" if text else "array<double>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(points, at + step - 1) < value, at + step).otherwise(at))


def write_clustered(df: DataFrame, path: str, a: str, b: str, files: int, bits: int = 8) -> str:
    """Files that each cover a small range of two columns, so that filters on either skip most of them.

    The columns' ranks are interleaved, not their values: outliers and uneven values
    do not draw the rows together.
    """
    ranks = [rank_of(df, c, rank_cuts(df, c, bits), bits) for c in (a, b)]
    placed = df.withColumn("__z", z_value(*ranks))
    placed.repartitionByRange(files, "__z", a, b).sortWithinPartitions("__z").drop("__z").write.mode("overwrite").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str) -> None:
    """A table bucketed by a key; two tables bucketed alike join without a shuffle.

    Rows are brought together by bucket first, so each bucket is one file.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def load_new_files(spark: SparkSession, folder: str, log: DataFrame) -> DataFrame:
    """Rows of the files that the load log does not list yet, each with its file name."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder).select("path")
    new = [r["path"] for r in listing.join(log.select("path"), "path", "left_anti").collect()]
    if not new:
        return spark.read.parquet(folder).limit(0).withColumn("path", F.lit(None).cast("string"))
    return spark.read.parquet(*new).withColumn("path", F.col("_metadata.file_path"))


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_rows(spark: SparkSession, path: str, key: str, gone: DataFrame) -> tuple[int, int]:
    """Delete the rows of a Parquet folder whose key is in the one column of `gone`; returns (rows before, rows after).

    Only files that hold such a row are read whole and written again; all others stay
    as they are.  Not a transaction: the new files are complete before the first old
    one goes, and `finish_rewrite` may be repeated after a failure.
    """
    table = spark.read.parquet(path)
    named = table.withColumn("__file", F.col("_metadata.file_path"))
    wanted = gone.select(F.col(gone.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    staging = scratch_path(spark, "rewrite")
    named.join(wanted, key, "left_semi").groupBy("__file").agg(F.count(F.lit(1)).alias("deleted")).write.parquet(f"{staging}/files")
    touched = spark.read.parquet(f"{staging}/files")
    rest = named.join(touched.select("__file"), "__file", "left_semi").join(wanted, key, "left_anti").select(*table.columns)
    rest.write.parquet(f"{staging}/rows")
    before = table.count()
    finish_rewrite(spark, path, staging)
    return before, before - (touched.agg(F.sum("deleted")).first()[0] or 0)


def finish_rewrite(spark: SparkSession, path: str, staging: str) -> None:
    """Move the new files in and remove the old ones; what is done already is passed over."""
    folder, store = _store(spark, path)
    rows, held = _store(spark, f"{staging}/rows")
    mark = staging.rsplit("-", 1)[1]
    if spark.read.parquet(f"{staging}/files").isEmpty():
        return
    new = [f.getPath() for f in held.listStatus(rows) if f.getPath().getName().startswith("part-")]
    for file in new:
        held.rename(file, spark._jvm.org.apache.hadoop.fs.Path(folder, f"part-{mark}-{file.getName()[5:]}"))
    for r in spark.read.parquet(f"{staging}/files").select("__file").toLocalIterator():
        old, at = _store(spark, r["__file"])
        at.delete(old, False)


def versioned_write(df: DataFrame, label: str) -> str:
    """Write a new version of a table next to the old one and return its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path
