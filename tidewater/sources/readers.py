"""Reading files and databases with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; quoted commas stay inside their field, quotes inside are doubled."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def read_csv_marked(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV whose unreadable lines stay, with the fields that could be read and the raw line in `_corrupt`."""
    reader = spark.read.option("header", True).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = f"{schema}, {CORRUPT} string"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def split_bad(df: DataFrame, root: str) -> str:
    """Write marked rows in one pass: readable ones to `route=good`, the others to `route=quarantine`.

    Quarantined rows keep the raw line, the reason and the file they came from.
    """
    bad = F.col(CORRUPT).isNotNull()
    routed = df.withColumns(
        {
            "reason": F.when(bad, "malformed line"),
            "file": F.when(bad, F.col("_metadata.file_path")),
            "route": F.when(bad, "quarantine").otherwise("good"),
        }
    )
    routed.write.mode("overwrite").partitionBy("route").parquet(root)
    return root


def read_json(spark: SparkSession, path: str, schema: str, array_files: bool = False) -> DataFrame:
    """JSON lines, or files that each hold one array."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file, counted by all tasks."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("lines"))


def read_tree(spark: SparkSession, paths: Sequence[str], schema: str, glob: str = "*.parquet") -> DataFrame:
    """All matching files below several folders, each row with the name of its file."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.parquet(*paths).withColumn("file", F.col("_metadata.file_path"))


def jdbc_options(url: str, query: str, driver: str, column: str, lower: int, upper: int, parts: int) -> dict[str, str]:
    """Options for a parallel `spark.read.format("jdbc")`: one range of `column` per connection."""
    return {
        "url": url,
        "dbtable": f"({query}) q",
        "driver": driver,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
        "fetchsize": "10000",
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
