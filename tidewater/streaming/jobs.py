"""Structured Streaming jobs: sources, windows, state, sinks that are safe to repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.dates import as_instant
from tidewater.session import scratch_path

# ---- sources ----


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder, or a single file, as a stream.

    Spark streams a plain path only when it is a folder, but a pattern may match
    either, so a path without wildcards is written as a pattern for itself.
    """
    if not set(path) & set("*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_options(servers: str, topic: str, per_batch: int = 1_000_000, start: str = "earliest") -> dict[str, str]:
    """Options for `spark.readStream.format("kafka")`; the connector jar comes with the cluster."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "maxOffsetsPerTrigger": str(per_batch),
        "includeHeaders": "true",
        "failOnDataLoss": "true",
    }


def parse_kafka(df: DataFrame, schema: str) -> DataFrame:
    """Kafka rows with a JSON value to typed columns; key, partition and offset stay for tracing."""
    body = F.from_json(F.col("value").cast("string"), schema)
    return df.select(F.col("key").cast("string").alias("key"), "partition", "offset", body.alias("b")).select("key", "partition", "offset", "b.*")


def rescued(df: DataFrame, value: str, schema: str, known: Sequence[str]) -> DataFrame:
    """Known fields typed, all others kept as JSON, so that a new field is never lost."""
    fields = F.from_json(value, "map<string,string>")
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    kept = df.select("*", F.from_json(value, schema).alias("__b"), rest.alias("__r"))
    return kept.select(*df.columns, "__b.*", F.when(F.size("__r") > 0, F.to_json("__r")).alias("rescued")).drop(value)


# ---- running a stream to the end of what is there ----


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that writes each batch to its own folder; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def drain(
    df: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None
) -> StreamingQuery:
    """Process everything available, in as many batches as the source gives, then stop."""
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "stream-checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def drained(df: DataFrame, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """The result table of a finished run: all batches (append), the last one (complete) or the last row per key (update)."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-result")
    drain(df, batch_writer(path), mode)
    written = spark.read.parquet(path)
    if mode == "append":
        return written.drop("batch")
    if mode == "complete":
        last = written.agg(F.max("batch")).scalar()
        return written.where(F.col("batch") == last).drop("batch")
    from tidewater.operators.ranking import latest

    return latest(written, list(keys), ["batch"]).drop("batch")


def to_parquet(df: DataFrame) -> DataFrame:
    """Append to the file sink, which writes each file exactly once, and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-files")
    query = (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", scratch_path(spark, "stream-checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


# ---- windows, duplicates, joins ----


def tumbling(df: DataFrame, ts: str, width: str, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    return df.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def sliding(df: DataFrame, ts: str, width: str, slide: str, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    return df.withWatermark(ts, delay).groupBy(F.window(ts, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


def session(df: DataFrame, ts: str, gap: str, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """Sessions by gap; the last event is kept beside the window end, which lies one gap later."""
    return df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_event")
    )


def deduplicated(df: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """The first row per key within the watermark; state older than the delay is dropped."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, back: str, delay: str, how: str = "inner") -> DataFrame:
    """Left rows with right rows of the same key from `back` before them up to them; state is bounded on both sides."""
    l, r = left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay)
    near = (F.col(right_ts) <= F.col(left_ts)) & (F.col(right_ts) >= F.col(left_ts) - F.expr(f"INTERVAL {back}"))
    return l.join(r, (F.col(key) == F.col(f"right_{key}")) & near, how)


def summarise_until_idle(df: DataFrame, key: str, ts: str, value: str, idle: str, delay: str = "10 minutes") -> DataFrame:
    """Arbitrary state: count and sum per key, given out once the key has been idle for `idle` of event time."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def update(keys, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n, total, _ = state.get
            state.remove()
            yield pd.DataFrame({key: [keys[0]], "n": [n], "total": [total]})
            return
        n, total, newest = state.get if state.exists else (0, 0.0, 0)
        for batch in batches:
            n += len(batch)
            total += float(batch[value].sum())
            newest = max(newest, int(batch[ts].max().timestamp() * 1000))
        state.update((n, total, newest))
        state.setTimeoutTimestamp(max(newest + idle_ms, state.getCurrentWatermarkMs() + 1))

    kind = df.schema[key].dataType.simpleString()
    marked = df.select(key, ts, value).withWatermark(ts, delay)
    return marked.groupBy(key).applyInPandasWithState(
        update, f"{key} {kind}, n bigint, total double", "n bigint, total double, newest bigint", "append", "EventTimeTimeout"
    )


# ---- sinks that merge ----


def merging_sink(spark: SparkSession, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Apply each batch to the newest version of a table and write the next version.

    Version n + 1 is made from version n and batch n, so a repeated batch makes
    the same version again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        current = spark.read.parquet(f"{path}/v={batch_id}")
        merge(current, batch).write.mode("overwrite").parquet(f"{path}/v={batch_id + 1}")

    return write


def newest_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version below `path`, however many batches made it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "v=*/_SUCCESS"))]
    return spark.read.parquet(f"{path}/v={max(int(p.getParent().getName()[2:]) for p in done)}")


def splitting_sink(path: str, poison: Column) -> Callable[[DataFrame, int], None]:
    """Good rows to one folder, poison rows to another, from one pass over the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = batch.withColumn("route", F.when(F.coalesce(poison, F.lit(True)), "dead_letter").otherwise("good"))
        routed.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "route").parquet(path)

    return write


def with_sentinel(spark: SparkSession, events: DataFrame, row: dict, schema: str) -> DataFrame:
    """A stream followed by one far-future row, which moves the watermark past every real row."""
    path = scratch_path(spark, "sentinel")
    columns = events.columns
    spark.createDataFrame([tuple(row[c] for c in columns)], schema).write.parquet(path)
    return events.unionByName(file_stream(spark, path, schema))


def instant(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, as_instant(ts))
