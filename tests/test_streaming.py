"""Streams that need no table: rate, memory and console sinks, listeners, Kafka options."""

import time

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.session import scratch_path
from tidewater.streaming import jobs as S


def test_rate_source_to_memory_and_console(spark):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 20).load()
    tiered = rate.withColumn("tier", F.when(F.col("value") % 2 == 0, "EVEN").otherwise("ODD"))
    q = tiered.writeStream.format("memory").queryName("tiers").outputMode("append").start()
    deadline = time.time() + 60
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 2):
        time.sleep(0.2)
    q.stop()
    got = spark.table("tiers")
    assert got.count() >= 40 and got.where("tier = 'EVEN' AND value % 2 = 1").isEmpty()
    feed = scratch_path(spark, "console-feed")
    spark.range(3).write.parquet(feed)
    c = S.file_stream(spark, feed, "id bigint").writeStream.format("console").trigger(availableNow=True).start()
    assert c.awaitTermination(60)


def test_a_repeated_batch_replaces_itself(spark):
    path = scratch_path(spark, "repeat")
    sink = S.batch_writer(path)
    for _ in range(2):
        sink(spark.range(5), 0)
    sink(spark.range(5, 7), 1)
    assert spark.read.parquet(path).count() == 7


def test_merging_sink_is_idempotent(spark):
    path = scratch_path(spark, "versions")
    spark.range(2).write.parquet(f"{path}/v=0")
    sink = S.merging_sink(spark, path, lambda old, batch: old.unionByName(batch).distinct())
    for _ in range(2):
        sink(spark.range(1, 4), 0)
    assert rows(spark.read.parquet(f"{path}/v=1")) == [(0,), (1,), (2,), (3,)]


def test_listener_sees_progress(spark):
    seen = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            seen.append(event.progress.numInputRows)

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    try:
        feed = scratch_path(spark, "listened")
        spark.range(9).write.parquet(feed)
        done = S.drain(S.file_stream(spark, feed, "id bigint"), S.batch_writer(scratch_path(spark, "listened-out")))
        assert sum(p["numInputRows"] for p in done.recentProgress) == 9
    finally:
        spark.streams.removeListener(listener)


def test_kafka_rows(spark):
    options = S.kafka_options("broker:9092", "events", per_batch=10)
    assert options["subscribe"] == "events" and options["maxOffsetsPerTrigger"] == "10"
    raw = spark.createDataFrame([(b"k", b'{"id": 5}', 0, 1), (b"k", b"broken", 0, 2)], "key binary, value binary, partition int, offset long")
    assert rows(S.parse_kafka(raw, "id int"), "offset", "id") == [(1, 5), (2, None)]
