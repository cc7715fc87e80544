"""Rewritten files, clustering by ranks, progress tables and state processors."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sources import sinks
from tidewater.streaming import jobs as S
from tidewater.streaming.processors import first_seen, timed_sessions
from tidewater.streaming.watching import ProgressTable, summary


def files(path):
    return {f for f in os.listdir(path) if f.startswith("part-")}


def test_a_delete_rewrites_the_files_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "IF(id % 50 = 0, null, id % 7) AS k", "concat('v', id) AS v").repartitionByRange(10, "id").write.parquet(path)
    where = {r.f.rsplit("/", 1)[1]: (r.lo, r.hi) for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    gone = spark.createDataFrame([(5,), (17,), (17,), (None,), (123456,)], "x long")
    assert sinks.delete_rows(spark, path, "id", gone) == (1000, 998)
    untouched = {f for f, (lo, hi) in where.items() if not lo <= 5 <= hi and not lo <= 17 <= hi}
    assert untouched < files(path) and not (set(where) - untouched) & files(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [i for i in range(1000) if i not in (5, 17)]
    names = files(path)
    assert sinks.delete_rows(spark, path, "id", gone) == (998, 998) and files(path) == names
    assert sinks.delete_rows(spark, path, "k", spark.createDataFrame([(3,)], "k long"))[1] == spark.read.parquet(path).count()
    assert spark.read.parquet(path).where("k IS NULL").count() == 20  # null is no key


def test_an_interrupted_rewrite_can_be_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).repartitionByRange(4, "id").write.parquet(path)
    staging = []
    monkeypatch.setattr(sinks, "finish_rewrite", lambda spark, path, at: staging.append(at))
    sinks.delete_rows(spark, path, "id", spark.createDataFrame([(3,)], "x long"))
    assert spark.read.parquet(path).count() == 100
    monkeypatch.undo()
    for _ in range(2):
        sinks.finish_rewrite(spark, path, staging[0])
        assert spark.read.parquet(path).count() == 99


def test_clustering_by_ranks_survives_an_outlier(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "IF(id = 7, 1e12, cast(hash(id) % 1000 AS double)) AS a", "IF(id % 500 = 0, null, concat('Customer#', lpad(cast(pmod(hash(id, 1), 3000) AS string), 6, '0'))) AS b")
    path = sinks.write_clustered(rows, str(tmp_path / "z"), "a", "b", 16)
    back = spark.read.parquet(path)
    assert back.count() == 20_000 and back.exceptAll(rows).count() == 0
    box = back.where("a < -800 AND b < 'Customer#000300'")
    assert 0 < box.select("_metadata.file_path").distinct().count() <= 4
    sizes = [r["count"] for r in back.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 3 * 20_000 / 16


def test_cuts_of_strings_part_the_rows(spark):
    rows = spark.range(9000).selectExpr("IF(id % 3 = 0, 'hot', concat('Customer#', lpad(cast(id AS string), 9, '0'))) AS s")
    cuts = sinks.rank_cuts(rows, "s", 4)
    assert cuts == sorted(cuts) and 8 <= len(cuts) <= 16
    shares = [r["count"] for r in rows.groupBy(sinks.rank_of(rows, "s", cuts, 4).alias("r")).count().collect()]
    assert len(shares) >= 9 and sorted(shares)[-2] < 9000 / 8  # the common value is alone
    assert sinks.rank_cuts(rows.where("false"), "s") == [] and sinks.rank_cuts(spark.createDataFrame([(None,)], "s string"), "s") == []


def test_every_report_of_a_long_stream(spark):
    feed = scratch_path(spark, "many")
    spark.range(120).repartitionByRange(120, "id").write.parquet(feed)
    listener = ProgressTable(spark)
    spark.streams.addListener(listener)
    try:
        done = S.drain(S.file_stream(spark, feed, "id bigint", files_per_batch=1), lambda batch, i: batch.write.format("noop").mode("overwrite").save())
        reports = listener.of(done)
    finally:
        spark.streams.removeListener(listener)
    facts = summary(reports).first()
    assert facts.batches > 100 and facts.batches == facts.input_rows == 120 and facts.late_rows == 0 and facts.rows_a_second > 0
    assert len(done.recentProgress) <= 100


def events(spark, rows):
    path = scratch_path(spark, "events")
    spark.createDataFrame(rows, "user string, ts timestamp, kind string").write.parquet(path)
    return path


def test_sessions_of_a_state_machine(spark):
    at = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    root = scratch_path(spark, "feed")
    batches = [[("a", at(0), "x"), ("b", at(0), "x"), (None, at(3), "y")], [("a", at(30), "y"), ("a", at(61), "x"), ("b", at(5), None)], [("z", at(100_000), "end")]]
    schema = "user string, ts timestamp, kind string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/part={i}")
    feed = S.file_stream(spark, f"{root}/*", schema, files_per_batch=1)
    got = S.drained(timed_sessions(feed, "user", "ts", "kind", 30 * 60)).where("coalesce(user, '') <> 'z'")
    spans = {(r.user, r.session_start, r.session_end, r.events, r.kinds) for r in got.collect()}
    assert spans == {("a", at(0), at(30), 2, 2), ("a", at(61), at(61), 1, 1), ("b", at(0), at(5), 2, 2), (None, at(3), at(3), 1, 1)}


def test_first_rows_until_state_expires(spark):
    feed, result = scratch_path(spark, "keys"), scratch_path(spark, "first")
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int").coalesce(1).write.parquet(f"{feed}/part=0")
    rows = S.file_stream(spark, f"{feed}/*", "k string, v int")
    query = first_seen(rows, "k", 2).writeStream.option("checkpointLocation", scratch_path(spark, "c")).foreachBatch(S.batch_writer(result)).start()

    def until(n):
        deadline = time.time() + 60
        while time.time() < deadline:
            try:
                got = [tuple(r) for r in spark.read.parquet(result).select("k", "v").collect()]
                if len(got) >= n:
                    return sorted(got)
            except Exception:  # nothing written yet, or a batch is being written
                pass
            time.sleep(1)

    try:
        assert until(2) == [("a", 1), ("b", 2)]
        time.sleep(4)
        spark.createDataFrame([("a", 3)], "k string, v int").coalesce(1).write.parquet(f"{feed}/part=1")
        assert until(3) == [("a", 1), ("a", 3), ("b", 2)]
    finally:
        query.stop()
