"""Streaming queries. Each runs a stream over the events table to its end and returns what it wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions.dates import as_wall_clock, day
from tidewater.operators import merge as M
from tidewater.operators.ordered import ordered, running
from tidewater.plans.bindings import CHANGE_TARGET, change_target
from tidewater.plans.changes import LAST_CHANGE
from tidewater.plans.registry import query
from tidewater.plans.windows import SESSIONS
from tidewater.session import scratch_path
from tidewater.sources.tables import SCHEMAS
from tidewater.streaming import jobs as S
from tidewater.streaming.processors import timed_sessions
from tidewater.streaming.watching import ProgressTable, summary

SENTINEL = {"event_id": -1, "ts": dt.datetime(2100, 1, 1), "user_id": -1, "event_type": "sentinel", "value": 0.0, "props": "{}"}
REAL = "event_type <> 'sentinel'"


def raw_stream(t):
    return S.file_stream(t.spark, t.path("events"), SCHEMAS["events"])


def stream(t, sentinel=True):
    e = raw_stream(t)
    if sentinel:
        e = S.with_sentinel(t.spark, e, SENTINEL, SCHEMAS["events"])
    return S.instant(e, "ts")


def window_start(df):
    return df.withColumn("window_start", as_wall_clock("window.start")).drop("window")


def sliced_feed(t, cuts=("2024-01-10", "2024-01-20")):
    """The events as files written one after another, in time order."""
    root = scratch_path(t.spark, "feed")
    marks = ["1900-01-01", *cuts, "2200-01-01"]
    for i, (lo, hi) in enumerate(zip(marks, marks[1:])):
        part = t.events.where((F.col("ts") >= F.expr(f"TIMESTAMP_NTZ'{lo}'")) & (F.col("ts") < F.expr(f"TIMESTAMP_NTZ'{hi}'")))
        part.write.mode("append").parquet(f"{root}/part={i}")
    return root


# ---- windows ----

@query("stream_tumbling", "SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling(t):
    return window_start(S.drained(S.tumbling(stream(t, False), "ts", "10 minutes", ["event_type"]), "complete"))


@query("stream_sliding", """SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL '1 hour', ts), time_bucket(INTERVAL '1 hour', ts) - INTERVAL 1 HOUR, time_bucket(INTERVAL '1 hour', ts) - INTERVAL 2 HOUR]) AS w FROM events) GROUP BY 1, 2""")
def stream_sliding(t):
    return window_start(S.drained(S.sliding(stream(t), "ts", "3 hours", "1 hour", ["event_type"]), "append").where(REAL))


@query("stream_session", f"SELECT user_id, session_start, session_end, events FROM ({SESSIONS})")
def stream_session(t):
    made = S.drained(S.session(stream(t), "ts", "30 minutes", ["user_id"]), "append").where("user_id >= 0")
    return made.select("user_id", as_wall_clock("window.start").alias("session_start"), as_wall_clock("last_event").alias("session_end"), F.col("n").alias("events"))


@query("stream_watermark_late", """WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events WHERE event_id % 10 <> 0)
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS n FROM events, m WHERE event_id % 10 <> 0 OR time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR > date_trunc('millisecond', wm) GROUP BY 1""")
def stream_watermark_late(t):
    """Nine tenths of the events come first; the rest come when the watermark has passed nearly all of them and are dropped."""
    spark, root = t.spark, scratch_path(t.spark, "late-feed")
    result, checkpoint = scratch_path(spark, "late-result"), scratch_path(spark, "late-checkpoint")
    counted = lambda: S.tumbling(S.instant(S.file_stream(spark, f"{root}/*", SCHEMAS["events"]), "ts"), "ts", "1 hour", [], delay="1 hour")
    far = spark.createDataFrame([tuple(SENTINEL.values())], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    for i, part in enumerate([t.events.where("event_id % 10 <> 0"), t.events.where("event_id % 10 = 0"), far]):
        part.write.parquet(f"{root}/part{i}")
        S.drain(counted(), S.batch_writer(result), "append", checkpoint)
    return window_start(spark.read.parquet(result).drop("batch")).where("window_start < TIMESTAMP_NTZ'2099-01-01'")


MODES = "SELECT event_type, count(*) AS n FROM events GROUP BY 1"


@query("stream_output_modes", " UNION ALL ".join(f"SELECT '{m}' AS mode, count(*) AS n_groups, sum(n)::BIGINT AS total FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, count(*) AS n FROM events GROUP BY 1)" for m in ("append", "update", "complete")))
def stream_output_modes(t):
    out = None
    for mode in ("append", "update", "complete"):
        counted = S.tumbling(stream(t), "ts", "1 hour", [])
        got = S.drained(counted, mode, keys=["window"]).where("window.start < '2099-01-01'")
        line = got.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("total"))
        out = line if out is None else out.unionByName(line)
    return out


@query("stream_velocity", """SELECT w AS window_start, event_type, count(*) AS n, true AS users_plausible FROM (SELECT event_type, unnest([time_bucket(INTERVAL '1 day', ts), time_bucket(INTERVAL '1 day', ts) - INTERVAL 1 DAY]) AS w FROM events) GROUP BY 1, 2""")
def stream_velocity(t):
    e = stream(t).withWatermark("ts", "10 minutes")
    counted = e.groupBy(F.window("ts", "2 days", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user_id").alias("users"))
    got = S.drained(counted, "append").where(REAL)
    return window_start(got.withColumn("users_plausible", (F.col("users") > 0) & (F.col("users") <= F.col("n") * 1.1 + 1)).drop("users"))


@query("stream_median", "SELECT event_type, quantile_disc(value, 0.5) AS median FROM events GROUP BY 1")
def stream_median(t):
    counted = stream(t, False).groupBy("event_type").agg(F.percentile_approx("value", 0.5, 100_000).alias("median"))
    return S.drained(counted, "complete")


@query("stream_top_n", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def stream_top_n(t):
    counted = stream(t, False).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return S.drained(counted, "complete").orderBy(F.desc("n"), "user_id").limit(10)


# ---- stateless, files, restart ----

@query("stream_stateless_map", "SELECT event_id, user_id, CASE WHEN user_id % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS tier FROM events")
def stream_stateless_map(t):
    tier = F.when(F.col("user_id") % 2 == 0, "EVEN").otherwise("ODD")
    return S.to_parquet(raw_stream(t).select("event_id", "user_id", tier.alias("tier")))


@query("stream_files", "SELECT event_id, ts, value FROM events")
def stream_files(t):
    e = S.file_stream(t.spark, f"{sliced_feed(t)}/*", SCHEMAS["events"], files_per_batch=2)
    return S.drained(e.select("event_id", "ts", "value"))


@query("stream_available_now", "SELECT count(*) AS n, round(sum(value), 2) AS total, true AS several_batches FROM events")
def stream_available_now(t):
    spark, path = t.spark, scratch_path(t.spark, "available")
    e = S.file_stream(spark, f"{sliced_feed(t)}/*", SCHEMAS["events"], files_per_batch=1)
    S.drain(e.select("event_id", "value"), S.batch_writer(path))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), (F.max("batch") >= 2).alias("several_batches"))


@query("stream_checkpoint_restart", "SELECT event_id, user_id, 1::BIGINT AS times FROM events")
def stream_checkpoint_restart(t):
    """Two runs with the same checkpoint and a new file between them; every event is written once."""
    spark, root = t.spark, scratch_path(t.spark, "restart-feed")
    result, checkpoint = scratch_path(spark, "restart-result"), scratch_path(spark, "restart-checkpoint")
    middle = F.expr("TIMESTAMP_NTZ'2024-01-16'")
    for i, part in enumerate([t.events.where(F.col("ts") < middle), t.events.where(F.col("ts") >= middle)]):
        part.write.parquet(f"{root}/part{i}")
        e = S.file_stream(spark, f"{root}/*", SCHEMAS["events"])
        S.drain(e.select("event_id", "user_id"), S.batch_writer(result), checkpoint=checkpoint)
    return spark.read.parquet(result).groupBy("event_id", "user_id").agg(F.count(F.lit(1)).alias("times"))


@query("stream_progress", "SELECT count(*) + 1 AS input_rows, 0::BIGINT AS late_rows, 1::BIGINT AS batches, (max(ts)::DATE + 27000)::VARCHAR > '2090' AS watermark_moved, 1::BIGINT AS state_rows, true AS has_rate FROM events")
def stream_progress(t):
    """A stream's reports from the table that a listener writes."""
    listener = ProgressTable(t.spark)
    t.spark.streams.addListener(listener)
    try:
        windows = S.tumbling(stream(t), "ts", "1 hour", ["event_type"])
        reports = listener.of(S.drain(windows, S.batch_writer(scratch_path(t.spark, "progress"))))
    finally:
        t.spark.streams.removeListener(listener)
    facts = summary(reports)
    return facts.select("input_rows", "late_rows", "batches", (F.col("watermark") > "2090").alias("watermark_moved"), "state_rows", (F.col("rows_a_second") > 0).alias("has_rate"))


# ---- state, duplicates, joins ----

@query("stream_dedup", "SELECT event_id, user_id FROM events")
def stream_dedup(t):
    twice = raw_stream(t).unionByName(raw_stream(t))
    return S.drained(S.deduplicated(S.instant(twice, "ts"), "ts", ["event_id"]).select("event_id", "user_id"))


@query("stream_stateful", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_stateful(t):
    e = stream(t)
    made = S.drained(S.summarise_until_idle(e, "user_id", "ts", "value", "30 days")).where("user_id >= 0")
    return made.withColumn("total", F.round("total", 2))


@query("stream_state_machine", """WITH o AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM o) SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events, count(DISTINCT event_type) AS kinds FROM s GROUP BY user_id, no""")
def stream_state_machine(t):
    """Sessions by a state processor with a value, a map and a timer."""
    made = S.drained(timed_sessions(stream(t), "user_id", "ts", "event_type", 12 * 3600)).where("user_id >= 0")
    return made.withColumns({c: as_wall_clock(c) for c in ("session_start", "session_end")})


@query("join_stream_static", "SELECT c_mktsegment, count(*) AS n, round(sum(value), 2) AS total FROM events JOIN customer ON user_id = c_custkey GROUP BY 1")
def join_stream_static(t):
    c = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    joined = stream(t, False).join(c, "user_id").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return S.drained(joined, "complete")


PAIRS = """(SELECT p.event_id AS purchase_id, c.event_id AS click_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p {how} JOIN (SELECT * FROM events WHERE event_type = 'click') c
  ON p.user_id = c.user_id AND c.ts <= p.ts AND c.ts >= p.ts - INTERVAL 2 HOUR)"""


def _stream_pairs(t, how):
    # every stream gets the sentinel under its own type, so both watermarks pass all real rows
    kind = lambda k: stream(t).where(F.col("event_type").isin(k, "sentinel"))
    p = kind("purchase").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    c = kind("click").select(F.col("user_id").alias("right_user_id"), F.col("ts").alias("right_ts"), F.col("event_id").alias("click_id"))
    made = S.drained(S.interval_join(p, c, "user_id", "ts", "right_ts", "2 hours", "1 hour", how))
    return made.where("purchase_id >= 0").select("purchase_id", "click_id")


@query("join_stream_stream", "SELECT * FROM " + PAIRS.format(how="INNER"))
def join_stream_stream(t):
    return _stream_pairs(t, "inner")


@query("join_stream_stream_left", "SELECT * FROM " + PAIRS.format(how="LEFT"))
def join_stream_stream_left(t):
    return _stream_pairs(t, "leftOuter")


# ---- merging sinks, dead letters, schemas ----

@query("stream_foreach_merge", f"""SELECT coalesce(s.id, t.id) AS id, CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name, CASE WHEN s.id IS NULL THEN t.city_code ELSE s.city_code END AS city_code
  FROM {CHANGE_TARGET} t FULL JOIN {LAST_CHANGE} s ON t.id = s.id WHERE s.op IS NULL OR s.op <> 'DELETE'""")
def stream_foreach_merge(t):
    spark, path = t.spark, scratch_path(t.spark, "merged")
    change_target(t).write.parquet(f"{path}/v=0")
    kind = F.col("event_type")
    op = F.when(kind == "error", "DELETE").when(kind == "signup", "INSERT").otherwise("UPDATE")
    feed = S.file_stream(spark, f"{sliced_feed(t)}/*", SCHEMAS["events"], files_per_batch=1)
    flat = feed.select(F.col("user_id").alias("id"), kind.alias("name"), F.col("value").alias("city_code"), op.alias("op"), "ts", "event_id")
    merge = lambda old, batch: M.cdc_merge(old, batch, "id", "op", ["ts", "event_id"])
    S.drain(flat, S.merging_sink(spark, path, merge))
    return S.newest_version(spark, path)


@query("incremental_mv", "SELECT event_type, ts::DATE AS d, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def incremental_mv(t):
    """A daily summary kept up to date batch by batch: old and new partial sums are added."""
    spark, path = t.spark, scratch_path(t.spark, "view")
    spark.createDataFrame([], "event_type string, d date, n bigint, total double").write.parquet(f"{path}/v=0")

    def merge(old, batch):
        new = batch.groupBy("event_type", day("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        return old.unionByName(new).groupBy("event_type", "d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    feed = S.file_stream(spark, f"{sliced_feed(t)}/*", SCHEMAS["events"], files_per_batch=1)
    S.drain(feed.select("event_type", "ts", "value"), S.merging_sink(spark, path, merge))
    return S.newest_version(spark, path).withColumn("total", F.round("total", 2))


@query("stream_dlq", "SELECT CASE WHEN event_id % 20 = 0 THEN 'dead_letter' ELSE 'good' END AS route, count(*) AS n FROM events GROUP BY 1")
def stream_dlq(t):
    """Every twentieth message is broken JSON."""
    spark, path = t.spark, scratch_path(t.spark, "routed")
    message = F.when(F.col("event_id") % 20 == 0, F.lit("{broken")).otherwise(F.col("props"))
    e = raw_stream(t).select("event_id", message.alias("message")).withColumn("k", F.get_json_object("message", "$.k").cast("bigint"))
    S.drain(e, S.splitting_sink(path, F.col("k").isNull()))
    return spark.read.parquet(path).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("stream_schema_change", "SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN '{\"extra\":\"' || event_type || '\"}' END AS rescued FROM events")
def stream_schema_change(t):
    """Messages of the newer producer carry a field that the schema does not know."""
    old, new = F.to_json(F.struct("event_id", "user_id")), F.to_json(F.struct("event_id", "user_id", F.col("event_type").alias("extra")))
    body = raw_stream(t).select(F.when(F.col("event_id") % 2 == 1, new).otherwise(old).alias("value"))
    return S.drained(S.rescued(body, "value", "event_id bigint, user_id bigint", ["event_id", "user_id"]))


@query("stream_kafka", "SELECT event_id, user_id, event_type, value, user_id::VARCHAR AS key FROM events")
def stream_kafka(t):
    """Rows in the shape the Kafka source gives, parsed as a topic would be."""
    e = raw_stream(t)
    shaped = e.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    parsed = S.parse_kafka(shaped, "event_id bigint, user_id bigint, event_type string, value double")
    return S.drained(parsed.select("event_id", "user_id", "event_type", "value", "key"))


@query("snk_foreach_batch", "SELECT event_type, count(*) AS n, 2::BIGINT AS sinks FROM events GROUP BY 1")
def snk_foreach_batch(t):
    """One batch written to two places; running the sink again for the same batch changes nothing."""
    spark = t.spark
    first, second = scratch_path(spark, "fan-a"), scratch_path(spark, "fan-b")

    def both(batch, batch_id):
        for path in (first, second):
            S.batch_writer(path)(batch, batch_id)
            S.batch_writer(path)(batch, batch_id)

    S.drain(raw_stream(t).select("event_id", "event_type"), both)
    a, b = spark.read.parquet(first), spark.read.parquet(second)
    counts = a.unionByName(b).groupBy("event_type", "event_id").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("c").alias("sinks"))


@query("event_fold", "SELECT event_id, user_id, round(sum(CASE event_type WHEN 'purchase' THEN -value WHEN 'signup' THEN value ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS balance FROM events")
def event_fold(t):
    """State of an account after each of its events."""
    kind, v = F.col("event_type"), F.col("value")
    delta = F.when(kind == "purchase", -v).when(kind == "signup", v).otherwise(F.lit(0.0))
    e = t.events.select("event_id", "user_id", "ts", delta.alias("delta"))
    folded = running(ordered(e, ["user_id"], ["ts", "event_id"]), {"balance": ("sum", F.col("delta"))}).result()
    return folded.select("event_id", "user_id", F.round("balance", 2).alias("balance"))


@query("stream_event_fold", "SELECT user_id, count(*) AS events, round(sum(CASE event_type WHEN 'purchase' THEN -value WHEN 'signup' THEN value ELSE 0 END), 2) AS balance FROM events GROUP BY 1")
def stream_event_fold(t):
    """The same state kept by a stream that sees the events file by file."""
    kind, v = F.col("event_type"), F.col("value")
    delta = F.when(kind == "purchase", -v).when(kind == "signup", v).otherwise(F.lit(0.0))
    e = S.file_stream(t.spark, f"{sliced_feed(t)}/*", SCHEMAS["events"], files_per_batch=1)
    state = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.sum(delta).alias("balance"))
    return S.drained(state, "update", keys=["user_id"]).withColumn("balance", F.round("balance", 2))
