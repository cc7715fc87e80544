"""Sources and sinks: each writes part of the tables below the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.operators.control import plan_text
from tidewater.plans.bindings import ORDERS, orders
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import readers as R
from tidewater.sources import sinks as W
from tidewater.sources.paginated import PagedSource

BY_STATUS = f"SELECT status, count(*) AS n, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY 1"


def by_status(df):
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


def file_count(spark, path, glob="*.parquet"):
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return listing.select("path").count()


# ---- sources ----

@query("src_parquet", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2")
def src_parquet(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("src_csv_header", "SELECT c_custkey, c_name || ', \"Inc\"' AS c_name, c_acctbal FROM customer")
def src_csv_header(t):
    path = scratch_path(t.spark, "csv")
    c = t.customer.select("c_custkey", F.concat("c_name", F.lit(', "Inc"')).alias("c_name"), "c_acctbal")
    c.write.option("header", True).option("escape", '"').csv(path)
    return R.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


def _bad_csv(t):
    """Events as CSV in which every fiftieth value is not a number."""
    path = scratch_path(t.spark, "bad-csv")
    value = F.when(F.col("event_id") % 50 == 0, F.lit("abc")).otherwise(F.col("value").cast("string"))
    t.events.select("event_id", "event_type", value.alias("value")).write.option("header", True).csv(path)
    return path, "event_id bigint, event_type string, value double"


@query("src_csv_bad_records", """SELECT event_id, event_type, CASE WHEN event_id % 50 <> 0 THEN value END AS value, CASE WHEN event_id % 50 = 0 THEN event_id || ',' || event_type || ',abc' END AS _corrupt FROM events""")
def src_csv_bad_records(t):
    return R.read_csv_marked(t.spark, *_bad_csv(t))


@query("src_csv_drop_malformed", "SELECT event_id, event_type, value FROM events WHERE event_id % 50 <> 0")
def src_csv_drop_malformed(t):
    return R.read_csv_marked(t.spark, *_bad_csv(t), mode="DROPMALFORMED")


@query("quarantine_split", "SELECT 'good' AS route, NULL::VARCHAR AS reason, count(*) AS n FROM events WHERE event_id % 50 <> 0 UNION ALL SELECT 'quarantine', 'malformed line', count(*) FROM events WHERE event_id % 50 = 0")
def quarantine_split(t):
    root = R.split_bad(R.read_csv_marked(t.spark, *_bad_csv(t)), scratch_path(t.spark, "routed-csv"))
    return t.spark.read.parquet(root).groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("src_json", "SELECT event_id, event_type, value FROM events")
def src_json(t):
    path = scratch_path(t.spark, "json")
    t.events.select("event_id", "event_type", "value").write.json(path)
    return R.read_json(t.spark, path, "event_id bigint, event_type string, value double")


@query("src_text_lines", "SELECT lang, sum(len(string_split(text, chr(10))))::BIGINT AS lines FROM documents GROUP BY 1")
def src_text_lines(t):
    path = scratch_path(t.spark, "text")
    t.documents.select("lang", "text").write.partitionBy("lang").text(path)
    per_file = R.line_counts(t.spark, path)
    lang = F.regexp_extract("file", "lang=([^/]+)/", 1)
    return per_file.groupBy(lang.alias("lang")).agg(F.sum("lines").alias("lines"))


@query("src_multi_file", "SELECT extract(year FROM o_orderdate)::BIGINT AS year, count(*) AS n FROM orders WHERE extract(year FROM o_orderdate) IN (1996, 1999) GROUP BY 1")
def src_multi_file(t):
    root = scratch_path(t.spark, "tree")
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    W.write_partitioned(o, root, ["year", "month"])
    both = R.read_tree(t.spark, [f"{root}/year=1996", f"{root}/year=1999"], "o_orderkey bigint")
    year = F.regexp_extract("file", "year=([0-9]+)", 1).cast("bigint")
    return both.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("src_paginated", "SELECT o_orderkey, o_orderstatus FROM orders")
def src_paginated(t):
    root = scratch_path(t.spark, "pages")
    page = (F.floor(F.col("o_orderkey") / 1000) + 1).alias("page")
    t.orders.select("o_orderkey", "o_orderstatus", page).repartition("page").write.partitionBy("page").json(root)
    t.spark.dataSource.register(PagedSource)
    return t.spark.read.format("pages").schema("o_orderkey bigint, o_orderstatus string").option("root", root).load()


@query("src_inline", "SELECT code, count(*) AS n FROM customer JOIN (VALUES ('BUILDING', 'B'), ('MACHINERY', 'M'), ('HOUSEHOLD', 'H')) v(segment, code) ON c_mktsegment = segment GROUP BY 1")
def src_inline(t):
    codes = t.spark.createDataFrame([("BUILDING", "B"), ("MACHINERY", "M"), ("HOUSEHOLD", "H")], "c_mktsegment string, code string")
    return t.customer.select("c_mktsegment").join(F.broadcast(codes), "c_mktsegment").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("src_generate", "WITH h AS (SELECT unnest(range(date_trunc('hour', (SELECT min(ts) FROM events))::TIMESTAMP, (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) AS hour) SELECT h.hour, count(event_id) AS n FROM h LEFT JOIN events ON time_bucket(INTERVAL '1 hour', ts) = h.hour GROUP BY 1")
def src_generate(t):
    """Every hour between the first and the last event, also those in which nothing happened."""
    hourly = t.events.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    counts = hourly.select(F.col("w.start").alias("hour"), "n")
    bounds = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    hours = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL '1' HOUR"))).alias("hour"))
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


def _orders_lake(t, label="lake"):
    o = orders(t).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    return W.write_partitioned(o, scratch_path(t.spark, label), ["month"]), o.schema


@query("src_partition_pruned", f"SELECT status, count(*) AS n, round(sum(amount), 2) AS total, true AS pruned FROM {ORDERS} WHERE order_date >= DATE '1998-01-01' AND order_date < DATE '1998-02-01' GROUP BY 1")
def src_partition_pruned(t):
    path, schema = _orders_lake(t)
    got = by_status(t.spark.read.schema(schema).parquet(path).where("month = '1998-01'"))
    plan = plan_text(got)
    return got.withColumn("pruned", F.lit("PartitionFilters: [isnotnull(month" in plan))


# ---- sinks ----

@query("snk_parquet_partitioned", f"SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS n FROM {ORDERS} GROUP BY 1")
def snk_parquet_partitioned(t):
    path, schema = _orders_lake(t)
    return t.spark.read.schema(schema).parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("snk_dynamic_overwrite", f"SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (WHERE order_date >= DATE '2001-07-01') AS refreshed FROM {ORDERS} GROUP BY 1")
def snk_dynamic_overwrite(t):
    o = orders(t).select("order_id", "order_date", F.lit(0).alias("version"), F.date_format("order_date", "yyyy-MM").alias("month"))
    path = W.write_partitioned(o, scratch_path(t.spark, "overwrite"), ["month"])
    W.replace_partitions(o.where("order_date >= DATE'2001-07-01'").withColumn("version", F.lit(1)), path, ["month"])
    back = t.spark.read.schema(o.schema).parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("version").alias("refreshed"))


@query("snk_file_size", f"SELECT status, count(*) AS n, true AS files_bounded FROM {ORDERS} GROUP BY 1")
def snk_file_size(t):
    path = W.write_partitioned(orders(t), scratch_path(t.spark, "sized"), ["status"], rows_per_file=1000)
    back = t.spark.read.parquet(path)
    per_file = back.groupBy("status", F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("status").agg(F.sum("n").alias("n"), (F.max("n") <= 1000).alias("files_bounded"))


@query("snk_partitioned_json", f"SELECT status, count(*) AS n, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY 1")
def snk_partitioned_json(t):
    path = W.write_partitioned(orders(t), scratch_path(t.spark, "json-lake"), ["status"], fmt="json")
    return by_status(t.spark.read.schema("order_id bigint, amount double, status string").json(path))


@query("snk_csv_to_json", f"SELECT order_id, customer_id, amount, amount >= 100000 AS is_high_value FROM {ORDERS}")
def snk_csv_to_json(t):
    source, target = scratch_path(t.spark, "orders-csv"), scratch_path(t.spark, "orders-json")
    schema = "order_id bigint, customer_id bigint, amount double"
    orders(t).select("order_id", "customer_id", "amount").write.option("header", True).csv(source)
    R.read_csv(t.spark, source, schema).withColumn("is_high_value", F.col("amount") >= 100000).write.json(target)
    return R.read_json(t.spark, target, f"{schema}, is_high_value boolean")


@query("compact_small_files", f"SELECT *, true AS fewer_files FROM ({BY_STATUS})")
def compact_small_files(t):
    many, few = scratch_path(t.spark, "small-files"), scratch_path(t.spark, "compacted")
    orders(t).repartition(32).write.parquet(many)
    W.compact(t.spark, many, few)
    fewer = file_count(t.spark, few) < file_count(t.spark, many)
    return by_status(t.spark.read.parquet(few)).withColumn("fewer_files", F.lit(fewer))


@query("snk_bucketed", "SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS no_shuffle_for_join FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def snk_bucketed(t):
    tag = uuid.uuid4().hex[:8]
    a, b = f"tidewater_orders_{tag}", f"tidewater_customer_{tag}"
    W.write_bucketed(t.orders.select(F.col("o_custkey").alias("custkey"), "o_totalprice"), a, scratch_path(t.spark, a), 8, "custkey")
    W.write_bucketed(t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment"), b, scratch_path(t.spark, b), 8, "custkey")
    joined = t.spark.table(a).join(t.spark.table(b).hint("merge"), "custkey")
    free = "Exchange" not in plan_text(joined)
    sums = joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.withColumn("no_shuffle_for_join", F.lit(free))


@query("snk_clustered", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS files_skipped FROM orders WHERE o_custkey < (SELECT max(c_custkey) FROM customer) / 10 AND o_totalprice < 50000")
def snk_clustered(t):
    """Files along the Z curve of two columns: a box of both touches only some of them."""
    files = 16
    path = W.write_clustered(t.orders, scratch_path(t.spark, "clustered"), "o_custkey", "o_totalprice", files)
    back = t.spark.read.schema(t.orders.schema).parquet(path)
    limit = t.customer.agg(F.max("c_custkey")).first()[0] / 10
    box = back.where((F.col("o_custkey") < limit) & (F.col("o_totalprice") < 50000))
    touched = box.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return box.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.lit(touched < files / 2).alias("files_skipped"))


@query("snk_multi_format", " UNION ALL ".join(f"SELECT '{f}' AS format, count(*) AS n, round(sum(amount), 2) AS total FROM {ORDERS}" for f in ("parquet", "orc", "json", "csv")))
def snk_multi_format(t):
    o = orders(t).select("order_id", "amount", "status")
    out = None
    for fmt in ("parquet", "orc", "json", "csv"):
        path = scratch_path(t.spark, f"as-{fmt}")
        o.write.format(fmt).save(path)
        back = t.spark.read.schema(o.schema).format(fmt).load(path)
        line = back.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))
        out = line if out is None else out.unionByName(line)
    return out


@query("load_history", "SELECT 'first' AS load, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'second', count(*) FROM orders WHERE o_orderkey % 2 = 1")
def load_history(t):
    """Two loads of a growing folder; the second sees only the files that the log does not list."""
    spark, folder, log = t.spark, scratch_path(t.spark, "landing"), scratch_path(t.spark, "load-log")
    spark.createDataFrame([], "path string, load string").write.parquet(log)
    out = scratch_path(spark, "loaded")
    for i, name in enumerate(("first", "second")):
        t.orders.where(F.col("o_orderkey") % 2 == i).write.parquet(f"{folder}/drop={i}")
        fresh = W.load_new_files(spark, folder, spark.read.parquet(log))
        fresh.withColumn("load", F.lit(name)).write.mode("append").parquet(out)
        seen = spark.read.parquet(out).where(F.col("load") == name).select("path", "load").distinct()
        seen.write.mode("append").parquet(log)
    return spark.read.parquet(out).groupBy("load").agg(F.count(F.lit(1)).alias("n"))
