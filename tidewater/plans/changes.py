"""Change data, slowly changing dimensions, facts, deletes and incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import day
from tidewater.operators import incremental as I
from tidewater.operators import merge as M
from tidewater.operators.quality import row_hash
from tidewater.plans.bindings import CHANGE_TARGET, CHANGES, CUSTOMERS, ORDERS, change_target, changes, customers, orders
from tidewater.plans.registry import query
from tidewater.session import cut_lineage, scratch_path
from tidewater.sources.sinks import delete_rows, replace_partitions, write_partitioned

LAST_CHANGE = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM {CHANGES}) WHERE rn = 1)"


@query("cdc_merge", f"""SELECT coalesce(s.id, t.id) AS id, CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name, CASE WHEN s.id IS NULL THEN t.city_code ELSE s.city_code END AS city_code
  FROM {CHANGE_TARGET} t FULL JOIN {LAST_CHANGE} s ON t.id = s.id WHERE s.op IS NULL OR s.op <> 'DELETE'""")
def cdc_merge(t):
    return M.cdc_merge(change_target(t), changes(t), "id", "op", ["ts", "event_id"])


@query("merge_upsert", f"""SELECT t.id, CASE WHEN s.op = 'UPDATE' THEN s.name ELSE t.name END AS name, CASE WHEN s.op = 'UPDATE' THEN s.city_code ELSE t.city_code END AS city_code
  FROM {CHANGE_TARGET} t LEFT JOIN {LAST_CHANGE} s ON t.id = s.id WHERE s.op IS DISTINCT FROM 'DELETE'
  UNION ALL SELECT id, name, city_code FROM {LAST_CHANGE} WHERE op = 'INSERT' AND id NOT IN (SELECT id FROM {CHANGE_TARGET})""")
def merge_upsert(t):
    return M.merge_upsert(change_target(t), changes(t), "id", "op", ["ts", "event_id"])


@query("cdc_latest_state", f"SELECT id, name, city_code, op, ts, event_id FROM {LAST_CHANGE} WHERE op <> 'DELETE'")
def cdc_latest_state(t):
    return M.latest_state(changes(t), "id", "op", ["ts", "event_id"])


def envelopes(t):
    """The changes as JSON envelopes, each delete followed by a tombstone."""
    c = changes(t)
    code = F.when(F.col("op") == "DELETE", "d").when(F.col("op") == "INSERT", "c").otherwise("u")
    whole = F.struct("id", "name", "city_code")
    body = F.to_json(F.struct(code.alias("op"), F.when(code == "d", whole).alias("before"), F.when(code != "d", whole).alias("after")))
    both = F.when(code == "d", F.array(body, F.lit(None).cast("string"))).otherwise(F.array(body))
    return c.select("ts", "event_id", F.explode(both).alias("value"))


@query("cdc_debezium", f"SELECT id, name, city_code, op, ts, event_id FROM {LAST_CHANGE} WHERE op <> 'DELETE'")
def cdc_debezium(t):
    flat = M.parse_envelopes(envelopes(t))
    return M.latest_state(flat, "id", "op", ["ts", "event_id"]).select("id", "name", "city_code", "op", "ts", "event_id")


def moved_customers(t):
    """The customer table a day later: some gone, some moved to the next nation, some new."""
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    kept = t.customer.where(c % 11 != 0).select(
        c.alias("customer_id"), "c_name", F.when(c % 7 == 0, (n + 1) % 25).when(c % 26 == 0, None).otherwise(n).cast("bigint").alias("city"))
    new = t.customer.where(c % 13 == 0).select((c + 1_000_000).alias("customer_id"), "c_name", n.cast("bigint").alias("city"))
    return kept.unionByName(new)


MOVED = """(SELECT c_custkey AS customer_id, c_name, (CASE WHEN c_custkey % 7 = 0 THEN (c_nationkey + 1) % 25 WHEN c_custkey % 26 = 0 THEN NULL ELSE c_nationkey END)::BIGINT AS city FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey::BIGINT FROM customer WHERE c_custkey % 13 = 0)"""


def known_customers(t):
    return t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name", F.col("c_nationkey").cast("bigint").alias("city"))


KNOWN = "(SELECT c_custkey AS customer_id, c_name, c_nationkey::BIGINT AS city FROM customer)"


@query("change_feed", f"""WITH a AS {KNOWN}, b AS {MOVED}
  SELECT b.customer_id, 'insert' AS change, b.c_name, b.city FROM b WHERE customer_id NOT IN (SELECT customer_id FROM a)
  UNION ALL SELECT a.customer_id, 'delete', a.c_name, a.city FROM a WHERE customer_id NOT IN (SELECT customer_id FROM b)
  UNION ALL SELECT a.customer_id, 'update_pre', a.c_name, a.city FROM a JOIN b USING (customer_id) WHERE a.city IS DISTINCT FROM b.city
  UNION ALL SELECT b.customer_id, 'update_post', b.c_name, b.city FROM a JOIN b USING (customer_id) WHERE a.city IS DISTINCT FROM b.city""")
def change_feed(t):
    return M.change_feed(known_customers(t), moved_customers(t), "customer_id")


def dimension(t):
    """A type 2 dimension: a closed old version for every third customer, a current one for all but every fifth."""
    c = F.col("customer_id")
    none, date = F.lit(None).cast("date"), lambda s: F.lit(s).cast("date")
    old = known_customers(t).where(c % 3 == 0).withColumn("city", (F.col("city") + 3) % 25)
    now = known_customers(t).where(c % 5 != 0)
    return old.withColumns({"valid_from": date("1990-01-01"), "valid_to": date("1995-01-01"), "is_current": F.lit(False)}).unionByName(
        now.withColumns({"valid_from": date("1995-01-01"), "valid_to": none, "is_current": F.lit(True)}))


DIMENSION = f"""(SELECT customer_id, c_name, (city + 3) % 25 AS city, DATE '1990-01-01' AS valid_from, DATE '1995-01-01' AS valid_to, false AS is_current FROM {KNOWN} WHERE customer_id % 3 = 0
  UNION ALL SELECT customer_id, c_name, city, DATE '1995-01-01', NULL, true FROM {KNOWN} WHERE customer_id % 5 <> 0)"""

SCD2 = f"""(WITH d AS {DIMENSION}, i AS {MOVED}, c AS (SELECT * FROM d WHERE is_current),
  changed AS (SELECT i.customer_id FROM c JOIN i USING (customer_id) WHERE c.city IS DISTINCT FROM i.city)
  SELECT customer_id, c_name, city, valid_from, CASE WHEN is_current AND customer_id IN (SELECT * FROM changed) THEN DATE '1998-01-01' ELSE valid_to END AS valid_to,
    is_current AND customer_id NOT IN (SELECT * FROM changed) AS is_current FROM d
  UNION ALL SELECT customer_id, c_name, city, DATE '1998-01-01', NULL, true FROM i WHERE customer_id IN (SELECT * FROM changed) OR customer_id NOT IN (SELECT customer_id FROM c))"""


def scd2(t):
    return M.scd2_apply(dimension(t), moved_customers(t), "customer_id", ["city"], "1998-01-01")


@query("scd2_apply", f"SELECT * FROM {SCD2}")
def scd2_apply(t):
    return scd2(t)


@query("scd2_hash", f"""SELECT customer_id, valid_from, sha256('=' || c_name || chr(31) || coalesce('=' || city, '~')) AS row_hash, sha256(customer_id || '|' || valid_from) AS surrogate_key FROM {SCD2}""")
def scd2_hash(t):
    return M.scd2_with_keys(scd2(t), "customer_id", ["c_name", "city"]).select("customer_id", "valid_from", "row_hash", "surrogate_key")


@query("scd_type0_1_3", f"""SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, coalesce(a.city, b.city) AS type0, CASE WHEN b.customer_id IS NOT NULL THEN b.city ELSE a.city END AS type1,
  CASE WHEN a.customer_id IS NOT NULL AND b.customer_id IS NOT NULL AND a.city IS DISTINCT FROM b.city THEN a.city END AS previous_city FROM {KNOWN} a FULL JOIN {MOVED} b ON a.customer_id = b.customer_id""")
def scd_type0_1_3(t):
    dim, new = known_customers(t).select("customer_id", "city"), moved_customers(t).select("customer_id", "city")
    zero = M.scd_type0(dim, new, "customer_id", "city").withColumnRenamed("city", "type0")
    one = M.scd_type1(dim, new, "customer_id", "city").withColumnRenamed("city", "type1")
    three = M.scd_type3(dim, new, "customer_id", "city").select("customer_id", "previous_city")
    return zero.join(one, "customer_id").join(three, "customer_id")


@query("scd_type4", f"SELECT a.customer_id, a.city, DATE '1998-01-01' AS archived_on FROM {KNOWN} a JOIN {MOVED} b USING (customer_id) WHERE a.city IS DISTINCT FROM b.city")
def scd_type4(t):
    return M.scd_type4(known_customers(t), moved_customers(t), "customer_id", "city", "1998-01-01")


@query("scd_type6", f"SELECT s.*, n.city AS current_city FROM {SCD2} s LEFT JOIN {SCD2} n ON n.customer_id = s.customer_id AND n.is_current")
def scd_type6(t):
    return M.scd_type6(dimension(t), moved_customers(t), "customer_id", "city", "1998-01-01")


@query("scd_snapshot_check", f"SELECT * FROM {SCD2}")
def scd_snapshot_check(t):
    return M.scd_snapshot(dimension(t), moved_customers(t), "customer_id", "check", ["city"], "1998-01-01")


UPDATED = f"(SELECT customer_id, c_name, city, DATE '1994-06-01' + CAST(customer_id % 400 AS INTEGER) AS updated_at FROM {MOVED})"


@query("scd_snapshot_timestamp", f"""WITH d AS {DIMENSION}, i AS {UPDATED}, c AS (SELECT * FROM d WHERE is_current),
  touched AS (SELECT i.customer_id FROM i LEFT JOIN c USING (customer_id) WHERE c.customer_id IS NULL OR i.updated_at > c.valid_from)
  SELECT customer_id, c_name, city, valid_from, CASE WHEN is_current AND customer_id IN (SELECT * FROM touched) THEN DATE '1998-01-01' ELSE valid_to END AS valid_to,
    is_current AND customer_id NOT IN (SELECT * FROM touched) AS is_current FROM d
  UNION ALL SELECT customer_id, c_name, city, DATE '1998-01-01', NULL, true FROM i WHERE customer_id IN (SELECT * FROM touched)""")
def scd_snapshot_timestamp(t):
    stamped = moved_customers(t).withColumn("updated_at", F.date_add(F.lit("1994-06-01").cast("date"), (F.col("customer_id") % 400).cast("int")))
    return M.scd_snapshot(dimension(t), stamped, "customer_id", "timestamp", ["city"], "1998-01-01", "updated_at")


@query("scd2_validate", f"""WITH v AS (SELECT * FROM {SCD2} UNION ALL SELECT customer_id, c_name, city, DATE '1994-01-01', NULL, false FROM {KNOWN} WHERE customer_id % 50 = 0)
  SELECT customer_id, has_overlap, n AS current_rows FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS n, bool_or(o) AS has_overlap FROM
    (SELECT *, coalesce(valid_from < max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY customer_id ORDER BY valid_from, coalesce(valid_to, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS o FROM v) GROUP BY 1) WHERE has_overlap OR n <> 1""")
def scd2_validate(t):
    extra = known_customers(t).where("customer_id % 50 = 0").withColumns(
        {"valid_from": F.lit("1994-01-01").cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(False)})
    return M.scd2_validate(scd2(t).unionByName(extra), "customer_id")


@query("scd2_fact_lookup", f"""SELECT o.order_id, o.customer_id, d.city, d.valid_from FROM {ORDERS} o JOIN {SCD2} d ON o.customer_id = d.customer_id AND o.order_date >= d.valid_from AND (d.valid_to IS NULL OR o.order_date < d.valid_to)""")
def scd2_fact_lookup(t):
    from tidewater.operators.joins import in_validity

    facts = orders(t).select("order_id", "customer_id", "order_date")
    return in_validity(facts, scd2(t), "customer_id", "order_date", "valid_from", "valid_to").select("order_id", "customer_id", "city", "valid_from")


# ---- facts ----

@query("periodic_snapshot", f"""WITH m AS (SELECT customer_id, date_trunc('month', order_date)::DATE AS m, sum(amount) AS v FROM {ORDERS} GROUP BY 1, 2),
  c AS (SELECT customer_id, unnest(range(min(m)::TIMESTAMP, TIMESTAMP '2001-08-02', INTERVAL 1 MONTH))::DATE AS month FROM m GROUP BY 1)
  SELECT c.customer_id, month, round(sum(v) OVER (PARTITION BY c.customer_id ORDER BY month ROWS UNBOUNDED PRECEDING), 2) AS balance FROM c LEFT JOIN m ON m.customer_id = c.customer_id AND m.m = c.month""")
def periodic_snapshot(t):
    return M.periodic_snapshot(orders(t), "customer_id", "order_date", "amount", F.lit("2001-08-01").cast("date"))


@query("accumulating_snapshot", """SELECT o_orderkey, o_orderdate::DATE AS ordered_on, min(l_shipdate)::DATE AS first_shipped, max(l_shipdate)::DATE AS last_shipped, min(l_shipdate) FILTER (WHERE l_returnflag = 'R')::DATE AS first_return
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def accumulating_snapshot(t):
    steps = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        day(F.min("l_shipdate")).alias("first_shipped"), day(F.max("l_shipdate")).alias("last_shipped"),
        day(F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))).alias("first_return"))
    return t.orders.select("o_orderkey", day("o_orderdate").alias("ordered_on")).join(steps, "o_orderkey", "left")


@query("data_vault_split", """SELECT 'hub' AS part, count(DISTINCT c_custkey) FILTER (WHERE c_custkey % 2 = 1) AS n, min(sha256(c_custkey::VARCHAR)) FILTER (WHERE c_custkey % 2 = 1) AS first_key FROM customer
  UNION ALL SELECT 'link', count(DISTINCT (o_orderkey, o_custkey)), min(sha256(o_orderkey || '|' || o_custkey)) FROM orders
  UNION ALL SELECT 'satellite', count(*), min(sha256(c_custkey::VARCHAR)) FROM customer""")
def data_vault_split(t):
    count = lambda df, part, key: df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))
    known = M.vault_hub(t.customer.where("c_custkey % 2 = 0"), "c_custkey")
    hub = M.vault_hub(t.customer, "c_custkey", existing=known)
    link = M.vault_link(t.orders, ["o_orderkey", "o_custkey"])
    satellite = M.vault_satellite(t.customer, "c_custkey", ["c_name", "c_nationkey"])
    return count(hub, "hub", "hub_key").unionByName(count(link, "link", "link_key")).unionByName(count(satellite, "satellite", "hub_key"))


@query("bronze_silver_gold", "SELECT event_type, ts::DATE AS d, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE value >= 1 GROUP BY 1, 2")
def bronze_silver_gold(t):
    """Raw rows with repeats, then cleaned rows once each, then daily totals; each layer a Parquet folder."""
    from tidewater.operators.medallion import bronze, gold, silver

    raw = bronze(t.events.unionByName(t.events), scratch_path(t.spark, "bronze"), "ts")
    clean = silver(t.spark, raw, scratch_path(t.spark, "silver"), ["event_id"], F.col("value") >= 1, ["ts"])
    return gold(t.spark, clean, ["event_type"], "value")


# ---- deletes, upserts, retention ----

@query("delete_duplicates", f"SELECT customer_id, email FROM (SELECT customer_id, email, CASE WHEN email IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY lower(email) ORDER BY customer_id) END AS rn FROM {CUSTOMERS}) WHERE rn = 1")
def delete_duplicates(t):
    return M.delete_duplicates(customers(t).select("customer_id", "email"), F.lower("email"), "customer_id")


@query("drop_duplicates", "SELECT DISTINCT user_id, event_type FROM events")
def drop_duplicates(t):
    # which row stays is up to Spark, so only the key columns are reported
    return t.events.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("insert_on_conflict", f"""SELECT coalesce(b.customer_id, a.customer_id) AS customer_id, CASE WHEN b.customer_id IS NULL THEN a.city ELSE b.city END AS city,
  CASE WHEN a.customer_id IS NULL THEN 'inserted' WHEN b.customer_id IS NULL OR a.city IS NOT DISTINCT FROM b.city THEN 'unchanged' ELSE 'updated' END AS action FROM {KNOWN} a FULL JOIN {MOVED} b ON a.customer_id = b.customer_id""")
def insert_on_conflict(t):
    return M.insert_on_conflict(known_customers(t).select("customer_id", "city"), moved_customers(t).select("customer_id", "city"), "customer_id")


@query("insert_overwrite", f"SELECT extract(year FROM order_date)::BIGINT AS year, count(*) AS n, round(sum(CASE WHEN extract(year FROM order_date) = 1998 THEN 2 * amount ELSE amount END), 2) AS total FROM {ORDERS} GROUP BY 1")
def insert_overwrite(t):
    o = orders(t).select("order_id", "order_date", "amount").withColumn("month", F.date_format("order_date", "yyyy-MM"))
    path = write_partitioned(o, scratch_path(t.spark, "orders"), ["month"])
    again = o.where(F.year("order_date") == 1998).withColumn("amount", F.col("amount") * 2)
    replace_partitions(again, path, ["month"])
    back = t.spark.read.schema(o.schema).parquet(path)
    return back.groupBy(F.year("order_date").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("delete_subject", """WITH s AS (SELECT c_custkey FROM customer WHERE c_acctbal < -900), o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM s))
  SELECT 'customer' AS table_name, count(*) AS before_rows, count(*) FILTER (WHERE c_custkey NOT IN (SELECT * FROM s)) AS after_rows FROM customer
  UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE o_custkey NOT IN (SELECT * FROM s)) FROM orders
  UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_orderkey NOT IN (SELECT * FROM o)) FROM lineitem""")
def delete_subject(t):
    subjects = t.customer.where("c_acctbal < -900").select("c_custkey")
    their_orders = t.orders.join(subjects, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    parts = [("customer", t.customer, "c_custkey", subjects, "c_custkey"), ("orders", t.orders, "o_custkey", subjects, "c_custkey"), ("lineitem", t.lineitem, "l_orderkey", their_orders, "o_orderkey")]
    # who goes is known before the first table changes
    gone_of = {name: cut_lineage(gone) for name, _, _, gone, _ in parts}
    audits = []
    for name, df, key, _, _ in parts:
        path = scratch_path(t.spark, name)
        df.repartitionByRange(16, key).write.parquet(path)
        audits.append((name, *delete_rows(t.spark, path, key, gone_of[name]), t.spark.read.schema(df.schema).parquet(path).count()))
    return t.spark.createDataFrame(audits, "table_name string, before_rows bigint, after_rows bigint, counted_rows bigint").where("after_rows = counted_rows").drop("counted_rows")


@query("retention_ttl", f"""SELECT status, order_date AS period, 'detail' AS grain, 1::BIGINT AS n, round(amount, 2) AS amount FROM {ORDERS} WHERE order_date >= DATE '2001-08-01' - 365
  UNION ALL SELECT status, date_trunc('month', order_date)::DATE, 'month', count(*), round(sum(amount), 2) FROM {ORDERS} WHERE order_date < DATE '2001-08-01' - 365 GROUP BY 1, 2""")
def retention_ttl(t):
    cutoff = F.date_sub(F.lit("2001-08-01").cast("date"), 365)
    return M.retention(orders(t), "order_date", cutoff, ["status"], "amount")


@query("collapse_sign", """WITH s AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS sign FROM events), alive AS (SELECT user_id, event_type FROM s GROUP BY 1, 2 HAVING sum(sign) > 0),
  r AS (SELECT s.*, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM s JOIN alive USING (user_id, event_type) WHERE sign = 1) SELECT user_id, event_type, value FROM r WHERE n = 1""")
def collapse_sign(t):
    signed = t.events.withColumn("sign", F.when(F.col("event_id") % 3 == 0, -1).otherwise(1))
    return M.collapse_sign(signed, ["user_id", "event_type"], "sign", ["ts", "event_id"], ["value"])


# ---- incremental loads ----

def ntz(s):
    return F.expr(f"TIMESTAMP_NTZ'{s}'")


@query("incremental_watermark", "SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def incremental_watermark(t):
    return I.newer_than(t.events.select("event_id", "ts", "user_id"), "ts", ntz("2024-01-20"))


@query("next_watermark", "SELECT max(ts) AS watermark, count(*) AS loaded FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def next_watermark(t):
    return I.next_watermark(t.events, "ts", ntz("2024-01-20"))


@query("metadata_ingest", """SELECT 'events' AS source, count(*) AS n, max(event_id) AS last_key FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
  UNION ALL SELECT 'orders', count(*), max(o_orderkey) FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00' UNION ALL SELECT 'customer', count(*), max(c_custkey) FROM customer""")
def metadata_ingest(t):
    sources = [
        (I.Feed("events", ("event_id",), since="ts"), ntz("2024-01-15")),
        (I.Feed("orders", ("o_orderkey",), since="o_orderdate"), ntz("2001-01-01")),
        (I.Feed("customer", ("c_custkey",)), None),
    ]
    out = None
    for feed, mark in sources:
        loaded = I.ingest(getattr(t, feed.table), feed, mark)
        line = loaded.agg(F.lit(feed.table).alias("source"), F.count(F.lit(1)).alias("n"), F.max(feed.keys[0]).alias("last_key"))
        out = line if out is None else out.unionByName(line)
    return out


@query("idempotent_batch", """WITH d AS (SELECT DISTINCT event_type, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-03'), p AS (SELECT DISTINCT event_type, user_id FROM events WHERE ts < TIMESTAMP '2024-01-03')
  SELECT event_type, user_id, sha256('=' || event_type || chr(31) || '=' || user_id) AS record_hash FROM (SELECT * FROM d EXCEPT SELECT * FROM p)""")
def idempotent_batch(t):
    cols = ["event_type", "user_id"]
    earlier = t.events.where(F.col("ts") < ntz("2024-01-03")).select(row_hash(cols).alias("record_hash"))
    return I.unseen(t.events.where(F.col("ts") >= ntz("2024-01-03")), cols, earlier)


DAYS = "(SELECT ts::DATE AS d, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2)"


@query("incremental_strategies", f"""WITH e AS (SELECT d, event_type, n, 0.0::DOUBLE AS total FROM {DAYS} WHERE d <= DATE '2024-01-20'), b AS (SELECT * FROM {DAYS} WHERE d >= DATE '2024-01-18' AND event_type <> 'error'),
  r AS (SELECT 'append' AS strategy, * FROM e UNION ALL SELECT 'append', * FROM b
    UNION ALL SELECT 'merge', * FROM e WHERE (d, event_type) NOT IN (SELECT d, event_type FROM b) UNION ALL SELECT 'merge', * FROM b
    UNION ALL SELECT 'delete+insert', * FROM e WHERE d NOT IN (SELECT d FROM b) UNION ALL SELECT 'delete+insert', * FROM b)
  SELECT strategy, count(*) AS n_rows, round(sum(total), 2) AS total FROM r GROUP BY 1""")
def incremental_strategies(t):
    days = t.events.groupBy(day("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    existing = days.where("d <= DATE '2024-01-20'").withColumn("total", F.lit(0.0))
    batch = days.where("d >= DATE '2024-01-18' AND event_type <> 'error'")
    out = None
    for strategy in ("append", "merge", "delete+insert"):
        after = I.apply_increment(existing, batch, strategy, ["d", "event_type"], "d")
        line = after.agg(F.lit(strategy).alias("strategy"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("total"), 2).alias("total"))
        out = line if out is None else out.unionByName(line)
    return out


@query("backfill_ranges", """WITH b AS (SELECT l_suppkey, min(l_shipdate)::DATE AS lo, max(l_shipdate)::DATE AS hi FROM lineitem GROUP BY 1),
  c AS (SELECT l_suppkey, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM b EXCEPT SELECT l_suppkey, l_shipdate::DATE FROM lineitem),
  g AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY d) AS INTEGER) AS g FROM c) SELECT l_suppkey, min(d) AS range_start, max(d) AS range_end, count(*) AS days FROM g GROUP BY l_suppkey, g""")
def backfill_ranges(t):
    """Days of each supplier without a shipment, as ranges to load again."""
    return I.backfill_ranges(t.lineitem, "l_shipdate", t.lineitem, "l_shipdate", ["l_suppkey"])
