"""Scalar functions, nested data, user functions and execution control."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidewater.functions import dates as D
from tidewater.functions import jsons as J
from tidewater.functions import strings as S
from tidewater.functions import udfs as U
from tidewater.functions.text import jaccard, trigrams
from tidewater.operators.quality import row_hash
from tidewater.operators.skew import skew_report as hot_report
from tidewater.plans.bindings import CUSTOMERS, ORDERS, PRODUCT_REVENUE, customers, orders, product_revenue
from tidewater.plans.registry import query
from tidewater.session import cut_lineage

# ---- strings ----

@query("clean_column_names", f"SELECT customer_id AS customer_id, customer_name AS customer_name, city AS home_city FROM {CUSTOMERS}")
def clean_column_names(t):
    c = customers(t)
    return S.clean_column_names(c.select(F.col("customer_id").alias(" Customer-ID "), F.col("customer_name").alias("Customer Name"), F.col("city").alias("HOME CITY")))


@query("mask_email", f"""WITH e AS (SELECT customer_id, CASE WHEN customer_id % 9 = 0 THEN 'ab@x.com' ELSE email END AS email FROM {CUSTOMERS} WHERE email IS NOT NULL)
  SELECT customer_id, CASE WHEN strpos(email, '@') <= 3 THEN repeat('*', strpos(email, '@') - 1) ELSE substr(email, 1, 1) || repeat('*', strpos(email, '@') - 3) || substr(email, strpos(email, '@') - 1, 1) END || '@' || split_part(email, '@', 2) AS masked FROM e""")
def mask_email(t):
    known = customers(t).where("email IS NOT NULL")
    email = F.when(F.col("customer_id") % 9 == 0, F.lit("ab@x.com")).otherwise(F.col("email"))
    return known.select("customer_id", S.mask_email(email).alias("masked"))


@query("valid_phone", "SELECT c_custkey, length(regexp_replace(p, '[^0-9]', '', 'g')) BETWEEN 10 AND 13 AS valid FROM (SELECT c_custkey, '+91-' || CAST(c_custkey * c_custkey * 7919 AS VARCHAR) AS p FROM customer)")
def valid_phone(t):
    phone = F.concat(F.lit("+91-"), (F.col("c_custkey") * F.col("c_custkey") * 7919).cast("string"))
    return t.customer.select("c_custkey", S.valid_phone(phone).alias("valid"))


@query("email_domain", f"SELECT customer_id, email, split_part(email, '@', 2) AS domain FROM {CUSTOMERS} WHERE email IS NOT NULL")
def email_domain(t):
    return customers(t).where("email IS NOT NULL").select("customer_id", "email", S.email_domain("email").alias("domain"))


@query("string_basics", "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand_no, split_part(p_name, ' ', 1) AS first_word, concat_ws('-', p_brand, p_type) AS tag FROM part")
def string_basics(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.regexp_replace("p_brand", "[^0-9]", "").alias("brand_no"),
        F.split("p_name", " ")[0].alias("first_word"), F.concat_ws("-", "p_brand", "p_type").alias("tag"))


@query("trigram_similarity", """WITH n AS (SELECT DISTINCT p_name FROM part), g AS (SELECT p_name, list_distinct(list_transform(range(1, length(p_name) + 2), lambda i: substr('  ' || lower(p_name) || ' ', i::BIGINT, 3))) AS g FROM n),
  q AS (SELECT list_distinct(list_transform(range(1, length('smal widgit') + 2), lambda i: substr('  smal widgit ', i::BIGINT, 3))) AS q)
  SELECT p_partkey, part.p_name, len(list_intersect(g, q))::DOUBLE / len(list_distinct(list_concat(g, q))) AS similarity FROM part JOIN g USING (p_name), q WHERE len(list_intersect(g, q))::DOUBLE / len(list_distinct(list_concat(g, q))) >= 0.3""")
def trigram_similarity(t):
    sim = jaccard(trigrams("p_name"), trigrams(F.lit("smal widgit")))
    return t.part.select("p_partkey", "p_name", sim.alias("similarity")).where("similarity >= 0.3")


@query("url_parse", """SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS protocol, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
  CASE WHEN strpos(regexp_replace(url, '#.*$', ''), '?') > 0 THEN regexp_extract(url, '[?]([^#]*)', 1) END AS query FROM pages""")
def url_parse(t):
    return t.pages.select("page_id", *[c.alias(n) for n, c in S.url_parts("url").items()])


@query("url_clean", """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])((utm_[a-z]+|ref)=[^&]*&?)+', '\\1', 'g'), '[?&]$', '') AS url FROM pages""")
def url_clean(t):
    return t.pages.select("page_id", S.without_tracking("url").alias("url"))


@query("log_parse", """WITH l AS (SELECT event_id, ts::DATE AS d, upper(event_type) AS level, user_id, value FROM events)
  SELECT event_id, d, level, user_id, value, CASE level WHEN 'ERROR' THEN 'page' WHEN 'SIGNUP' THEN 'notify' ELSE 'none' END AS route, 'user=***' AS redacted FROM l""")
def log_parse(t):
    """Events as log lines, taken apart again, routed and redacted."""
    line = F.concat_ws(" ", D.day("ts").cast("string"), F.upper("event_type"), F.concat(F.lit("user="), F.col("user_id")), F.concat(F.lit("value="), F.col("value")))
    raw = t.events.select("event_id", line.alias("line"))
    part = lambda i: F.regexp_extract("line", r"^(\S+) (\S+) user=(\d+) value=(\S+)$", i)
    level = part(2)
    return raw.select(
        "event_id", part(1).cast("date").alias("d"), level.alias("level"), part(3).cast("bigint").alias("user_id"), part(4).cast("double").alias("value"),
        F.when(level == "ERROR", "page").when(level == "SIGNUP", "notify").otherwise("none").alias("route"),
        F.regexp_extract(F.regexp_replace("line", r"user=\d+", "user=***"), r"(user=\S+)", 1).alias("redacted"))


# ---- dates ----

@query("date_trunc", f"SELECT order_id, date_trunc('month', order_date)::DATE AS month, date_trunc('week', order_date)::DATE AS week, date_trunc('quarter', order_date)::DATE AS quarter FROM {ORDERS}")
def date_trunc(t):
    return orders(t).select("order_id", D.month("order_date").alias("month"), D.week("order_date").alias("week"), F.trunc("order_date", "quarter").alias("quarter"))


@query("extract", f"SELECT order_id, extract(year FROM order_date)::BIGINT AS y, extract(month FROM order_date)::BIGINT AS m, extract(isodow FROM order_date)::BIGINT AS dow FROM {ORDERS}")
def extract(t):
    return orders(t).select("order_id", F.year("order_date").cast("bigint").alias("y"), F.month("order_date").cast("bigint").alias("m"), (F.weekday("order_date") + 1).cast("bigint").alias("dow"))


@query("date_format", f"SELECT order_id, strftime(order_date, '%Y-%m') AS ym, strftime(order_date, '%d/%m/%Y') AS dmy FROM {ORDERS}")
def date_format(t):
    return orders(t).select("order_id", F.date_format("order_date", "yyyy-MM").alias("ym"), F.date_format("order_date", "dd/MM/yyyy").alias("dmy"))


@query("date_arith", "SELECT event_id, ts + INTERVAL 30 MINUTE AS later, date_diff('day', DATE '2024-01-01', ts::DATE) AS days, epoch_us(ts) AS micros FROM events")
def date_arith(t):
    return t.events.select("event_id", (F.col("ts") + F.expr("INTERVAL '30' MINUTE")).alias("later"), D.days_between(D.day("ts"), F.lit("2024-01-01").cast("date")).alias("days"), D.epoch_micros("ts").alias("micros"))


@query("to_utc", "SELECT event_id, ts - INTERVAL 330 MINUTE AS utc FROM events")
def to_utc(t):
    return t.events.select("event_id", D.to_utc("ts", "Asia/Kolkata").alias("utc"))


@query("date_dimension", f"""WITH d AS (SELECT unnest(range((SELECT min(order_date) FROM {ORDERS})::TIMESTAMP, (SELECT max(order_date) FROM {ORDERS})::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d)
  SELECT d AS date_key, extract(year FROM d)::BIGINT AS year, extract(quarter FROM d)::BIGINT AS quarter, extract(month FROM d)::BIGINT AS month, extract(day FROM d)::BIGINT AS day_of_month, extract(isodow FROM d)::BIGINT AS iso_weekday, extract(isodow FROM d) >= 6 AS is_weekend, last_day(d) = d AS is_month_end FROM d""")
def date_dimension(t):
    return D.date_attributes(D.calendar_of(t.orders, "o_orderdate"), "d")


# ---- numbers, arrays, maps, JSON, hashes ----

@query("nullif_div", "SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem")
def nullif_div(t):
    return t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), "l_partkey", "l_suppkey", F.try_divide("l_extendedprice", "l_discount").alias("ratio"))


@query("pct_and_round", f"SELECT status, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM orders) AS pct, round(round(sum(amount), 2) * 0.18, 0) AS tax FROM {ORDERS} GROUP BY 1")
def pct_and_round(t):
    o = orders(t)
    # a negative amount is an error, not a row to skip
    checked = F.when(F.col("amount") < 0, F.raise_error("amount must not be negative")).otherwise(F.col("amount"))
    per = o.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(checked), 2).alias("s"))
    total = o.agg(F.count(F.lit(1))).scalar()
    return per.select("status", (F.lit(100.0) * F.col("n") / total).alias("pct"), F.round(F.col("s") * 0.18, 0).alias("tax"))


@query("decimal_money", "SELECT o_orderstatus, CAST(sum(o_totalprice::DECIMAL(20,4)) AS VARCHAR) AS exact FROM orders GROUP BY 1")
def decimal_money(t):
    return t.orders.groupBy("o_orderstatus").agg(F.sum(F.col("o_totalprice").cast("decimal(20,4)")).cast("string").alias("exact"))


@query("surrogate_id", "SELECT c_custkey, sha256(c_name || '|' || c_nationkey) AS hash_key, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS surrogate_id FROM customer")
def surrogate_id(t):
    from tidewater.operators.ranking import numbered

    c = t.customer.select("c_custkey", "c_acctbal", F.sha2(F.concat_ws("|", "c_name", "c_nationkey"), 256).alias("hash_key"))
    return numbered(c, "c_acctbal", "c_custkey", "surrogate_id", descending=False).drop("c_acctbal")


@query("explode", "SELECT vec_id, label::BIGINT AS label, pos, v::DOUBLE AS v FROM (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings)")
def explode(t):
    e = t.embeddings.select("vec_id", F.col("label").cast("bigint").alias("label"), F.posexplode("embedding").alias("pos", "v"))
    return e.select("vec_id", "label", F.col("pos").cast("bigint").alias("pos"), F.col("v").cast("double").alias("v"))


@query("higher_order", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS positive, len(list_distinct(list_transform(embedding, lambda x: x > 0))) AS signs, round(list_max(list_transform(embedding, lambda x: x::DOUBLE * 100)), 4) AS peak FROM embeddings")
def higher_order(t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id", F.size(F.filter(e, lambda x: x > 0)).cast("bigint").alias("positive"),
        F.size(F.array_distinct(F.transform(e, lambda x: x > 0))).cast("bigint").alias("signs"),
        F.round(F.array_max(F.transform(e, lambda x: x.cast("double") * 100)), 4).alias("peak"))


@query("sequence_salts", "SELECT s_suppkey, unnest(range(0, 5)) AS salt FROM supplier")
def sequence_salts(t):
    return t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))).alias("salt"))


@query("map_access", "SELECT event_id, props::JSON->>'k' AS k, CASE WHEN event_type = 'error' THEN 'high' ELSE 'low' END AS level FROM events")
def map_access(t):
    base = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("level"), F.lit("low"))
    louder = F.when(F.col("event_type") == "error", F.create_map(F.lit("level"), F.lit("high"))).otherwise(F.create_map().cast("map<string,string>"))
    m = J.merged(base, louder)
    return t.events.select("event_id", m["k"].alias("k"), m["level"].alias("level"))


@query("json_extract", "SELECT event_id, props->>'k' AS k_text, (props->>'k')::DOUBLE AS k FROM events")
def json_extract(t):
    k = F.get_json_object("props", "$.k")
    return t.events.select("event_id", k.alias("k_text"), k.cast("double").alias("k"))


@query("variant_extract", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def variant_extract(t):
    return t.events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


@query("flatten_json", "SELECT o_orderkey AS id, o_orderstatus AS info_status, o_orderpriority AS info_priority, l_partkey AS lines_part, l_quantity AS lines_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def flatten_json(t):
    """Orders as nested documents with at most a page of lines each, flattened again; orders without lines stay."""
    page = 1000
    from tidewater.operators.ordered import ordered, running

    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rn = running(ordered(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]), {"rn": ("count", F.lit(1))}).result()
    held = rn.groupBy(F.col("l_orderkey").alias("id"), F.floor((F.col("rn") - 1) / page).alias("page")).agg(
        F.collect_list(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))).alias("lines"))
    info = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    docs = t.orders.select(F.col("o_orderkey").alias("id"), info.alias("info")).join(held, "id", "left").drop("page")
    text = docs.select(F.to_json(F.struct("id", "info", "lines")).alias("doc"))
    schema = "id bigint, info struct<status string, priority string>, lines array<struct<part bigint, quantity double>>"
    return J.flatten(text.select(F.from_json("doc", schema).alias("d")).select("d.*"))


@query("json_path_filter", "SELECT l_orderkey, count(*) AS dear FROM lineitem WHERE l_extendedprice > 50000 GROUP BY 1")
def json_path_filter(t):
    """Items of a JSON array above a price; an order's items come as one array per line number."""
    item = F.to_json(F.array(F.struct(F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"))))
    docs = t.lineitem.select("l_orderkey", item.alias("items"))
    parsed = F.from_json("items", "array<struct<part:bigint,price:double>>")
    dear = F.size(F.filter(parsed, lambda i: i["price"] > 50000))
    return docs.select("l_orderkey", dear.alias("d")).where("d > 0").groupBy("l_orderkey").agg(F.sum("d").alias("dear"))


@query("json_containment", "SELECT event_id, props->>'k' = '5' AS is_five, true AS has_k, '{\"k\":\"' || (props->>'k') || '\",\"type\":\"' || event_type || '\"}' AS merged FROM events")
def json_containment(t):
    m = J.as_map("props")
    extra = F.create_map(F.lit("type"), F.col("event_type"))
    return t.events.select("event_id", J.contains(F.col("props"), {"k": "5"}).alias("is_five"), F.map_contains_key(m, "k").alias("has_k"), F.to_json(J.merged(m, extra)).alias("merged"))


@query("record_hash", "SELECT c_custkey, sha256('=' || c_mktsegment || chr(31) || '=' || c_name || chr(31) || '=' || c_nationkey) AS record_hash FROM customer")
def record_hash(t):
    return t.customer.select("c_custkey", row_hash(["c_name", "c_nationkey", "c_mktsegment"]).alias("record_hash"))


@query("hash_bucket", "SELECT count(*) AS n, true AS every_bucket_used, true AS even FROM orders")
def hash_bucket(t):
    per = t.orders.groupBy(F.pmod(F.xxhash64("o_orderkey"), F.lit(16)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return per.agg(total.alias("n"), (F.count(F.lit(1)) == 16).alias("every_bucket_used"), (F.max("n") < 2 * total / 16).alias("even"))


# ---- user functions ----

@query("add_tax", "SELECT o_orderkey, o_totalprice * 1.18::DOUBLE AS with_tax, true AS udf_agrees FROM orders")
def add_tax(t):
    native, vectorised = U.with_tax("o_totalprice"), U.add_tax("o_totalprice")
    both = t.orders.select("o_orderkey", native.alias("with_tax"), vectorised.alias("u"))
    return both.select("o_orderkey", "with_tax", (F.abs(F.col("u") - F.col("with_tax")) < 1e-6).alias("udf_agrees"))


@query("python_udf", "SELECT p_partkey, upper(substr(split_part(p_name, ' ', 1), 1, 1) || substr(split_part(p_name, ' ', 2), 1, 1)) AS initials FROM part")
def python_udf(t):
    return t.part.select("p_partkey", U.initials("p_name").alias("initials"))


@query("udaf_weighted", "SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS weighted_discount FROM lineitem GROUP BY 1")
def udaf_weighted(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(U.weighted_mean("l_discount", "l_quantity"), 8).alias("weighted_discount"))


@query("udtf_split", "SELECT p_partkey, pos AS position, token FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token, unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part)")
def udtf_split(t):
    made = t.part.lateralJoin(U.SplitTokens(F.col("p_name").outer(), F.lit(" ")))
    return made.select("p_partkey", F.col("position").cast("bigint").alias("position"), "token")


@query("batch_apply", "SELECT o_orderkey, o_totalprice > 250000 AS large FROM orders")
def batch_apply(t):
    score = lambda b: b.assign(large=b["o_totalprice"] > 250000)[["o_orderkey", "large"]]
    return U.in_batches(t.orders.select("o_orderkey", "o_totalprice"), score, "o_orderkey bigint, large boolean")


@query("sql_function", "SELECT o_orderkey, round(o_totalprice / 1000, 1) AS thousands FROM orders")
def sql_function(t):
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tidewater_thousands(x DOUBLE) RETURNS DOUBLE RETURN round(x / 1000, 1)")
    return t.orders.selectExpr("o_orderkey", "tidewater_thousands(o_totalprice) AS thousands")


# ---- execution control ----

@query("explain_plan", "SELECT o_orderstatus, count(*) AS n, true AS filter_pushed, true AS columns_pruned FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def explain_plan(t):
    """The result with what its own plan shows about the scan."""
    from tidewater.operators.control import plan_text

    df = t.orders.where("o_totalprice > 100000").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    plan = plan_text(df)
    return df.withColumns({"filter_pushed": F.lit("GreaterThan(o_totalprice,100000.0)" in plan), "columns_pruned": F.lit("o_orderpriority" not in plan)})


@query("repartition_coalesce", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, 12 AS spread, 3 AS fewer FROM orders")
def repartition_coalesce(t):
    from tidewater.operators.control import partitions_used

    wide = t.orders.repartition(12, "o_custkey")
    few = t.orders.repartition(12).coalesce(3)
    spread, fewer = partitions_used(wide, upper=12), partitions_used(few, upper=3)
    sums = wide.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.select("n", "total", spread.scalar().alias("spread"), fewer.scalar().alias("fewer"))


@query("cache_persist", f"SELECT status, count(*) AS n, (SELECT count(*) FROM {ORDERS}) AS large FROM {ORDERS} GROUP BY 1")
def cache_persist(t):
    # kept in memory and on disk while two results are made of it, then released
    kept = orders(t).select("status").persist(StorageLevel.MEMORY_AND_DISK)
    large = kept.count()
    out = cut_lineage(kept.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("large", F.lit(large)))
    kept.unpersist()
    return out


@query("checkpoint", f"SELECT category, count(*) AS n, round(sum(revenue), 2) AS total FROM {PRODUCT_REVENUE} GROUP BY 1")
def checkpoint(t):
    return cut_lineage(product_revenue(t)).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("revenue"), 2).alias("total"))


@query("skew_report", "SELECT user_id, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def skew_report(t):
    return hot_report(t.events, "user_id")


@query("temp_views", f"SELECT country, count(*) AS n FROM {CUSTOMERS} JOIN (SELECT customer_id FROM {ORDERS} GROUP BY 1 HAVING sum(amount) > 2500000) USING (customer_id) GROUP BY 1")
def temp_views(t):
    customers(t).createOrReplaceTempView("tidewater_customers")
    orders(t).createOrReplaceTempView("tidewater_orders")
    return t.spark.sql(
        """WITH large AS (SELECT customer_id FROM tidewater_orders GROUP BY customer_id HAVING sum(amount) > 2500000)
           SELECT country, count(*) AS n FROM tidewater_customers JOIN large USING (customer_id) GROUP BY country""")
