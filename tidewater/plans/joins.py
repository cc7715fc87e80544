"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import epoch_micros
from tidewater.operators import joins as J
from tidewater.operators.ranking import quantiles, top_n
from tidewater.operators.skew import bounded_cross, lookup_join, pairs_within, salted_join, split_hot_join
from tidewater.plans.bindings import (
    CUSTOMERS, EMPLOYEES, ORDERS, SUBSCRIPTIONS, employees, orders, products, subscriptions,
)
from tidewater.plans.registry import query

def placed(t):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))


def names(t):
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))


@query("join_inner", "SELECT c_custkey AS customer_id, c_name AS customer_name, o_orderkey AS order_id, o_totalprice AS amount FROM customer JOIN orders ON c_custkey = o_custkey")
def join_inner(t):
    return names(t).join(orders(t), "customer_id").select("customer_id", "customer_name", "order_id", "amount")


@query("join_left", f"SELECT c_custkey AS customer_id, c_name AS customer_name, o_orderkey AS order_id FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def join_left(t):
    return names(t).join(placed(t), "customer_id", "left").select("customer_id", "customer_name", "order_id")


@query("join_right", "SELECT c_name AS customer_name, o_orderkey AS order_id FROM customer RIGHT JOIN orders ON c_custkey = o_custkey")
def join_right(t):
    return names(t).join(orders(t), "customer_id", "right").select("customer_name", "order_id")


@query("join_full", f"""WITH a AS (SELECT o_custkey AS customer_id, count(*) AS n_orders FROM orders GROUP BY 1),
  b AS (SELECT c_custkey AS customer_id, c_acctbal AS balance FROM customer) SELECT customer_id, n_orders, balance FROM a FULL JOIN b USING (customer_id)""")
def join_full(t):
    # a full join cannot split a busy key, so each side brings one row per key
    a = placed(t).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance"))
    return a.join(b, "customer_id", "full")


@query("join_cross", "SELECT p_partkey AS product_id, r_regionkey AS region_id, r_name AS region FROM part CROSS JOIN region")
def join_cross(t):
    regions = t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))
    return bounded_cross(t.part.select(F.col("p_partkey").alias("product_id")), regions)


@query("join_self_manager", f"SELECT e.employee_id, e.employee_name, m.employee_name AS manager_name FROM {EMPLOYEES} e LEFT JOIN {EMPLOYEES} m ON e.manager_id = m.employee_id")
def join_self_manager(t):
    m = employees(t).select(F.col("employee_id").alias("manager_id"), F.col("employee_name").alias("manager_name"))
    return employees(t).join(m, "manager_id", "left").select("employee_id", "employee_name", "manager_name")


@query("earn_more_than_manager", f"SELECT e.employee_id, e.salary, m.employee_name AS manager_name, m.salary AS manager_salary FROM {EMPLOYEES} e JOIN {EMPLOYEES} m ON e.manager_id = m.employee_id WHERE e.salary > m.salary")
def earn_more_than_manager(t):
    m = employees(t).select(F.col("employee_id").alias("manager_id"), F.col("employee_name").alias("manager_name"), F.col("salary").alias("manager_salary"))
    return employees(t).join(m, "manager_id").where("salary > manager_salary").select("employee_id", "salary", "manager_name", "manager_salary")


@query("pairs_same_manager", f"SELECT a.manager_id, a.employee_id AS a, b.employee_id AS b FROM {EMPLOYEES} a JOIN {EMPLOYEES} b ON a.manager_id = b.manager_id AND a.employee_id < b.employee_id")
def pairs_same_manager(t):
    return pairs_within(employees(t), ["manager_id"], "employee_id")


@query("join_semi", f"SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_semi(t):
    return names(t).join(placed(t), "customer_id", "left_semi")


@query("exists", f"SELECT c_custkey AS customer_id FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def exists(t):
    large = placed(t).alias("o")
    found = large.where(F.col("o.customer_id") == F.col("c_custkey").outer())
    return t.customer.where(found.exists()).select(F.col("c_custkey").alias("customer_id"))


@query("join_anti", "SELECT doc_id, lang FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def join_anti(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_anti")


@query("not_exists", f"SELECT n_nationkey::BIGINT AS department_id, n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM {EMPLOYEES} e WHERE e.department_id = n_nationkey AND salary > 9950)")
def not_exists(t):
    rich = employees(t).where("salary > 9950").alias("e")
    found = rich.where(F.col("e.department_id") == F.col("n_nationkey").outer())
    return t.nation.where(~found.exists()).select(F.col("n_nationkey").cast("bigint").alias("department_id"), "n_name")


@query("anti_left_join_null", "SELECT vec_id, label FROM embeddings LEFT JOIN labels ON vec_id = doc_id WHERE doc_id IS NULL")
def anti_left_join_null(t):
    # the outer join with a null test, written as the anti join that it is
    return t.embeddings.select("vec_id", "label").join(t.labels.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_anti")


@query("not_in_null_aware", f"""SELECT 'with_null' AS listed, count(*) AS n FROM {EMPLOYEES} WHERE employee_id NOT IN (SELECT manager_id FROM {EMPLOYEES})
  UNION ALL SELECT 'without_null', count(*) FROM {EMPLOYEES} WHERE employee_id NOT IN (SELECT manager_id FROM {EMPLOYEES} WHERE manager_id IS NOT NULL)""")
def not_in_null_aware(t):
    e, m = employees(t).select("employee_id"), employees(t).select("manager_id")
    n = lambda df, label: df.agg(F.lit(label).alias("listed"), F.count(F.lit(1)).alias("n"))
    known = m.where("manager_id IS NOT NULL")
    return n(J.not_in(e, "employee_id", m, "manager_id"), "with_null").unionByName(n(J.not_in(e, "employee_id", known, "manager_id"), "without_null"))


BY_NATION = "SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"


@query("join_broadcast", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast(t):
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup_join(t.customer, n, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query("join_salted", "SELECT c_custkey AS customer_id, c_name AS customer_name, o_orderkey AS order_id, o_totalprice AS amount FROM customer JOIN orders ON c_custkey = o_custkey")
def join_salted(t):
    return salted_join(orders(t), names(t), ["customer_id"], F.col("order_id")).select("customer_id", "customer_name", "order_id", "amount")


@query("split_hot_keys", "SELECT p_brand, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def split_hot_keys(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    joined = split_hot_join(lines, t.part.select("p_partkey", "p_brand"), "p_partkey")
    return joined.groupBy("p_brand").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("join_interval_overlap", f"SELECT a.customer_id, a.subscription_id AS a, b.subscription_id AS b FROM {SUBSCRIPTIONS} a JOIN {SUBSCRIPTIONS} b ON a.customer_id = b.customer_id AND a.subscription_id < b.subscription_id AND a.start_date <= b.end_date AND b.start_date <= a.end_date")
def join_interval_overlap(t):
    return J.overlapping(subscriptions(t), ["customer_id"], "subscription_id", "start_date", "end_date")


@query("basket_pairs", """WITH i AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
  SELECT a.l_partkey AS a, b.l_partkey AS b, count(*) AS pair_count FROM i a JOIN i b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def basket_pairs(t):
    return J.basket_pairs(t.lineitem, "l_orderkey", "l_partkey", 10)


@query("join_asof", """SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.value AS click_value
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def join_asof(t):
    p = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    c = t.events.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return J.asof_join(p, c, ["user_id"], epoch_micros("ts"), epoch_micros("ts"), "click_id", ["click_id", "click_value"])


@query("join_point_in_time", """SELECT p.event_id, p.user_id, CASE WHEN p.ts - c.ts <= INTERVAL 1 DAY THEN c.value END AS feature
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def join_point_in_time(t):
    p = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    c = t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("feature"))
    day_micros = 86_400_000_000
    return J.asof_join(p, c, ["user_id"], epoch_micros("ts"), epoch_micros("ts"), "view_id", ["feature"], day_micros).drop("ts")


@query("join_lateral_topn", """SELECT c_custkey, e.event_id, e.ts FROM (SELECT DISTINCT user_id AS c_custkey FROM events) u, LATERAL (SELECT event_id, ts FROM events WHERE user_id = u.c_custkey ORDER BY ts DESC, event_id DESC LIMIT 3) e""")
def join_lateral_topn(t):
    few = t.events.select(F.col("user_id").alias("c_custkey"), "event_id", "ts")
    return top_n(few, ["c_custkey"], [F.desc("ts"), F.desc("event_id")], 3)


@query("join_any", """SELECT c_custkey AS customer_id, c_name AS customer_name, order_id, amount FROM customer
  JOIN (SELECT o_custkey, o_orderkey AS order_id, o_totalprice AS amount, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) ON c_custkey = o_custkey WHERE rn = 1""")
def join_any(t):
    one = orders(t).select("customer_id", "order_id", "amount")
    return J.any_join(names(t), one, "customer_id", ["order_id"])


@query("join_bought_a_not_b", """SELECT o_custkey AS customer_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1 HAVING bool_or(p_brand = 'Brand#1') AND NOT bool_or(p_brand = 'Brand#2')""")
def join_bought_a_not_b(t):
    brands = t.part.where(F.col("p_brand").isin("Brand#1", "Brand#2")).select("p_partkey", "p_brand")
    bought = t.lineitem.select("l_orderkey", "l_partkey").join(brands, F.col("l_partkey") == F.col("p_partkey"))
    per_order = bought.groupBy("l_orderkey").agg(F.bool_or(F.col("p_brand") == "Brand#1").alias("a"), F.bool_or(F.col("p_brand") == "Brand#2").alias("b"))
    owners = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    return per_order.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("customer_id").agg(
        F.bool_or("a").alias("a"), F.bool_or("b").alias("b")).where("a AND NOT b").select("customer_id")


@query("join_dup_columns", f"SELECT customer_id, customer_name, n FROM {CUSTOMERS} JOIN (SELECT customer_id, count(*) AS n FROM {ORDERS} GROUP BY 1) USING (customer_id)")
def join_dup_columns(t):
    # joining on the name keeps a single key column
    n = orders(t).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return names(t).join(n, "customer_id").select("customer_id", "customer_name", "n")


@query("join_cross_bounds", f"SELECT o.order_id, o.amount FROM {ORDERS} o CROSS JOIN (SELECT round(sum(amount), 2) / count(*) AS mean FROM {ORDERS}) b WHERE amount > 1.9 * mean")
def join_cross_bounds(t):
    o = orders(t).select("order_id", "amount")
    mean = o.agg(F.round(F.sum("amount"), 2) / F.count(F.lit(1))).scalar()
    return o.where(F.col("amount") > F.lit(1.9) * mean)


@query("iqr_outliers", """WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
  SELECT event_id, value FROM events, b WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def iqr_outliers(t):
    q = quantiles(t.events, [], "value", {"q1": 0.25, "q3": 0.75}).first()
    reach = 1.5 * (q["q3"] - q["q1"])
    return t.events.select("event_id", "value").where((F.col("value") < q["q1"] - reach) | (F.col("value") > q["q3"] + reach))


@query("join_strategy_hints", " UNION ALL ".join(f"SELECT '{h}' AS strategy, n_name, orders, total FROM ({BY_NATION})" for h in ("broadcast", "merge", "shuffle_hash")))
def join_strategy_hints(t):
    def by_nation(hint):
        sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
        c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
        joined = sums.join(c.hint(hint), "c_custkey").groupBy("n_nationkey").agg(F.sum("n").alias("orders"), F.sum("s").alias("s"))
        return joined.join(t.nation.select("n_nationkey", "n_name"), "n_nationkey").select(F.lit(hint).alias("strategy"), "n_name", "orders", F.round("s", 2).alias("total"))

    # the broadcast hint is given only after the size of the side was checked
    from tidewater.operators.skew import is_small

    first = by_nation("broadcast") if is_small(t.customer.select("c_custkey")) else by_nation("merge").withColumn("strategy", F.lit("broadcast"))
    return first.unionByName(by_nation("merge")).unionByName(by_nation("shuffle_hash"))


@query("join_galaxy_star", """WITH a AS (SELECT c_nationkey AS k, count(*) AS orders, round(sum(o_totalprice), 2) AS sold FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
  b AS (SELECT s_nationkey AS k, count(*) AS lines, round(sum(l_extendedprice), 2) AS supplied FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
  SELECT n_name, orders, sold, lines, supplied FROM a FULL JOIN b USING (k) JOIN nation ON n_nationkey = k""")
def join_galaxy_star(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    a = per_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("k")), F.col("o_custkey") == F.col("c_custkey"))
    a = a.groupBy("k").agg(F.sum("n").alias("orders"), F.round(F.sum("s"), 2).alias("sold"))
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("s"))
    b = per_supplier.join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("k")), F.col("l_suppkey") == F.col("s_suppkey"))
    b = b.groupBy("k").agg(F.sum("n").alias("lines"), F.round(F.sum("s"), 2).alias("supplied"))
    both = J.drill_across(a, b, ["k"])
    return both.join(t.nation, F.col("k") == F.col("n_nationkey")).select("n_name", "orders", "sold", "lines", "supplied")


@query("bridge_weighted", """WITH w AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
  SELECT l_suppkey, count(*) AS lines, round(sum(o_totalprice * (1.0::DOUBLE / n)), 2) AS allocated FROM lineitem JOIN w USING (l_orderkey) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def bridge_weighted(t):
    lines = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("c"))
    n = lines.groupBy("l_orderkey").agg(F.sum("c").alias("n"))
    paid = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    share = lines.join(n.join(paid, "l_orderkey"), "l_orderkey")
    return share.groupBy("l_suppkey").agg(F.sum("c").alias("lines"), F.round(F.sum(F.col("c") * F.col("o_totalprice") * (F.lit(1.0) / F.col("n"))), 2).alias("allocated"))


@query("join_bloom_prefilter", f"SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def join_bloom_prefilter(t):
    # the key set goes first as a semi join; on large inputs Spark adds its own Bloom filter to the scan
    wanted = placed(t).select(F.col("order_id").alias("l_orderkey"))
    kept = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice").join(wanted, "l_orderkey", "left_semi")
    return kept.groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
