"""Projections, filters, sorts, limits, set operations and plain aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import day, days_between, month, week
from tidewater.operators.steps import run_steps
from tidewater.operators.ranking import top_n
from tidewater.plans.bindings import (
    CUSTOMERS, EMPLOYEES, ITEMS, ORDERS, PRODUCT_REVENUE, customers, employees, items, orders, product_revenue,
)
from tidewater.plans.registry import query


# ---- projections and filters ----

@query("select_all", f"SELECT * FROM {CUSTOMERS}")
def select_all(t):
    return customers(t)


@query("select_cols_where", f"SELECT customer_id, customer_name, city FROM {CUSTOMERS} WHERE status = 'BUILDING'")
def select_cols_where(t):
    return customers(t).where(F.col("status") == "BUILDING").select("customer_id", "customer_name", "city")


@query("filter_date_from", f"SELECT order_id, customer_id, order_date, amount FROM {ORDERS} WHERE order_date >= DATE '2000-01-01'")
def filter_date_from(t):
    # the bound is compared with the stored column, so it reaches the Parquet scan
    recent = t.orders.where(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ'2000-01-01'"))
    return recent.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        day("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("amount"),
    )


@query("filter_is_null", f"SELECT customer_id, customer_name FROM {CUSTOMERS} WHERE email IS NULL")
def filter_is_null(t):
    return customers(t).where(F.col("email").isNull()).select("customer_id", "customer_name")


@query("distinct_values", f"SELECT DISTINCT city FROM {CUSTOMERS}")
def distinct_values(t):
    return customers(t).select("city").distinct()


@query("case_tier", f"SELECT order_id, amount, CASE WHEN amount >= 300000 THEN 'HIGH' WHEN amount >= 100000 THEN 'MID' ELSE 'LOW' END AS tier FROM {ORDERS}")
def case_tier(t):
    tier = F.when(F.col("amount") >= 300000, "HIGH").when(F.col("amount") >= 100000, "MID").otherwise("LOW")
    return orders(t).select("order_id", "amount", tier.alias("tier"))


@query("filter_between", f"SELECT order_id, order_date FROM {ORDERS} WHERE order_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'")
def filter_between(t):
    # half open, so that the last day keeps its hours when the column is a timestamp
    lo, hi = F.expr("TIMESTAMP_NTZ'1998-01-01'"), F.expr("TIMESTAMP_NTZ'1998-02-01'")
    kept = t.orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
    return kept.select(F.col("o_orderkey").alias("order_id"), day("o_orderdate").alias("order_date"))


@query("null_safe_eq", f"""SELECT a.customer_id, a.email IS NOT DISTINCT FROM b.email AS same_email, a.email = b.email AS plain_equal
  FROM {CUSTOMERS} a JOIN (SELECT customer_id, lower(email) AS email FROM {CUSTOMERS}) b ON a.customer_id = b.customer_id""")
def null_safe_eq(t):
    lowered = F.lower("email")
    return customers(t).select(
        "customer_id", F.col("email").eqNullSafe(lowered).alias("same_email"), (F.col("email") == lowered).alias("plain_equal")
    )


@query("fill_drop_nulls", f"""SELECT customer_id, coalesce(email, 'unknown') AS email, coalesce(email, customer_name) AS contact
  FROM {CUSTOMERS} WHERE customer_name IS NOT NULL""")
def fill_drop_nulls(t):
    kept = customers(t).dropna(subset=["customer_name"])
    return kept.select("customer_id", F.coalesce("email", "customer_name").alias("contact"), "email").fillna({"email": "unknown"})


@query("generated_column", f"SELECT order_id, line_no, product_id, quantity, amount, amount / quantity AS unit_price, extract(year FROM ship_date)::BIGINT AS ship_year FROM {ITEMS}")
def generated_column(t):
    return items(t).select(
        "order_id", "line_no", "product_id", "quantity", "amount",
        F.try_divide("amount", "quantity").alias("unit_price"),
        F.year("ship_date").cast("bigint").alias("ship_year"),
    )


@query("config_steps", f"""SELECT order_id, upper(priority) AS priority, amount, CASE WHEN amount >= 300000 THEN 'HIGH' ELSE 'LOW' END AS tier,
  amount >= 100000 AS is_high_value FROM {ORDERS} WHERE amount >= 50000""")
def config_steps(t):
    config = [
        {"step": "filter_min_amount", "column": "amount", "value": 50000},
        {"step": "add_tier", "column": "amount", "high": 300000},
        {"step": "uppercase", "column": "priority"},
        {"step": "high_value_flag", "column": "amount", "value": 100000},
    ]
    return run_steps(orders(t).select("order_id", "priority", "amount"), config)


@query("comprehension_filter", f"SELECT order_id, amount, round(amount * amount, 0) AS squared FROM {ORDERS} WHERE amount >= 100000")
def comprehension_filter(t):
    kept = orders(t).where("amount >= 100000")
    return kept.select("order_id", "amount", F.round(F.col("amount") * F.col("amount"), 0).alias("squared"))


@query("sample_fraction", f"""SELECT status, count(*) AS sampled, count(*) * 10 AS estimated_rows, round(sum(amount) * 10, 2) AS estimated_amount
  FROM {ORDERS} WHERE ('0x' || substr(md5(customer_id::VARCHAR), 1, 8))::BIGINT % 10 = 0 GROUP BY status""")
def sample_fraction(t):
    """One key in ten by hash, the same keys every run, with the estimate scaled back up."""
    kept = orders(t).where(F.conv(F.substring(F.md5(F.col("customer_id").cast("string")), 1, 8), 16, 10).cast("bigint") % 10 == 0)
    return kept.groupBy("status").agg(
        F.count(F.lit(1)).alias("sampled"), (F.count(F.lit(1)) * 10).alias("estimated_rows"),
        F.round(F.sum("amount") * 10, 2).alias("estimated_amount"),
    )


@query("row_col_policy", f"""SELECT customer_id, city, status,
   CASE WHEN length(email) > 0 THEN '***' || substr(email, strpos(email, '@')) END AS email
   FROM {CUSTOMERS} WHERE country = 'ASIA'""")
def row_col_policy(t):
    from tidewater.operators.governance import secured_view

    domain_only = F.concat(F.lit("***"), F.expr("substr(email, instr(email, '@'))"))
    return secured_view(customers(t), F.col("country") == "ASIA", {"email": domain_only}, ["customer_id", "city", "status", "email"])


# ---- sorts, limits, pages ----

@query("sort_by_name", f"SELECT customer_id, customer_name FROM {CUSTOMERS} ORDER BY customer_name")
def sort_by_name(t):
    return customers(t).select("customer_id", "customer_name").orderBy(F.asc_nulls_last("customer_name"))


TOTAL_BY_CUSTOMER = f"SELECT customer_id, customer_name, round(sum(amount), 2) AS total_amount FROM {CUSTOMERS} JOIN {ORDERS} USING (customer_id) GROUP BY ALL"


def _total_by_customer(t):
    # one row per customer before the join
    sums = orders(t).groupBy("customer_id").agg(F.round(F.sum("amount"), 2).alias("total_amount"))
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return names.join(sums, "customer_id").select("customer_id", "customer_name", "total_amount")


@query("top5_customers", f"{TOTAL_BY_CUSTOMER} ORDER BY total_amount DESC, customer_id LIMIT 5")
def top5_customers(t):
    # the five sums are found first, so only five rows meet the names
    sums = orders(t).groupBy("customer_id").agg(F.round(F.sum("amount"), 2).alias("total_amount"))
    best = sums.orderBy(F.desc("total_amount"), "customer_id").limit(5)
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return names.join(F.broadcast(best), "customer_id").select("customer_id", "customer_name", "total_amount")


@query("top_n_per_group", f"SELECT category, product_id, revenue, rn FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_id) AS rn FROM {PRODUCT_REVENUE}) WHERE rn <= 3")
def top_n_per_group(t):
    best = top_n(product_revenue(t), ["category"], [F.desc("revenue"), F.asc("product_id")], 3, rank="rn")
    return best.withColumn("rn", F.col("rn").cast("bigint"))


@query("top_orders_per_customer", f"SELECT customer_id, order_id, amount FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, order_id) AS rn FROM {ORDERS}) WHERE rn <= 3")
def top_orders_per_customer(t):
    few = orders(t).select("customer_id", "order_id", "amount")
    return top_n(few, ["customer_id"], [F.desc("amount"), F.asc("order_id")], 3)


@query("keyset_page", f"SELECT order_id, order_date, amount FROM {ORDERS} WHERE (order_date, order_id) < (DATE '1999-06-01', 5000) ORDER BY order_date DESC, order_id DESC LIMIT 20")
def keyset_page(t):
    from tidewater.operators.paging import keyset_page as page

    rows = orders(t).select("order_id", "order_date", "amount")
    return page(rows, ["order_date", "order_id"], [F.lit("1999-06-01").cast("date"), F.lit(5000)], 20)


@query("k_closest", """SELECT c_custkey, round(sqrt(c_acctbal * c_acctbal + c_nationkey * c_nationkey), 4) AS distance
  FROM customer ORDER BY c_acctbal * c_acctbal + c_nationkey * c_nationkey, c_custkey LIMIT 10""")
def k_closest(t):
    square = F.col("c_acctbal") * F.col("c_acctbal") + F.col("c_nationkey") * F.col("c_nationkey")
    near = t.customer.select("c_custkey", square.alias("d2")).orderBy("d2", "c_custkey").limit(10)
    return near.select("c_custkey", F.round(F.sqrt("d2"), 4).alias("distance"))


@query("external_sort", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id")
def external_sort(t):
    # range partitions sorted on their own: a total order without a single task
    return t.events.select("event_id", "ts", "user_id").repartitionByRange("ts", "event_id").sortWithinPartitions("ts", "event_id")


# ---- set operations ----

def _month_customers(t, start, end):
    o = t.orders.where((F.col("o_orderdate") >= F.expr(f"TIMESTAMP_NTZ'{start}'")) & (F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ'{end}'")))
    return o.select(F.col("o_custkey").alias("customer_id"))


def _jan(t):
    return _month_customers(t, "1998-01-01", "1998-02-01")


def _feb(t):
    return _month_customers(t, "1998-02-01", "1998-03-01")


JAN = "SELECT o_custkey AS customer_id FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-02-01'"
FEB = "SELECT o_custkey AS customer_id FROM orders WHERE o_orderdate >= DATE '1998-02-01' AND o_orderdate < DATE '1998-03-01'"


@query("union_distinct", f"{JAN} UNION {FEB}")
def union_distinct(t):
    return _jan(t).union(_feb(t)).distinct()


@query("union_all", f"{JAN} UNION ALL {FEB}")
def union_all(t):
    return _jan(t).unionByName(_feb(t))


@query("intersect", f"{JAN} INTERSECT {FEB}")
def intersect(t):
    return _jan(t).intersect(_feb(t))


@query("except", f"{JAN} EXCEPT {FEB}")
def except_(t):
    return _jan(t).subtract(_feb(t))


@query("except_all", f"{JAN} EXCEPT ALL {FEB}")
def except_all(t):
    return _jan(t).exceptAll(_feb(t))


@query("union_drifted", """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS kind FROM customer
  UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier""")
def union_drifted(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


# ---- aggregates ----

@query("agg_global", f"SELECT count(*) AS total_orders, round(sum(amount), 2) AS total_sales, round(sum(amount), 2) / count(*) AS average_order_amount FROM {ORDERS}")
def agg_global(t):
    total = F.round(F.sum("amount"), 2)
    return orders(t).agg(F.count(F.lit(1)).alias("total_orders"), total.alias("total_sales"), (total / F.count(F.lit(1))).alias("average_order_amount"))


@query("agg_group_basic", f"SELECT customer_id, count(*) AS orders, round(sum(amount), 2) AS total, round(sum(amount), 2) / count(*) AS avg_amt, min(amount) AS min_amt, max(amount) AS max_amt FROM {ORDERS} GROUP BY customer_id")
def agg_group_basic(t):
    total = F.round(F.sum("amount"), 2)
    return orders(t).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), total.alias("total"), (total / F.count(F.lit(1))).alias("avg_amt"),
        F.min("amount").alias("min_amt"), F.max("amount").alias("max_amt"),
    )


@query("count_by_city", f"SELECT city, count(*) AS customer_count FROM {CUSTOMERS} GROUP BY city")
def count_by_city(t):
    return customers(t).groupBy("city").agg(F.count(F.lit(1)).alias("customer_count"))


@query("agg_having", f"SELECT customer_id, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY customer_id HAVING sum(amount) > 2000000")
def agg_having(t):
    return orders(t).groupBy("customer_id").agg(F.round(F.sum("amount"), 2).alias("total")).where("total > 2000000")


@query("agg_count_distinct", f"SELECT count(DISTINCT customer_id) AS unique_customers, count(DISTINCT order_date) AS active_days FROM {ORDERS}")
def agg_count_distinct(t):
    return orders(t).agg(F.countDistinct("customer_id").alias("unique_customers"), F.countDistinct("order_date").alias("active_days"))


@query("agg_multi_key_month", f"SELECT customer_id, date_trunc('month', order_date)::DATE AS month, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY ALL")
def agg_multi_key_month(t):
    return orders(t).groupBy("customer_id", month("order_date").alias("month")).agg(F.round(F.sum("amount"), 2).alias("total"))


@query("total_by_customer", TOTAL_BY_CUSTOMER)
def total_by_customer(t):
    return _total_by_customer(t)


MONTHLY = f"SELECT date_trunc('month', order_date)::DATE AS sales_month, round(sum(amount), 2) AS total_amount FROM {ORDERS} GROUP BY 1"


def monthly(t):
    return orders(t).groupBy(month("order_date").alias("sales_month")).agg(F.round(F.sum("amount"), 2).alias("total_amount"))


@query("monthly_sales", f"{MONTHLY} ORDER BY 1")
def monthly_sales(t):
    return monthly(t).orderBy("sales_month")


@query("first_last_order", f"""SELECT customer_id, min(order_date) AS first_order, max(order_date) AS last_order,
  arg_min(order_id, (order_date, order_id)) AS first_order_id, arg_max(order_id, (order_date, order_id)) AS last_order_id FROM {ORDERS} GROUP BY customer_id""")
def first_last_order(t):
    at = F.struct("order_date", "order_id")
    return orders(t).groupBy("customer_id").agg(
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"),
        F.min_by("order_id", at).alias("first_order_id"), F.max_by("order_id", at).alias("last_order_id"),
    )


@query("dup_email", f"SELECT lower(email) AS email_lower, count(*) AS duplicate_count FROM {CUSTOMERS} WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dup_email(t):
    known = customers(t).where(F.col("email").isNotNull())
    return known.groupBy(F.lower("email").alias("email_lower")).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


@query("dup_keys", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(t):
    return t.lineitem.groupBy("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


@query("dup_orders", f"SELECT customer_id, order_date, count(*) AS cnt, count(DISTINCT amount) AS amounts FROM {ORDERS} GROUP BY ALL HAVING count(*) > 1")
def dup_orders(t):
    # one row per (customer, day, amount) first, so equal amounts collapse before the second count
    same = orders(t).groupBy("customer_id", "order_date", "amount").agg(F.count(F.lit(1)).alias("n"))
    days = same.groupBy("customer_id", "order_date").agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("amounts"))
    return days.where("cnt > 1")


@query("agg_conditional", f"""SELECT count(*) FILTER (WHERE status = 'F') AS filled, count(*) FILTER (WHERE status = 'O') AS open_count,
  count(*) FILTER (WHERE status = 'P') AS pending, round(sum(CASE WHEN status = 'F' THEN amount END), 2) AS filled_amount FROM {ORDERS}""")
def agg_conditional(t):
    s = F.col("status")
    return orders(t).agg(
        F.count_if(s == "F").alias("filled"), F.count_if(s == "O").alias("open_count"), F.count_if(s == "P").alias("pending"),
        F.round(F.sum(F.when(s == "F", F.col("amount"))), 2).alias("filled_amount"),
    )


MONTH_PIVOT = f"""SELECT customer_id, round(sum(CASE WHEN extract(month FROM order_date) = 1 THEN amount END), 2) AS jan,
  round(sum(CASE WHEN extract(month FROM order_date) = 2 THEN amount END), 2) AS feb,
  round(sum(CASE WHEN extract(month FROM order_date) = 3 THEN amount END), 2) AS mar FROM {ORDERS} GROUP BY customer_id"""


def _month_pivot(t):
    wide = orders(t).withColumn("m", F.month("order_date")).groupBy("customer_id").pivot("m", [1, 2, 3]).agg(F.round(F.sum("amount"), 2))
    return wide.select("customer_id", F.col("1").alias("jan"), F.col("2").alias("feb"), F.col("3").alias("mar"))


@query("pivot", MONTH_PIVOT)
def pivot(t):
    return _month_pivot(t)


@query("unpivot", f"SELECT * FROM (UNPIVOT ({MONTH_PIVOT}) ON jan, feb, mar INTO NAME month VALUE amount)")
def unpivot(t):
    return _month_pivot(t).unpivot(["customer_id"], ["jan", "feb", "mar"], "month", "amount").where("amount IS NOT NULL")


@query("rollup", f"""SELECT status, priority, count(*) AS n, round(sum(amount), 2) AS total, CAST(grouping(status) * 2 + grouping(priority) AS BIGINT) AS level
  FROM {ORDERS} GROUP BY ROLLUP (status, priority)""")
def rollup(t):
    return orders(t).rollup("status", "priority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.grouping_id().cast("bigint").alias("level"))


@query("cube", f"""SELECT status, priority, count(*) AS n, round(sum(amount), 2) AS total, CAST(grouping(status) * 2 + grouping(priority) AS BIGINT) AS level
  FROM {ORDERS} GROUP BY CUBE (status, priority)""")
def cube(t):
    return orders(t).cube("status", "priority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.grouping_id().cast("bigint").alias("level"))


@query("grouping_sets", f"""SELECT status, priority, extract(year FROM order_date)::BIGINT AS year, count(*) AS n FROM {ORDERS}
  GROUP BY GROUPING SETS ((status, priority), (year), ())""")
def grouping_sets(t):
    o = orders(t).withColumn("year", F.year("order_date").cast("bigint"))
    return o.groupingSets([["status", "priority"], ["year"], []], "status", "priority", "year").agg(F.count(F.lit(1)).alias("n")).select("status", "priority", "year", "n")


@query("with_totals", f"SELECT coalesce(status, 'ALL') AS status, count(*) AS n, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY GROUPING SETS ((status), ())")
def with_totals(t):
    sums = orders(t).groupingSets([["status"], []], "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))
    return sums.select(F.coalesce("status", F.lit("ALL")).alias("status"), "n", "total")


@query("top_k_frequent", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def top_k_frequent(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey").limit(10)


@query("arg_max_min", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(ts, (value, event_id)) AS peak_ts FROM events GROUP BY 1")
def arg_max_min(t):
    at = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(
        F.max_by("event_type", at).alias("last_type"), F.min_by("event_type", at).alias("first_type"),
        F.max_by("ts", F.struct("value", "event_id")).alias("peak_ts"),
    )


SPEND = f"SELECT customer_id, round(sum(amount), 2) AS total FROM {ORDERS} GROUP BY customer_id"


def _spend(t):
    return orders(t).groupBy("customer_id").agg(F.round(F.sum("amount"), 2).alias("total"))


@query("nth_group_total_gt_avg", f"WITH t AS ({SPEND}) SELECT * FROM t WHERE total > (SELECT sum(total) / count(*) FROM t)")
def nth_group_total_gt_avg(t):
    spend = _spend(t)
    mean = spend.agg(F.sum("total") / F.count(F.lit(1))).scalar()
    return spend.where(F.col("total") > mean)


@query("total_gt_twice_avg", f"WITH t AS ({SPEND}) SELECT * FROM t WHERE total > 2 * (SELECT sum(total) / count(*) FROM t)")
def total_gt_twice_avg(t):
    spend = _spend(t)
    mean = spend.agg(F.sum("total") / F.count(F.lit(1))).scalar()
    return spend.where(F.col("total") > 2 * mean)


@query("corr_above_avg", f"SELECT o.order_id, o.customer_id, o.amount FROM {ORDERS} o WHERE o.amount > (SELECT round(sum(amount), 2) / count(*) FROM {ORDERS} i WHERE i.customer_id = o.customer_id)")
def corr_above_avg(t):
    o = orders(t).select("order_id", "customer_id", "amount")
    means = o.groupBy("customer_id").agg((F.round(F.sum("amount"), 2) / F.count(F.lit(1))).alias("mean"))
    return o.join(means, "customer_id").where("amount > mean").select("order_id", "customer_id", "amount")


@query("best_department", f"SELECT department_id::BIGINT AS department_id, round(sum(salary), 2) / count(*) AS avg_salary FROM {EMPLOYEES} GROUP BY 1 ORDER BY avg_salary DESC, 1 LIMIT 1")
def best_department(t):
    means = employees(t).groupBy(F.col("department_id").cast("bigint").alias("department_id")).agg((F.round(F.sum("salary"), 2) / F.count(F.lit(1))).alias("avg_salary"))
    return means.orderBy(F.desc("avg_salary"), "department_id").limit(1)


@query("all_months_active", f"SELECT customer_id, extract(year FROM order_date)::BIGINT AS year, count(DISTINCT extract(month FROM order_date)) AS months FROM {ORDERS} GROUP BY 1, 2 HAVING count(DISTINCT extract(month FROM order_date)) >= 5")
def all_months_active(t):
    from tidewater.operators.activity import active_in_every_month

    return active_in_every_month(orders(t), "customer_id", "order_date", months=5)


@query("returning_customers", f"SELECT customer_id, count(*) AS n FROM {ORDERS} GROUP BY 1 HAVING count(*) >= 2")
def returning_customers(t):
    return orders(t).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


@query("inactive_customers", f"SELECT customer_id, max(order_date) AS last_order FROM {ORDERS} GROUP BY 1 HAVING max(order_date) < DATE '2001-08-01' - 90")
def inactive_customers(t):
    from tidewater.operators.activity import inactive

    return inactive(orders(t), "customer_id", "order_date", as_of="2001-08-01", days=90, name="last_order")


@query("segment_avg", f"SELECT status AS segment, round(sum(amount), 2) / count(*) AS avg_order FROM (SELECT customer_id, amount FROM {ORDERS}) JOIN (SELECT customer_id, status FROM {CUSTOMERS}) USING (customer_id) GROUP BY 1")
def segment_avg(t):
    # sums per customer first: the join moves one row per customer
    sums = orders(t).groupBy("customer_id").agg(F.sum("amount").alias("s"), F.count(F.lit(1)).alias("n"))
    c = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return sums.join(c, "customer_id").groupBy("segment").agg((F.round(F.sum("s"), 2) / F.sum("n")).alias("avg_order"))


@query("aov_by_month", f"SELECT date_trunc('month', order_date)::DATE AS m, round(sum(amount), 2) / nullif(count(*), 0) AS aov FROM {ORDERS} GROUP BY 1")
def aov_by_month(t):
    return orders(t).groupBy(month("order_date").alias("m")).agg(F.try_divide(F.round(F.sum("amount"), 2), F.count(F.lit(1))).alias("aov"))


@query("customer_ltv", f"SELECT customer_id, round(sum(amount), 2) AS clv, min(order_date) AS first_order, max(order_date) AS last_order, date_diff('day', min(order_date), max(order_date)) AS lifespan_days FROM {ORDERS} GROUP BY 1")
def customer_ltv(t):
    lo, hi = F.min("order_date"), F.max("order_date")
    return orders(t).groupBy("customer_id").agg(
        F.round(F.sum("amount"), 2).alias("clv"), lo.alias("first_order"), hi.alias("last_order"), days_between(hi, lo).alias("lifespan_days"))


@query("new_customers_month", f"SELECT date_trunc('month', first)::DATE AS signup_month, count(*) AS new_customers FROM (SELECT customer_id, min(order_date) AS first FROM {ORDERS} GROUP BY 1) GROUP BY 1")
def new_customers_month(t):
    first = orders(t).groupBy("customer_id").agg(F.min("order_date").alias("first"))
    return first.groupBy(month("first").alias("signup_month")).agg(F.count(F.lit(1)).alias("new_customers"))


@query("new_vs_returning", f"""WITH cm AS (SELECT DISTINCT customer_id, date_trunc('month', order_date)::DATE AS m FROM {ORDERS}),
  f AS (SELECT customer_id, min(m) AS first_m FROM cm GROUP BY 1)
  SELECT m, count(*) FILTER (WHERE m = first_m) AS new_customers, count(*) FILTER (WHERE m > first_m) AS returning_customers FROM cm JOIN f USING (customer_id) GROUP BY 1""")
def new_vs_returning(t):
    from tidewater.operators.activity import new_vs_returning as split

    return split(orders(t), "customer_id", "order_date")


@query("wau", "SELECT date_trunc('week', ts)::DATE AS week_start, count(DISTINCT user_id) AS wau FROM events GROUP BY 1")
def wau(t):
    return t.events.groupBy(week("ts").alias("week_start")).agg(F.countDistinct("user_id").alias("wau"))


@query("stickiness", """WITH d AS (SELECT ts::DATE AS d, count(DISTINCT user_id) AS dau FROM events GROUP BY 1),
  m AS (SELECT date_trunc('month', ts)::DATE AS m, count(DISTINCT user_id) AS mau FROM events GROUP BY 1)
  SELECT d, dau, mau, dau / nullif(mau, 0) AS stickiness FROM d JOIN m ON date_trunc('month', d)::DATE = m""")
def stickiness(t):
    from tidewater.operators.activity import stickiness as ratio

    return ratio(t.events, "user_id", "ts")


@query("cohort_retention", f"""WITH cm AS (SELECT DISTINCT customer_id, date_trunc('month', order_date)::DATE AS order_month FROM {ORDERS}),
  f AS (SELECT customer_id, min(order_month) AS cohort_month FROM cm GROUP BY 1),
  s AS (SELECT cohort_month, count(*) AS size FROM f GROUP BY 1)
  SELECT cohort_month, order_month, count(*) AS active_customers, 100.0::DOUBLE * count(*) / any_value(size) AS retention_pct
  FROM cm JOIN f USING (customer_id) JOIN s USING (cohort_month) GROUP BY 1, 2""")
def cohort_retention(t):
    from tidewater.operators.activity import cohort_retention as cohorts

    return cohorts(orders(t), "customer_id", "order_date")


@query("churn_jan_not_feb", f"{JAN} EXCEPT {FEB}")
def churn_jan_not_feb(t):
    return _jan(t).distinct().join(_feb(t), "customer_id", "left_anti")


@query("churn_rate", f"WITH j AS (SELECT DISTINCT customer_id FROM ({JAN})), f AS (SELECT DISTINCT customer_id FROM ({FEB})) SELECT count(*) AS active, count(*) FILTER (WHERE f.customer_id IS NULL) AS churned, (count(*) FILTER (WHERE f.customer_id IS NULL))::DOUBLE / count(*) AS churn_rate FROM j LEFT JOIN f USING (customer_id)")
def churn_rate(t):
    both = _jan(t).distinct().join(_feb(t).distinct().withColumn("kept", F.lit(True)), "customer_id", "left")
    lost = F.count_if(F.col("kept").isNull())
    return both.agg(F.count(F.lit(1)).alias("active"), lost.alias("churned"), (lost / F.count(F.lit(1))).alias("churn_rate"))


@query("funnel_counts", f"""SELECT count(*) AS signups, count(n) AS first_order, count(CASE WHEN n >= 2 THEN 1 END) AS repeat_order
  FROM {CUSTOMERS} LEFT JOIN (SELECT customer_id, count(*) AS n FROM {ORDERS} WHERE order_date >= DATE '2001-01-01' GROUP BY 1) USING (customer_id)""")
def funnel_counts(t):
    recent = t.orders.where(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ'2001-01-01'"))
    n = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t.customer.select("c_custkey").join(n, "c_custkey", "left").agg(
        F.count(F.lit(1)).alias("signups"), F.count("n").alias("first_order"), F.count_if(F.col("n") >= 2).alias("repeat_order"))


@query("word_count", """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(lower(text), '[^\\p{L} ]', ' ', 'g'), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def word_count(t):
    from tidewater.functions.text import words
    from tidewater.operators.control import spread

    docs = spread(t.documents.select("doc_id", "text"), "doc_id")
    return docs.select(F.explode(words("text")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("describe_profile", """SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n, round(sum(o_totalprice), 2) / count(o_totalprice) AS mean, round(stddev_samp(o_totalprice), 2) AS stddev, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders
  UNION ALL SELECT 'o_custkey', count(o_custkey), round(sum(o_custkey), 2) / count(o_custkey), round(stddev_samp(o_custkey), 2), min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE FROM orders""")
def describe_profile(t):
    from tidewater.operators.quality import numeric_profile

    return numeric_profile(t.orders, ["o_totalprice", "o_custkey"])


@query("missing_number", """WITH u AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), g AS (SELECT k, lead(k) OVER (ORDER BY k) AS nk FROM u)
  SELECT unnest(range(k + 1, nk)) AS missing FROM g WHERE nk > k + 1""")
def missing_number(t):
    from tidewater.operators.patterns import missing_numbers

    return missing_numbers(t.lineitem, "l_orderkey")


@query("metrics_slices", """SELECT lang, source, count(*) AS n, round(sum(quality), 2) / count(*) AS quality_rate, round(sum(toxic), 2) / count(*) AS toxic_rate
  FROM documents JOIN labels USING (doc_id) GROUP BY CUBE (lang, source)""")
def metrics_slices(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id")
    n = F.count(F.lit(1))
    return joined.cube("lang", "source").agg(n.alias("n"), (F.round(F.sum("quality").cast("double"), 2) / n).alias("quality_rate"), (F.round(F.sum("toxic").cast("double"), 2) / n).alias("toxic_rate"))


@query("downsample", "SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS bucket, count(*) AS n, round(sum(value), 2) AS total, max(value) AS peak FROM events GROUP BY 1, 2")
def downsample(t):
    sums = t.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max("value").alias("peak"))
    return sums.select("event_type", F.col("w.start").alias("bucket"), "n", "total", "peak")


@query("ab_compare", """WITH v AS (SELECT user_id % 2 AS variant, user_id, max(CASE WHEN event_type = 'purchase' AND value > 150 THEN 1 ELSE 0 END) AS hit FROM events GROUP BY 1, 2),
  g AS (SELECT sum(CASE WHEN variant = 0 THEN 1 ELSE 0 END)::DOUBLE AS na, sum(CASE WHEN variant = 1 THEN 1 ELSE 0 END)::DOUBLE AS nb,
    sum(CASE WHEN variant = 0 THEN hit ELSE 0 END)::DOUBLE AS xa, sum(CASE WHEN variant = 1 THEN hit ELSE 0 END)::DOUBLE AS xb FROM v)
  SELECT xa / na AS rate_a, xb / nb AS rate_b, round((xb / nb) / nullif(xa / na, 0) - 1, 8) AS lift,
   round((xb / nb - xa / na) / nullif(sqrt((xa + xb) / (na + nb) * (1 - (xa + xb) / (na + nb)) * (1 / na + 1 / nb)), 0), 8) AS z FROM g""")
def ab_compare(t):
    from tidewater.operators.activity import ab_compare as compare

    hit = F.max(F.when((F.col("event_type") == "purchase") & (F.col("value") > 150), 1).otherwise(0))
    users = t.events.groupBy((F.col("user_id") % 2).alias("variant"), "user_id").agg(hit.alias("hit"))
    return compare(users, "variant", "hit")
