"""Business tables derived from the driver tables, each with the same rows in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import day
from tidewater.sources.tables import Tables


def customers(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    user = F.when(c % 2 == 0, F.lit("User")).otherwise(F.lit("user"))
    email = F.concat(user, F.floor(c / 2).cast("string"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com"))
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.select(
        c.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(c % 10 != 0, email).alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("c_mktsegment").alias("status"),
    )


CUSTOMERS = """(SELECT c_custkey AS customer_id, c_name AS customer_name,
  CASE WHEN c_custkey % 10 <> 0 THEN (CASE WHEN c_custkey % 2 = 0 THEN 'User' ELSE 'user' END)
    || CAST(c_custkey // 2 AS VARCHAR) || '@' || lower(c_mktsegment) || '.com' END AS email,
  n_name AS city, r_name AS country, c_mktsegment AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def employees(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    return t.customer.select(
        c.alias("employee_id"),
        F.col("c_name").alias("employee_name"),
        F.when(c > 0, F.floor(c / 10)).alias("manager_id"),
        F.col("c_acctbal").alias("salary"),
        F.col("c_nationkey").alias("department_id"),
    )


EMPLOYEES = """(SELECT c_custkey AS employee_id, c_name AS employee_name,
  CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS manager_id,
  c_acctbal AS salary, c_nationkey AS department_id FROM customer)"""


def orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  o_totalprice AS amount, o_orderstatus AS status, o_orderpriority AS priority FROM orders)"""


def items(t: Tables) -> DataFrame:
    """Order lines; a line's amount is its extended price."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        day("l_shipdate").alias("ship_date"),
    )


ITEMS = """(SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
  CAST(l_linenumber AS BIGINT) AS line_no, l_quantity AS quantity, l_extendedprice AS amount,
  CAST(l_shipdate AS DATE) AS ship_date FROM lineitem)"""


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("product_type"),
        F.col("p_retailprice").alias("price"),
    )


PRODUCTS = """(SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category,
  p_type AS product_type, p_retailprice AS price FROM part)"""


def product_revenue(t: Tables) -> DataFrame:
    """Revenue per product; lines are summed before they meet the product table."""
    sums = items(t).groupBy("product_id").agg(F.round(F.sum("amount"), 2).alias("revenue"))
    return sums.join(products(t), "product_id").select("category", "product_id", "revenue")


PRODUCT_REVENUE = f"""(SELECT category, product_id, round(sum(amount), 2) AS revenue
  FROM {ITEMS} JOIN {PRODUCTS} USING (product_id) GROUP BY category, product_id)"""


def subscriptions(t: Tables) -> DataFrame:
    """Each order opens a subscription of 30 to 89 days."""
    return orders(t).select(
        "customer_id",
        F.col("order_id").alias("subscription_id"),
        F.col("order_date").alias("start_date"),
        F.date_add("order_date", (F.col("order_id") % 60 + 30).cast("int")).alias("end_date"),
    )


SUBSCRIPTIONS = f"""(SELECT customer_id, order_id AS subscription_id, order_date AS start_date,
  order_date + CAST(order_id % 60 + 30 AS INTEGER) AS end_date FROM {ORDERS})"""


def changes(t: Tables) -> DataFrame:
    """Events read as changes of a user: error deletes, signup inserts, the rest update."""
    kind = F.col("event_type")
    op = F.when(kind == "error", "DELETE").when(kind == "signup", "INSERT").otherwise("UPDATE")
    return t.events.select(
        F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("value").alias("city_code"), op.alias("op"), "ts", "event_id"
    )


CHANGES = """(SELECT user_id AS id, event_type AS name, value AS city_code,
  CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS op, ts, event_id FROM events)"""


def change_target(t: Tables) -> DataFrame:
    """The table the changes apply to: customers under their key plus 50."""
    return t.customer.select(
        (F.col("c_custkey") + 50).alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("city_code")
    )


CHANGE_TARGET = "(SELECT c_custkey + 50 AS id, c_name AS name, c_acctbal AS city_code FROM customer)"
