"""Window queries, percentiles, sketches and the patterns built on windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.dates import day, days_between, epoch_micros
from tidewater.operators import patterns as P
from tidewater.operators import sketches as S
from tidewater.operators.ordered import ordered, range_frame, running, shift
from tidewater.operators.ranking import latest, nth_highest, ntile, quantiles, ranked, top_n
from tidewater.operators.sequences import Step, sequence_counts
from tidewater.operators.skew import lookup_join
from tidewater.plans.basics import MONTHLY, SPEND, _spend, monthly
from tidewater.plans.bindings import EMPLOYEES, ITEMS, ORDERS, PRODUCT_REVENUE, employees, items, orders, product_revenue
from tidewater.plans.registry import query
from tidewater.session import cut_lineage

DAILY = f"(SELECT order_date AS order_day, round(sum(amount), 2) AS sales FROM {ORDERS} GROUP BY 1)"


def daily(t):
    return orders(t).groupBy(F.col("order_date").alias("order_day")).agg(F.round(F.sum("amount"), 2).alias("sales"))


def history(t):
    """Orders of each customer in time order; the order id breaks ties."""
    return ordered(orders(t).select("customer_id", "order_id", "order_date", "amount"), ["customer_id"], ["order_date", "order_id"])


# ---- row numbers and ranks ----

@query("win_row_number", f"SELECT order_id, customer_id, order_date, amount FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM {ORDERS}) WHERE rn = 1")
def win_row_number(t):
    return latest(orders(t).select("order_id", "customer_id", "order_date", "amount"), ["customer_id"], ["order_date", "order_id"])


@query("dedup_keep_latest", "SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def dedup_keep_latest(t):
    return latest(t.events.select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"])


@query("win_rank", f"SELECT category, product_id, revenue, rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS revenue_rank FROM {PRODUCT_REVENUE}")
def win_rank(t):
    return ranked(product_revenue(t), ["category"], "revenue", {"revenue_rank": "rank"})


@query("win_dense_rank_nth", f"SELECT department_id::BIGINT AS department_id, employee_id, salary FROM (SELECT *, dense_rank() OVER (PARTITION BY department_id ORDER BY salary DESC) AS rk FROM {EMPLOYEES}) WHERE rk = 3")
def win_dense_rank_nth(t):
    e = employees(t).select(F.col("department_id").cast("bigint").alias("department_id"), "employee_id", "salary")
    return nth_highest(e, ["department_id"], "salary", 3)


@query("second_highest", f"SELECT DISTINCT salary FROM (SELECT salary, dense_rank() OVER (ORDER BY salary DESC) AS rk FROM {EMPLOYEES}) WHERE rk = 2")
def second_highest(t):
    return nth_highest(employees(t).select("salary"), [], "salary", 2).distinct()


@query("win_rank_global_and_group", f"SELECT category, product_id, revenue, rank() OVER (ORDER BY revenue DESC) AS global_rank, rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS category_rank FROM {PRODUCT_REVENUE}")
def win_rank_global_and_group(t):
    inside = ranked(product_revenue(t), ["category"], "revenue", {"category_rank": "rank"})
    return ranked(inside, [], "revenue", {"global_rank": "rank"}).select("category", "product_id", "revenue", "global_rank", "category_rank")


@query("win_ntile", f"SELECT customer_id, total, ntile(4) OVER (ORDER BY total DESC, customer_id) AS quartile FROM ({SPEND})")
def win_ntile(t):
    return ntile(_spend(t), "total", "customer_id", 4, "quartile").select("customer_id", "total", "quartile")


@query("top_decile_spenders", f"SELECT customer_id, total FROM (SELECT *, ntile(10) OVER (ORDER BY total DESC, customer_id) AS decile FROM ({SPEND})) WHERE decile = 1")
def top_decile_spenders(t):
    return ntile(_spend(t), "total", "customer_id", 10, "decile").where("decile = 1").select("customer_id", "total")


@query("win_cume_dist", f"SELECT order_id, amount, cume_dist() OVER (ORDER BY amount) AS cd, percent_rank() OVER (ORDER BY amount) AS pr FROM {ORDERS}")
def win_cume_dist(t):
    return ranked(orders(t).select("order_id", "amount"), [], "amount", {"cd": "cume_dist", "pr": "percent_rank"}, descending=False)


# ---- neighbours and running values ----

@query("win_lag_lead", f"SELECT order_id, customer_id, amount, lag(amount, 1, 0) OVER w AS prev_amount, lead(amount) OVER w AS next_amount FROM {ORDERS} WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)")
def win_lag_lead(t):
    o = shift(history(t), {"prev_amount": F.col("amount")}, ["order_date", "order_id"], default=F.lit(0.0))
    o = shift(o, {"next_amount": F.col("amount")}, ["order_date", "order_id"], ahead=True)
    return o.result().select("order_id", "customer_id", "amount", "prev_amount", "next_amount")


@query("win_increasing_orders", f"SELECT order_id, customer_id, amount, prev FROM (SELECT *, lag(amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS prev FROM {ORDERS}) WHERE amount > prev")
def win_increasing_orders(t):
    o = shift(history(t), {"prev": F.col("amount")}, ["order_date", "order_id"])
    return o.result().where("amount > prev").select("order_id", "customer_id", "amount", "prev")


@query("win_days_between", f"SELECT order_id, customer_id, order_date, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id), order_date) AS days_since_prev FROM {ORDERS}")
def win_days_between(t):
    o = shift(history(t), {"prev": F.col("order_date")}, ["order_date", "order_id"]).result()
    return o.select("order_id", "customer_id", "order_date", days_between("order_date", "prev").alias("days_since_prev"))


@query("win_day_over_day", f"SELECT order_day, sales, round(sales - lag(sales) OVER (ORDER BY order_day), 2) AS sales_change FROM {DAILY}")
def win_day_over_day(t):
    o = shift(ordered(daily(t), [], ["order_day"]), {"prev": F.col("sales")}, ["order_day"]).result()
    return o.select("order_day", "sales", F.round(F.col("sales") - F.col("prev"), 2).alias("sales_change"))


@query("win_running_total", f"SELECT order_id, customer_id, round(sum(amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING), 2) AS running_total FROM {ORDERS}")
def win_running_total(t):
    o = running(history(t), {"running_total": ("sum", F.col("amount"))}).result()
    return o.select("order_id", "customer_id", F.round("running_total", 2).alias("running_total"))


@query("running_monthly_revenue", f"SELECT sales_month, total_amount, round(sum(total_amount) OVER (ORDER BY sales_month ROWS UNBOUNDED PRECEDING), 2) AS running_revenue FROM ({MONTHLY})")
def running_monthly_revenue(t):
    o = running(ordered(monthly(t), [], ["sales_month"]), {"running_revenue": ("sum", F.col("total_amount"))}).result()
    return o.withColumn("running_revenue", F.round("running_revenue", 2))


@query("win_moving_avg_rows", f"SELECT order_day, sales, round(avg(sales) OVER (ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS seven_day_avg FROM {DAILY}")
def win_moving_avg_rows(t):
    # one row per calendar day reaches this window, whatever the size of the orders table
    w = Window.orderBy("order_day").rowsBetween(-6, 0)
    return daily(t).select("order_day", "sales", F.round(F.avg("sales").over(w), 4).alias("seven_day_avg"))


@query("win_rolling_calendar", f"SELECT order_day, round(sum(sales) OVER (ORDER BY order_day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 2) AS rolling_30d FROM {DAILY}")
def win_rolling_calendar(t):
    framed = range_frame(daily(t), [], F.unix_date("order_day"), 29, {"s": ("sum", F.col("sales"))})
    return framed.select("order_day", F.round("s", 2).alias("rolling_30d"))


@query("win_first_last", f"SELECT customer_id, arg_min(amount, (order_date, order_id)) AS first_order_amount, arg_max(amount, (order_date, order_id)) AS last_order_amount FROM {ORDERS} GROUP BY 1")
def win_first_last(t):
    at = F.struct("order_date", "order_id")
    return orders(t).groupBy("customer_id").agg(F.min_by("amount", at).alias("first_order_amount"), F.max_by("amount", at).alias("last_order_amount"))


@query("win_pct_of_total", f"SELECT category, product_id, revenue, round(revenue * 100 / sum(revenue) OVER (PARTITION BY category), 6) AS pct_of_category FROM {PRODUCT_REVENUE}")
def win_pct_of_total(t):
    # totals are joined back, so a large category is never gathered in one task
    p = product_revenue(t)
    totals = p.groupBy("category").agg(F.sum("revenue").alias("whole"))
    return p.join(totals, "category").select("category", "product_id", "revenue", F.round(F.col("revenue") * 100 / F.col("whole"), 6).alias("pct_of_category"))


@query("win_running_count", f"SELECT order_id, order_date, count(*) OVER (ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING) AS running_orders FROM {ORDERS}")
def win_running_count(t):
    o = ordered(orders(t).select("order_id", "order_date"), [], ["order_date", "order_id"])
    return running(o, {"running_orders": ("count", F.lit(1))}).result()


@query("yoy_growth", f"WITH m AS ({MONTHLY}) SELECT a.sales_month, a.total_amount AS revenue, b.total_amount AS revenue_last_year, 100.0::DOUBLE * (a.total_amount - b.total_amount) / nullif(b.total_amount, 0) AS yoy_pct FROM m a LEFT JOIN m b ON b.sales_month = (a.sales_month - INTERVAL 12 MONTH)::DATE")
def yoy_growth(t):
    m = monthly(t)
    last = m.select(F.add_months("sales_month", 12).alias("sales_month"), F.col("total_amount").alias("revenue_last_year"))
    pct = F.try_divide(F.lit(100.0) * (F.col("total_amount") - F.col("revenue_last_year")), F.col("revenue_last_year"))
    return m.join(last, "sales_month", "left").select("sales_month", F.col("total_amount").alias("revenue"), "revenue_last_year", pct.alias("yoy_pct"))


@query("price_drops", f"""WITH p AS (SELECT product_id, ship_date AS change_date, min(amount / quantity) AS price FROM {ITEMS} GROUP BY 1, 2),
  l AS (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY change_date) AS prev_price FROM p) SELECT * FROM l WHERE price < prev_price""")
def price_drops(t):
    unit = F.try_divide("amount", "quantity")
    prices = items(t).groupBy("product_id", F.col("ship_date").alias("change_date")).agg(F.min(unit).alias("price"))
    o = shift(ordered(prices, ["product_id"], ["change_date"]), {"prev_price": F.col("price")}, ["change_date"])
    return o.result().where("price < prev_price")


@query("fraud_velocity", "SELECT * FROM (SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS recent FROM events) WHERE recent > 2")
def fraud_velocity(t):
    # more than two events within the hour: the data has too few for the one-minute rule
    e = t.events.select("event_id", "user_id", "ts")
    return range_frame(e, ["user_id"], epoch_micros("ts"), 3_600_000_000, {"recent": ("count", F.lit(1))}).where("recent > 2")


@query("first_touch", "SELECT o_custkey AS customer_id, l_partkey AS product_id, o_orderdate::DATE AS order_date FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, l_linenumber, l_partkey) AS rn FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1")
def first_touch(t):
    # the first line of each order, then the first order that has lines
    first_line = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(F.struct("l_linenumber", "l_partkey")).alias("line"))
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), day("o_orderdate").alias("order_date"))
    touched = o.join(first_line, "o_orderkey").groupBy("customer_id").agg(F.min(F.struct("order_date", "o_orderkey", "line")).alias("f"))
    return touched.select("customer_id", F.col("f.line.l_partkey").alias("product_id"), F.col("f.order_date").alias("order_date"))


@query("win_nth_value", "SELECT customer_id, max(amount) FILTER (WHERE rn = 2) AS second_amount FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS rn FROM " + ORDERS + ") GROUP BY 1")
def win_nth_value(t):
    o = orders(t).select("customer_id", "order_id", "order_date", "amount")
    two = top_n(o, ["customer_id"], [F.asc("order_date"), F.asc("order_id")], 2, rank="rn")
    return two.groupBy("customer_id").agg(F.max(F.when(F.col("rn") == 2, F.col("amount"))).alias("second_amount"))


@query("ignore_nulls", "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events")
def ignore_nulls(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    seen = F.when(F.col("event_type") == "purchase", F.struct("ts", "event_id", "value"))
    o = running(ordered(e, ["user_id"], ["ts", "event_id"]), {"p": ("max", seen)}).result()
    return o.select("event_id", "user_id", F.col("p.value").alias("last_purchase"))


@query("win_groups_frame", f"SELECT order_id, order_date, count(*) OVER (ORDER BY order_date GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM {ORDERS}")
def win_groups_frame(t):
    # a GROUPS frame counts distinct order values: one row per value, then back to the rows
    o = orders(t).select("order_id", "order_date")
    days = o.groupBy("order_date").agg(F.count(F.lit(1)).alias("c"))
    before = shift(ordered(days, [], ["order_date"]), {"p": F.col("c")}, ["order_date"]).result()
    return o.join(before, "order_date").select("order_id", "order_date", (F.col("c") + F.coalesce("p", F.lit(0))).alias("n"))


@query("sliding_max", "SELECT event_type, d, total, max(total) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS peak FROM (SELECT event_type, ts::DATE AS d, round(sum(value), 2) AS total FROM events GROUP BY 1, 2)")
def sliding_max(t):
    series = t.events.groupBy("event_type", day("ts").alias("d")).agg(F.round(F.sum("value"), 2).alias("total"))
    w = Window.partitionBy("event_type").orderBy("d").rowsBetween(-6, 0)
    return series.withColumn("peak", F.max("total").over(w))


@query("sliding_max_events", """SELECT event_id, event_type, max(value) OVER w AS peak, min(value) OVER w AS low, count(*) OVER w AS recent FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""")
def sliding_max_events(t):
    """Largest and smallest value of the last six hours in each type, over all events."""
    e = t.events.select("event_id", "event_type", "ts", "value")
    outs = {"peak": ("max", F.col("value")), "low": ("min", F.col("value")), "recent": ("count", F.lit(1))}
    return range_frame(e, ["event_type"], epoch_micros("ts"), 6 * 3_600_000_000, outs).drop("ts", "value")


# ---- percentiles and sketches ----

@query("median_per_group", f"SELECT customer_id, quantile_cont(amount, 0.5) AS median_amount FROM {ORDERS} GROUP BY 1")
def median_per_group(t):
    return quantiles(orders(t), ["customer_id"], "amount", {"median_amount": 0.5})


@query("median_no_percentile", "SELECT event_type, avg(value) AS median FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE rn IN ((n + 1) // 2, (n + 2) // 2) GROUP BY 1")
def median_no_percentile(t):
    # positions from running counts of the distinct values, never a whole group in one place
    counts = t.events.groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("c"))
    cum = running(ordered(counts, ["event_type"], ["value"]), {"upto": ("sum", F.col("c"))}).result()
    n = counts.groupBy("event_type").agg(F.sum("c").alias("n"))
    at = lambda i: F.max(F.when((F.col("upto") >= i) & (F.col("upto") - F.col("c") < i), F.col("value")))
    lo, hi = at(F.floor((F.col("n") + 1) / 2)), at(F.floor((F.col("n") + 2) / 2))
    return cum.join(n, "event_type").groupBy("event_type").agg(((lo + hi) / 2).alias("median"))


@query("approx_percentile", "SELECT l_returnflag, count(*) AS n, true AS median_close, true AS p95_close FROM lineitem GROUP BY 1")
def approx_percentile(t):
    """Approximate quantiles, with the share of rows below each shown to lie within the error bound."""
    probs = {"median": 0.5, "p95": 0.95}
    approx = cut_lineage(S.approx_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", probs))
    x = F.col("l_extendedprice")
    # the few groups go to the rows, which are neither shuffled nor sorted
    below = lookup_join(t.lineitem.select("l_returnflag", "l_extendedprice"), approx, "l_returnflag").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(x <= F.col("median")).alias("m"), F.count_if(x <= F.col("p95")).alias("p"))
    close = lambda got, p: F.abs(F.col(got) / F.col("n") - p) <= 0.001
    return below.select("l_returnflag", "n", close("m", 0.5).alias("median_close"), close("p", 0.95).alias("p95_close"))


@query("approx_distinct", "SELECT o_orderpriority, true AS within_bound FROM orders GROUP BY 1")
def approx_distinct(t):
    """Two estimates of the distinct customers, checked against the exact number."""
    # the sketches are their own aggregate: beside a distinct count they would be kept once per customer
    est = t.orders.groupBy("o_orderpriority").agg(
        F.approx_count_distinct("o_custkey", 0.02).alias("hll"), F.hll_sketch_estimate(F.hll_sketch_agg("o_custkey", F.lit(14))).alias("sketch"))
    exact = t.orders.select("o_orderpriority", "o_custkey").distinct().groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("exact"))
    off = lambda c: F.abs(F.col(c) - F.col("exact")) / F.col("exact") <= 0.08
    return est.join(exact, "o_orderpriority").select("o_orderpriority", (off("hll") & off("sketch")).alias("within_bound"))


@query("approx_top_k", "SELECT p_type AS item, count(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, item LIMIT 6")
def approx_top_k(t):
    return S.approx_top(t.part, "p_type", 6)


WEEK = "date_trunc('week', ts)::DATE"


def _weekly(t):
    return t.events.select(day("ts").alias("d"), "event_type", "user_id", "value")


@query("count_min_weeks", f"SELECT {WEEK} AS week, count(DISTINCT user_id) AS users, count(*) AS events, true AS never_below, true AS within_bound FROM events GROUP BY 1")
def count_min_weeks(t):
    """Daily Count-Min states merged to weeks; every user's estimate is held against the exact count."""
    e, week = _weekly(t), F.trunc("d", "week").alias("week")
    cells, heap = S.count_min_states(e, [F.col("d")], "user_id")
    cells, _ = S.merge_count_min(cells, heap, [week])
    exact = e.groupBy(week, "user_id").agg(F.count(F.lit(1)).alias("n"))
    total = exact.groupBy("week").agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("users"))
    got = S.count_min_estimates(cells, exact.select("week", "user_id"), ["week"], "user_id").join(exact, ["week", "user_id"]).join(total, "week")
    over = F.col("estimate") - F.col("n")
    return got.groupBy("week", "users", "events").agg(F.min(over >= 0).alias("never_below"), F.min(over <= F.ceil(F.col("events") * 0.001)).alias("within_bound"))


@query("heavy_hitters", """WITH c AS (SELECT year(l_shipdate)::INTEGER AS y, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT y, sum(n)::BIGINT AS total FROM c GROUP BY 1)
  SELECT y, l_returnflag, n AS estimate, total FROM c JOIN t USING (y) WHERE n >= 0.3::DOUBLE * total""")
def heavy_hitters(t):
    """Return flags of at least three tenths of a year's lines, from monthly states."""
    lines = t.lineitem.select(F.trunc("l_shipdate", "month").alias("m"), "l_returnflag")
    cells, heap = S.merge_count_min(*S.count_min_states(lines, [F.col("m")], "l_returnflag"), [F.year("m").alias("y")])
    return S.heavy_hitters(cells, heap, ["y"], "l_returnflag", 0.3)


@query("kll_weeks", f"SELECT event_type, {WEEK} AS week, count(value) AS n, true AS median_close, true AS p95_close FROM events GROUP BY 1, 2")
def kll_weeks(t):
    """Weekly quantiles from daily KLL states; the share of values below each is held against the exact one."""
    e, week = _weekly(t), F.trunc("d", "week").alias("week")
    states = S.quantile_states(e, [F.col("event_type"), F.col("d")], "value")
    got = S.merge_quantiles(states, [F.col("event_type"), week], {"median": 0.5, "p95": 0.95})
    x, n = F.col("value"), F.col("n")
    met = e.select("event_type", week, "value").join(got, ["event_type", "week"]).groupBy("event_type", "week", "n").agg(
        *[F.count_if(x < F.col(q)).alias(f"{q}_low") for q in ("median", "p95")], *[F.count_if(x <= F.col(q)).alias(f"{q}_high") for q in ("median", "p95")])
    close = lambda q, p: (F.col(f"{q}_low") <= n * (p + 0.015) + 1) & (F.col(f"{q}_high") >= n * (p - 0.015) - 1)
    return met.select("event_type", "week", "n", close("median", 0.5).alias("median_close"), close("p95", 0.95).alias("p95_close"))


@query("theta_weeks", f"""WITH s AS (SELECT DISTINCT {WEEK} AS week, user_id FROM events), n AS (SELECT week, count(*) AS size FROM s GROUP BY 1),
  k AS (SELECT a.week, count(*) AS kept FROM s a JOIN s b ON b.user_id = a.user_id AND b.week = a.week - INTERVAL 7 DAY GROUP BY 1)
  SELECT n.week, n.size, CASE WHEN p.size IS NOT NULL THEN coalesce(kept, 0) END AS kept, CASE WHEN p.size IS NOT NULL THEN n.size - coalesce(kept, 0) END AS gained, p.size - coalesce(kept, 0) AS lost
  FROM n LEFT JOIN k USING (week) LEFT JOIN n p ON p.week = n.week - INTERVAL 7 DAY""")
def theta_weeks(t):
    """Users kept, gained and lost from week to week, from theta states alone (exact below 16 384 users a week)."""
    states = S.set_states(_weekly(t), [F.trunc("d", "week").alias("week")], "user_id")
    return S.set_changes(states, "week", F.date_add("week", 7))


@query("group_array", """SELECT user_id, (rn - 1) // 1000 AS page, list(event_id ORDER BY rn) AS items FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1, 2""")
def group_array(t):
    return S.paged_arrays(t.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], "event_id")


@query("group_uniq_array", "SELECT user_id, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY 1")
def group_uniq_array(t):
    # at most one element per event type
    return t.events.groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("types"))


@query("group_bitmap", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS distinct_items FROM orders GROUP BY 1")
def group_bitmap(t):
    return S.distinct_by_bitmap(t.orders, ["o_orderstatus"], "o_custkey")


@query("partial_agg_state", "SELECT event_type, date_trunc('week', ts)::DATE AS week, count(*) AS n, round(sum(value), 2) AS total, count(DISTINCT user_id) AS approx_users FROM events GROUP BY 1, 2")
def partial_agg_state(t):
    states = S.daily_states(t.events, [F.col("event_type"), day("ts").alias("d")], "value", "user_id")
    return S.merge_states(states, [F.col("event_type"), F.trunc("d", "week").alias("week")])


@query("merge_intervals", f"""WITH s AS (SELECT customer_id, order_id, order_date AS start_date, order_date + CAST(order_id % 60 + 30 AS INTEGER) AS end_date FROM {ORDERS}),
  r AS (SELECT *, max(end_date) OVER (PARTITION BY customer_id ORDER BY start_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
  g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_date > reach THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY start_date, order_id ROWS UNBOUNDED PRECEDING) AS island FROM r)
  SELECT customer_id, min(start_date) AS start_date, max(end_date) AS end_date, count(*) AS merged FROM g GROUP BY customer_id, island""")
def merge_intervals(t):
    from tidewater.plans.bindings import subscriptions

    return P.merge_intervals(subscriptions(t), ["customer_id"], "start_date", "end_date", "subscription_id")


@query("group_anagrams", """WITH w AS (SELECT DISTINCT unnest(string_split(regexp_replace(lower(text), '[^\\p{L} ]', ' ', 'g'), ' ')) AS word FROM documents),
  k AS (SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS letters FROM w WHERE word <> ''),
  c AS (SELECT letters, count(*) AS size FROM k GROUP BY 1 HAVING count(*) > 1) SELECT letters, word, size FROM k JOIN c USING (letters)""")
def group_anagrams(t):
    from tidewater.functions.text import words
    from tidewater.operators.control import spread

    w = spread(t.documents.select("doc_id", "text"), "doc_id").select(F.explode(words("text")).alias("word")).distinct()
    keyed = w.withColumn("letters", F.array_join(F.array_sort(F.split("word", "")), ""))
    size = keyed.groupBy("letters").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return keyed.join(size, "letters").select("letters", "word", "size")


# ---- sessions, streaks, gaps, hierarchies, funnels ----

SESSIONS = """WITH f AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_id FROM f)
  SELECT user_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events FROM s GROUP BY 1, 2"""


@query("sessionize", SESSIONS)
def sessionize(t):
    return P.sessions(t.events.select("user_id", "ts", "event_id"), "user_id", "ts", "event_id")


STREAKS = """WITH d AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events),
  g AS (SELECT user_id, d, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS island FROM d)
  SELECT user_id, min(d) AS streak_start, max(d) AS streak_end, count(*) AS streak_length FROM g GROUP BY user_id, island"""


@query("login_streaks", STREAKS)
def login_streaks(t):
    return P.streaks(t.events, "user_id", "ts")


@query("consecutive_purchases", STREAKS.replace("FROM events", "FROM events WHERE event_type = 'purchase'") + " HAVING count(*) >= 2")
def consecutive_purchases(t):
    return P.streaks(t.events.where("event_type = 'purchase'"), "user_id", "ts").where("streak_length >= 2")


@query("gap_days", f"WITH d AS (SELECT DISTINCT customer_id, order_date AS order_day FROM {ORDERS}), g AS (SELECT *, lag(order_day) OVER (PARTITION BY customer_id ORDER BY order_day) AS previous_day FROM d) SELECT customer_id, previous_day, order_day, date_diff('day', previous_day, order_day) AS gap_days FROM g WHERE date_diff('day', previous_day, order_day) > 1")
def gap_days(t):
    return P.day_gaps(orders(t), "order_date", ["customer_id"])


@query("missing_dates", """WITH b AS (SELECT l_suppkey, min(l_shipdate)::DATE AS lo, max(l_shipdate)::DATE AS hi FROM lineitem GROUP BY 1)
  SELECT l_suppkey, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM b EXCEPT SELECT l_suppkey, l_shipdate::DATE FROM lineitem""")
def missing_dates(t):
    return P.missing_dates(t.lineitem, "l_shipdate", ["l_suppkey"])


TREE = f"""WITH RECURSIVE h AS (SELECT employee_id, manager_id, employee_name, 1::BIGINT AS level, employee_name AS path FROM {EMPLOYEES} WHERE manager_id IS NULL
  UNION ALL SELECT e.employee_id, e.manager_id, e.employee_name, h.level + 1, h.path || ' > ' || e.employee_name FROM {EMPLOYEES} e JOIN h ON e.manager_id = h.employee_id) SELECT * FROM h"""


@query("hierarchy_levels", TREE)
def hierarchy_levels(t):
    tree = P.hierarchy(employees(t), "employee_id", "manager_id", "employee_name")
    return tree.select(F.col("node").alias("employee_id"), F.col("parent").alias("manager_id"), F.col("name").alias("employee_name"), "level", "path")


@query("total_reports", f"""WITH RECURSIVE r AS (SELECT employee_id AS manager_id, employee_id AS report_id FROM {EMPLOYEES}
  UNION ALL SELECT r.manager_id, e.employee_id FROM r JOIN {EMPLOYEES} e ON e.manager_id = r.report_id) SELECT manager_id, count(*) - 1 AS total_reports FROM r GROUP BY 1""")
def total_reports(t):
    return P.total_reports(employees(t), "employee_id", "manager_id", "employee_name")


@query("detect_change", "SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) WHERE prev IS DISTINCT FROM event_type")
def detect_change(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return P.changed_rows(e, ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "user_id", "event_type")


def _steps(*kinds):
    return [F.col("event_type") == k for k in kinds]


@query("window_funnel", """WITH v AS (SELECT user_id, ts AS t0 FROM events WHERE event_type = 'view'),
  c AS (SELECT v.user_id, v.t0, min(e.ts) AS t1 FROM v JOIN events e ON e.user_id = v.user_id AND e.event_type = 'click' AND e.ts > v.t0 AND e.ts <= v.t0 + INTERVAL 6 HOUR GROUP BY 1, 2),
  p AS (SELECT c.user_id, c.t0, min(e.ts) AS t2 FROM c JOIN events e ON e.user_id = c.user_id AND e.event_type = 'purchase' AND e.ts > c.t1 AND e.ts <= c.t0 + INTERVAL 6 HOUR GROUP BY 1, 2)
  SELECT u.user_id, CASE WHEN u.user_id IN (SELECT user_id FROM p) THEN 3 WHEN u.user_id IN (SELECT user_id FROM c) THEN 2 WHEN u.user_id IN (SELECT user_id FROM v) THEN 1 ELSE 0 END::BIGINT AS level FROM (SELECT DISTINCT user_id FROM events) u""")
def window_funnel(t):
    return P.window_funnel(t.events, "user_id", "ts", "event_id", _steps("view", "click", "purchase"), 6 * 3600)


@query("sequence_match", "SELECT user_id, count(*) AS matches FROM (SELECT *, lag(event_type) OVER w AS p1, lag(event_type, 2) OVER w AS p2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE p2 = 'view' AND p1 = 'click' AND event_type = 'purchase' GROUP BY 1")
def sequence_match(t):
    return P.sequence_match(t.events, "user_id", "ts", "event_id", _steps("view", "click", "purchase"))


#: A user's events as one letter each, in order: a regular expression finds the same matches.
LETTERS_SQL = "(SELECT user_id, count(*) AS events, string_agg(CASE event_type WHEN 'purchase' THEN 'p' WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' ELSE 'x' END, '' ORDER BY ts, event_id) AS s FROM events GROUP BY 1)"


@query("sequence_later", f"SELECT user_id, events, len(regexp_extract_all(s, 'v.*?p')) AS matches FROM {LETTERS_SQL}")
def sequence_later(t):
    """A view and, anywhere later, a purchase."""
    view, purchase = _steps("view", "purchase")
    return sequence_counts(t.events, "user_id", "ts", "event_id", [Step(view), Step(purchase)])


@query("sequence_repeat", f"SELECT user_id, events, len(regexp_extract_all(s, 'vv.*?cp')) AS matches FROM {LETTERS_SQL}")
def sequence_repeat(t):
    """Two views in a row, then anywhere later a click and right after it a purchase."""
    view, click, purchase = _steps("view", "click", "purchase")
    return sequence_counts(t.events, "user_id", "ts", "event_id", [Step(view), Step(view, "next"), Step(click), Step(purchase, "next")])


@query("sequence_within", """WITH e AS (SELECT *, lag(event_type) OVER w AS p, lag(ts) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  SELECT user_id, count(*) AS events, count(*) FILTER (event_type = 'click' AND p = 'view' AND ts - before <= INTERVAL 2 DAY) AS matches FROM e GROUP BY 1""")
def sequence_within(t):
    """A click right after a view, at most two days later."""
    view, click = _steps("view", "click")
    return sequence_counts(t.events, "user_id", "ts", "event_id", [Step(view), Step(click, "next", within=2 * 86_400)])


@query("ordered_chain", """WITH a AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY 1), b AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN a ON a.user_id = e.user_id AND e.ts > a.t WHERE event_type = 'view' GROUP BY 1)
  SELECT DISTINCT e.user_id FROM events e JOIN b ON b.user_id = e.user_id AND e.ts > b.t WHERE event_type = 'purchase'""")
def ordered_chain(t):
    return P.ordered_chain(t.events, "user_id", "ts", _steps("signup", "view", "purchase"))
