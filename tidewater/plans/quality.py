"""Data quality, schema and governance queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.dates import day, epoch_micros, month
from tidewater.operators import governance as G
from tidewater.operators import parity as P
from tidewater.operators import quality as Q
from tidewater.operators.control import spread
from tidewater.operators.ordered import ordered, shift
from tidewater.operators.ranking import quantiles
from tidewater.operators.schemas import drift_report
from tidewater.plans.bindings import CUSTOMERS, EMPLOYEES, customers, employees
from tidewater.plans.registry import query
from tidewater.session import scratch_path


@query("quality_report", f"""WITH c AS {CUSTOMERS} SELECT 'total_rows' AS metric, count(*) AS value FROM c UNION ALL SELECT 'duplicate_keys', count(*) - (SELECT count(*) FROM (SELECT DISTINCT email FROM c)) FROM c
  UNION ALL SELECT 'null:email', count(*) - count(email) FROM c UNION ALL SELECT 'null:customer_id', count(*) - count(customer_id) FROM c UNION ALL SELECT 'null:city', count(*) - count(city) FROM c""")
def quality_report(t):
    return Q.quality_report(customers(t).select("customer_id", "email", "city"), ["email"])


@query("validate_orders", """SELECT 'line ' || l_orderkey || '/' || l_linenumber AS row_id, 'duplicate id' AS rule FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL SELECT 'customer ' || c_custkey, 'negative amount' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'customer ' || c_custkey, 'missing email' FROM customer WHERE c_custkey % 10 = 0""")
def validate_orders(t):
    twice = Q.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])
    lines = twice.select(F.concat(F.lit("line "), F.col("l_orderkey"), F.lit("/"), F.col("l_linenumber")).alias("row_id"), F.lit("duplicate id").alias("rule"))
    c = customers(t).join(t.customer.select(F.col("c_custkey").alias("customer_id"), "c_acctbal"), "customer_id")
    broken = Q.violations(c.withColumn("row_id", F.concat(F.lit("customer "), F.col("customer_id"))), ["row_id"],
                          {"negative amount": F.coalesce("c_acctbal", F.lit(0.0)) < 0, "missing email": F.col("email").isNull()})
    return lines.unionByName(broken)


@query("generic_tests", f"""WITH c AS {CUSTOMERS} SELECT 'unique' AS test, count(*) AS failures FROM (SELECT lower(email) FROM c WHERE email IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'not_null', count(*) FROM c WHERE email IS NULL
  UNION ALL SELECT 'accepted_values', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'relationships', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
  UNION ALL SELECT 'positive_price', count(*) FROM lineitem WHERE l_extendedprice <= 0""")
def generic_tests(t):
    n = lambda df, name: df.agg(F.lit(name).alias("test"), F.count(F.lit(1)).alias("failures"))
    c = customers(t)
    listed = t.customer.where("c_mktsegment <> 'BUILDING'")
    out = n(Q.duplicates(c.where("email IS NOT NULL").select(F.lower("email").alias("email")), ["email"]), "unique")
    for df, name in [
        (c.where("email IS NULL"), "not_null"),
        (t.orders.where(~F.col("o_orderstatus").isin("F", "O")), "accepted_values"),
        (Q.orphans(t.orders, "o_custkey", listed, "c_custkey"), "relationships"),
        (t.lineitem.where("l_extendedprice <= 0"), "positive_price"),
    ]:
        out = out.unionByName(n(df, name))
    return out


@query("volume_anomaly", """WITH d AS (SELECT ts::DATE AS d, count(*) AS n FROM events GROUP BY 1), w AS (SELECT d, n, sum(n) OVER x AS s, count(n) OVER x AS c FROM d WINDOW x AS (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  SELECT d, n, s / c AS usual, n / (s / c) AS ratio, abs(n / (s / c) - 1) > 0.1 AS suspicious FROM w""")
def volume_anomaly(t):
    return Q.volume_check(t.events, day("ts")).withColumn("suspicious", F.abs(F.col("ratio") - 1) > 0.1)


@query("freshness", "SELECT event_type, max(ts) AS newest, date_diff('day', max(ts)::DATE, DATE '2024-02-01') AS age_days FROM events GROUP BY 1")
def freshness(t):
    newest = t.events.groupBy("event_type").agg(F.max("ts").alias("newest"))
    return newest.withColumn("age_days", F.date_diff(F.lit("2024-02-01").cast("date"), day("newest")).cast("bigint"))


@query("dq_dimensions", f"""SELECT count(email)::DOUBLE / count(*) AS completeness, (SELECT count(*)::DOUBLE FROM (SELECT DISTINCT lower(email) FROM {CUSTOMERS} WHERE email IS NOT NULL)) / count(email) AS uniqueness,
  (count(*) FILTER (WHERE regexp_matches(email, '^[^@]+@[a-z]+[.]com$')))::DOUBLE / count(email) AS validity FROM {CUSTOMERS}""")
def dq_dimensions(t):
    per_email = customers(t).groupBy(F.lower("email").alias("email")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("email").rlike("^[^@]+@[a-z]+[.]com$")).alias("valid"))
    known = F.col("email").isNotNull()
    sums = per_email.agg(F.sum("n").alias("n"), F.sum(F.when(known, F.col("n"))).alias("k"), F.count("email").alias("u"), F.sum(F.when(known, F.col("valid"))).alias("v"))
    return sums.select(F.try_divide("k", "n").alias("completeness"), F.try_divide("u", "k").alias("uniqueness"), F.try_divide("v", "k").alias("validity"))


@query("dq_timeliness", """WITH f AS (SELECT l_orderkey, min(l_shipdate)::DATE AS first FROM lineitem GROUP BY 1)
  SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE coalesce(date_diff('day', o_orderdate::DATE, first) > 30, true)) AS late, round(1 - (count(*) FILTER (WHERE coalesce(date_diff('day', o_orderdate::DATE, first) > 30, true)))::DOUBLE / count(*), 6) AS timeliness
  FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 1""")
def dq_timeliness(t):
    """Orders whose first line was shipped within thirty days."""
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("first"))
    shipped = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority").join(first, "o_orderkey", "left")
    return Q.timeliness(shipped, ["o_orderpriority"], day("o_orderdate"), day("first"), 30)


@query("reconcile", """WITH b AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 97 <> 0)
  SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_left' ELSE 'differs' END AS status FROM orders a LEFT JOIN b USING (o_orderkey) WHERE b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""")
def reconcile(t):
    k = F.col("o_orderkey")
    other = t.orders.where(k % 97 != 0).withColumn("o_totalprice", F.when(k % 100 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return Q.reconcile(t.orders, other, "o_orderkey", ["o_orderstatus", "o_totalprice"])


COPY = """(SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 500 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 490 <> 7
  UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 700 = 3)"""


def _copy(t):
    """A copy of the orders with some prices changed, some orders missing and some added."""
    k = F.col("o_orderkey")
    cols = ["o_custkey", "o_orderstatus"]
    kept = t.orders.where(k % 490 != 7).select(k, *cols, F.when(k % 500 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return kept.unionByName(t.orders.where(k % 700 == 3).select((-k).alias("o_orderkey"), *cols, "o_totalprice"))


@query("parity_tree", f"""SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_left' WHEN a.o_orderkey IS NULL THEN 'only_right' ELSE 'differs' END AS status
  FROM orders a FULL JOIN {COPY} b USING (o_orderkey) WHERE a.o_orderstatus IS NULL OR b.o_orderstatus IS NULL OR a.o_totalprice <> b.o_totalprice""")
def parity_tree(t):
    return P.differing_keys(t.orders, _copy(t), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query("parity_sums", f"""WITH a AS (SELECT o_orderstatus AS bucket, count(*) AS n, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1), b AS (SELECT o_orderstatus AS bucket, count(*) AS n, round(sum(o_totalprice), 2) AS price FROM {COPY} GROUP BY 1)
  SELECT bucket, a.n AS left_rows, b.n AS right_rows, a.price AS left_price, b.price AS right_price, false AS same FROM a JOIN b USING (bucket)""")
def parity_sums(t):
    """Rows, price totals and row checksums of both sides by status."""
    sides = [P.checksums(df.select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"], ["o_totalprice"], bucket="o_orderstatus") for df in (t.orders, _copy(t))]
    l, r = (s.select("bucket", F.col("n").alias(f"{x}_rows"), F.round("sums.o_totalprice", 2).alias(f"{x}_price"), F.struct("total", "mixed").alias(f"{x}_sum")) for x, s in zip(("left", "right"), sides))
    return l.join(r, "bucket").withColumn("same", F.col("left_sum").eqNullSafe(F.col("right_sum"))).drop("left_sum", "right_sum")


@query("parity_gate", """SELECT o_orderstatus, count(*) AS left_rows, count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS right_rows, (count(*) FILTER (WHERE o_orderkey % 97 <> 0))::DOUBLE / count(*) >= 0.999 AS passed FROM orders GROUP BY 1""")
def parity_gate(t):
    left = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("left_rows"))
    right = t.orders.where("o_orderkey % 97 <> 0").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("right_rows"))
    both = left.join(right, "o_orderstatus", "full").fillna(0)
    return both.withColumn("passed", F.try_divide(F.least("left_rows", "right_rows"), F.greatest("left_rows", "right_rows")) >= 0.999)


@query("drift_psi", f"""WITH b AS (SELECT l_extendedprice AS x FROM lineitem WHERE l_shipdate < DATE '1998-01-01'), c AS (SELECT l_extendedprice * 1.5 AS x FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'),
  q AS (SELECT quantile_cont(x, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e FROM b),
  eb AS (SELECT len(list_filter(e, lambda y: x > y)) AS bin, count(*) AS n FROM b, q GROUP BY 1), cb AS (SELECT len(list_filter(e, lambda y: x > y)) AS bin, count(*) AS n FROM c, q GROUP BY 1),
  s AS (SELECT coalesce(eb.n, 0) / (SELECT sum(n) FROM eb) AS e, coalesce(cb.n, 0) / (SELECT sum(n) FROM cb) AS a FROM eb FULL JOIN cb USING (bin)),
  f AS (SELECT e AS e0, a AS a0, greatest(e, 1e-6) AS e, greatest(a, 1e-6) AS a FROM s)
  SELECT round(sum((a - e) * ln(a / e)), 8) AS psi, round(sum(a * ln(a / e)), 8) AS kl, round(sum((a0 - e0) * (a0 - e0) / e) * (SELECT sum(n) FROM cb), 4) AS chi_square, round(sum((a - e) * ln(a / e)), 8) > 0.2 AS drifted FROM f""")
def drift_psi(t):
    cut = F.expr("TIMESTAMP_NTZ'1998-01-01'")
    lines = t.lineitem.select("l_shipdate", F.col("l_extendedprice").alias("x"))
    baseline = lines.where(F.col("l_shipdate") < cut)
    current = lines.where(F.col("l_shipdate") >= cut).withColumn("x", F.col("x") * 1.5)
    edges = list(quantiles(baseline, [], "x", {f"q{i}": i / 10 for i in range(1, 10)}).first())
    return Q.drift(baseline, current, "x", edges)


@query("annotator_agreement", """WITH c AS (SELECT quality AS a, toxic AS b, count(*)::DOUBLE AS n FROM labels GROUP BY 1, 2), s AS (SELECT sum(n) AS t, sum(CASE WHEN a = b THEN n ELSE 0 END) AS same FROM c),
  e AS (SELECT sum(x * y) AS p FROM (SELECT a AS l, sum(n) AS x FROM c GROUP BY 1) JOIN (SELECT b AS l, sum(n) AS y FROM c GROUP BY 1) USING (l))
  SELECT same / t AS observed, round((same / t - p / (t * t)) / (1 - p / (t * t)), 8) AS kappa FROM s, e""")
def annotator_agreement(t):
    return Q.kappa(t.labels, "quality", "toxic")


@query("ledger_reconcile", """SELECT l_orderkey, count(*) AS entries, sum(a)::DOUBLE AS balance FROM (SELECT l_orderkey, l_extendedprice::DECIMAL(20,4) AS a FROM lineitem
  UNION ALL SELECT l_orderkey, -l_extendedprice::DECIMAL(20,4) FROM lineitem WHERE l_quantity < 50) GROUP BY 1 HAVING sum(a) <> 0""")
def ledger_reconcile(t):
    # each line is booked twice, except that the counter entry of the largest ones is missing
    debit, credit = F.col("l_extendedprice"), F.when(F.col("l_quantity") < 50, -F.col("l_extendedprice"))
    entries = t.lineitem.select("l_orderkey", F.explode(F.array(debit, credit)).alias("amount")).where("amount IS NOT NULL")
    return Q.unbalanced(entries, "l_orderkey", "amount").withColumn("balance", F.col("balance").cast("double"))


@query("statement_match", """WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 89 <> 0)
  SELECT CASE WHEN s.k IS NULL THEN 'missing in statement' WHEN s.v <> o_totalprice THEN 'amount differs' ELSE 'matched' END AS status, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders LEFT JOIN s ON s.k = o_orderkey GROUP BY 1""")
def statement_match(t):
    k = F.col("o_orderkey")
    statement = t.orders.where(k % 89 != 0).select(k, F.when(k % 100 == 0, F.col("o_totalprice") + 5).otherwise(F.col("o_totalprice")).alias("paid"))
    both = t.orders.select(k, "o_totalprice").join(statement, "o_orderkey", "full")
    status = (F.when(F.col("paid").isNull(), "missing in statement").when(F.col("o_totalprice").isNull(), "missing in ledger")
              .when(F.col("paid") != F.col("o_totalprice"), "amount differs").otherwise("matched"))
    return both.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"))


@query("dataset_slo", """WITH g AS (SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS us FROM events), s AS (SELECT event_type, us / 1000000.0::DOUBLE AS s FROM g WHERE us IS NOT NULL)
  SELECT event_type, count(*) AS n, (count(*) FILTER (WHERE s <= 1800))::DOUBLE / count(*) AS within, round(quantile_cont(s, 0.95), 3) AS p95 FROM s GROUP BY 1""")
def dataset_slo(t):
    e = t.events.select("event_type", "event_id", epoch_micros("ts").alias("at"))
    gaps = shift(ordered(e, ["event_type"], ["at", "event_id"]), {"prev": F.col("at")}, ["at", "event_id"]).result()
    lag = gaps.select("event_type", ((F.col("at") - F.col("prev")) / 1_000_000).alias("lag"))
    return Q.dataset_slo(lag, ["event_type"], "lag", 1800).withColumn("p95", F.round("p95", 3))


# ---- schemas ----

@query("schema_drift", """SELECT 'source' AS column_name, 'type string, expected int' AS issue, count(*) FILTER (WHERE try_cast(source AS INTEGER) IS NULL) AS bad_rows FROM documents
  UNION ALL SELECT 'n_chars', 'type bigint, expected smallint', count(*) FILTER (WHERE try_cast(n_chars AS SMALLINT) IS NULL) FROM documents
  UNION ALL SELECT 'country', 'missing', count(*) FROM documents UNION ALL SELECT 'text', 'unexpected', 0 UNION ALL SELECT 'lang', 'unexpected', 0""")
def schema_drift(t):
    contract = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.IntegerType()), T.StructField("n_chars", T.ShortType()), T.StructField("country", T.StringType())])
    return drift_report(t.documents, contract)


@query("schema_evolve_read", "SELECT event_type, count(*) AS n, count(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END) AS with_props FROM events GROUP BY 1")
def schema_evolve_read(t):
    """Older files lack a column; the merged schema reads it as null."""
    cut = F.expr("TIMESTAMP_NTZ'2024-01-15'")
    root = scratch_path(t.spark, "evolving")
    t.events.where(F.col("ts") < cut).drop("props").write.parquet(f"{root}/part=1")
    t.events.where(F.col("ts") >= cut).write.parquet(f"{root}/part=2")
    merged = t.spark.read.option("mergeSchema", True).parquet(root)
    return merged.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("props").alias("with_props"))


# ---- governance ----

@query("lineage_graph", f"""WITH RECURSIVE u AS (SELECT manager_id AS source, employee_id AS target, 1::BIGINT AS distance FROM {EMPLOYEES} WHERE manager_id IS NOT NULL
  UNION ALL SELECT e.manager_id, u.target, u.distance + 1 FROM u JOIN {EMPLOYEES} e ON e.employee_id = u.source WHERE e.manager_id IS NOT NULL) SELECT source, target, min(distance) AS distance FROM u GROUP BY 1, 2""")
def lineage_graph(t):
    return G.upstream_all(employees(t).where("manager_id IS NOT NULL"), "manager_id", "employee_id")


def _pattern(kind):
    return G.PII_PATTERNS[kind]


@query("pii_detect", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS kind, sum(len(regexp_extract_all({c}, '{p}')))::BIGINT AS matches, count(*) FILTER (WHERE regexp_matches({c}, '{p}')) AS matching_rows FROM documents"
    for c in ("text", "source") for k, p in G.PII_PATTERNS.items()))
def pii_detect(t):
    return G.pii_report(spread(t.documents.select("doc_id", "text", "source"), "doc_id"), ["text", "source"])


_REDACT = "text"
for _kind, _p in G.PII_PATTERNS.items():
    _REDACT = f"regexp_replace({_REDACT}, '{_p}', '[{_kind}]', 'g')"


@query("pii_redact", f"SELECT doc_id, {_REDACT} AS text, sha256('s1' || source) AS source_token FROM documents")
def pii_redact(t):
    docs = spread(t.documents.select("doc_id", "text", "source"), "doc_id")
    return docs.select("doc_id", G.redact(F.col("text")).alias("text"), G.token_of(F.col("source"), "s1").alias("source_token"))


@query("cost_showback", """WITH m AS (SELECT p_type AS tag, date_trunc('month', l_shipdate)::DATE AS month, round(sum(l_extendedprice), 2) AS spend FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
  w AS (SELECT *, round(sum(spend) OVER x, 2) / nullif(count(spend) OVER x, 0) AS usual, stddev_samp(spend) OVER x AS sd FROM m WINDOW x AS (PARTITION BY tag ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
  SELECT tag, month, spend, usual, coalesce(spend > usual + 2 * sd, false) AS jump FROM w""")
def cost_showback(t):
    per_part = t.lineitem.groupBy("l_partkey", month("l_shipdate").alias("month")).agg(F.sum("l_extendedprice").alias("s"))
    tags = t.part.select("p_partkey", F.col("p_type").alias("tag"))
    m = per_part.join(tags, F.col("l_partkey") == F.col("p_partkey")).groupBy("tag", "month").agg(F.round(F.sum("s"), 2).alias("spend"))
    w = Window.partitionBy("tag").orderBy("month").rowsBetween(-6, -1)  # one row per tag and month
    usual, sd = F.try_divide(F.round(F.sum("spend").over(w), 2), F.count("spend").over(w)), F.stddev_samp("spend").over(w)
    return m.withColumns({"u": usual, "sd": sd}).select("tag", "month", "spend", F.col("u").alias("usual"), F.coalesce(F.col("spend") > F.col("u") + 2 * F.col("sd"), F.lit(False)).alias("jump"))


@query("top_spenders", "SELECT l_orderkey, round(sum(l_extendedprice), 2) AS credits FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_spenders(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("credits")).orderBy(F.desc("credits"), "l_orderkey").limit(20)


@query("audit_patterns", """WITH d AS (SELECT user_id, ts::DATE AS d, count(*) AS n FROM events GROUP BY 1, 2), u AS (SELECT user_id, sum(n) / count(*) AS usual FROM d GROUP BY 1)
  SELECT user_id, d, n, usual FROM d JOIN u USING (user_id) WHERE n >= 2 * usual""")
def audit_patterns(t):
    daily = t.events.groupBy("user_id", day("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = daily.groupBy("user_id").agg((F.sum("n") / F.count(F.lit(1))).alias("usual"))
    return daily.join(usual, "user_id").where("n >= 2 * usual").select("user_id", "d", "n", "usual")
