"""Small hand-checked inputs."""

import datetime as dt

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.functions import dates as D
from tidewater.functions import jsons as J
from tidewater.functions import strings as S
from tidewater.functions import udfs as U
from tidewater.functions.text import words
from tidewater.operators import governance as G
from tidewater.operators import incremental as I
from tidewater.operators import merge as M
from tidewater.operators import patterns as P
from tidewater.operators import quality as Q
from tidewater.operators.activity import variant_of
from tidewater.operators.ranking import latest, nth_highest, top_n
from tidewater.operators.schemas import drift_report, schema_compat, schema_drift
from tidewater.operators.steps import run_steps
from tidewater.sources import readers as R
from tidewater.sources.paginated import PagedReader
from pyspark.sql import types as T


def day(s):
    return dt.date.fromisoformat(s)


def test_latest_record(spark):
    df = spark.createDataFrame([(1, "Asha", "01-01"), (1, "Asha", "01-03"), (2, "Ravi", "01-02")], "id int, name string, at string")
    assert rows(latest(df, ["id"], ["at"]), "id", "at") == [(1, "01-03"), (2, "01-02")]


def test_nth_salary_and_top_n(spark):
    df = spark.createDataFrame([("HR", "A", 50000), ("HR", "B", 70000), ("HR", "C", 70000), ("ENG", "D", 90000), ("ENG", "E", 80000)], "dept string, name string, salary int")
    assert rows(nth_highest(df, ["dept"], "salary", 2), "dept", "name", "salary") == [("ENG", "E", 80000), ("HR", "A", 50000)]
    assert rows(top_n(df, ["dept"], [F.desc("salary"), F.asc("name")], 1), "dept", "name") == [("ENG", "D"), ("HR", "B")]


def test_sessions_split_only_after_more_than_the_gap(spark):
    at = lambda s: dt.datetime.fromisoformat(f"2026-01-01 {s}")
    df = spark.createDataFrame([(1, "u1", at("10:00:00")), (2, "u1", at("10:10:00")), (3, "u1", at("10:40:00")), (4, "u1", at("11:10:01")), (5, "u2", at("10:00:00"))], "id int, u string, ts timestamp_ntz")
    got = rows(P.with_sessions(df, "u", "ts", "id", hot_rows=2), "id", "session_id")
    assert got == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 1)]


def test_word_count_drops_empty_tokens_and_keeps_letters(spark):
    df = spark.createDataFrame([("hello world  hello spark",), ("data engineer, spark WORLD Größe",)], "line string")
    counts = df.select(F.explode(words("line")).alias("w")).groupBy("w").count()
    assert dict(rows(counts)) == {"hello": 2, "world": 2, "spark": 2, "data": 1, "engineer": 1, "größe": 1}


def test_cdc_merge_and_strict_merge(spark):
    target = spark.createDataFrame([(1, "Asha", "Pune"), (2, "Ravi", "Delhi"), (5, "Old", "X")], "id int, name string, city string")
    changes = spark.createDataFrame(
        [(1, "Asha", "Bengaluru", "UPDATE", 2), (1, "Asha", "Wrong", "DELETE", 1), (3, "Meera", "Mumbai", "INSERT", 2), (2, "Ravi", "Delhi", "DELETE", 2), (4, "New", "Goa", "UPDATE", 1), (5, None, "Y", "INSERT", 1)],
        "id int, name string, city string, op string, ts int")
    once = M.cdc_merge(target, changes, "id", "op", ["ts"])
    assert rows(once, "id", "city") == [(1, "Bengaluru"), (3, "Mumbai"), (4, "Goa"), (5, "Y")]
    assert rows(M.cdc_merge(once, changes, "id", "op", ["ts"])) == rows(once)
    # an unmatched UPDATE and a matched INSERT do nothing here
    assert rows(M.merge_upsert(target, changes, "id", "op", ["ts"]), "id", "city") == [(1, "Bengaluru"), (3, "Mumbai"), (5, "X")]


DIM = "customer_id int, name string, city string, valid_from date, valid_to date, is_current boolean"


def test_scd2_keeps_history_and_sees_nulls(spark):
    dim = spark.createDataFrame(
        [(1, "Asha", "Goa", day("2024-01-01"), day("2025-01-01"), False), (1, "Asha", "Pune", day("2025-01-01"), None, True),
         (2, "Ravi", "Delhi", day("2025-01-01"), None, True), (4, "Nia", None, day("2025-01-01"), None, True)], DIM)
    incoming = spark.createDataFrame([(1, "Asha", "Agra", 1), (1, "Asha", "Bengaluru", 2), (2, "Ravi", "Delhi", 1), (3, "Meera", "Mumbai", 1), (4, "Nia", "Kochi", 1)], "customer_id int, name string, city string, seq int")
    out = M.scd2_apply(dim, incoming, "customer_id", ["city"], "2026-02-01", order=["seq"])
    got = rows(out, "customer_id", "city", "valid_from", "valid_to", "is_current")
    assert len(got) == 7
    assert (1, "Goa", day("2024-01-01"), day("2025-01-01"), False) in got
    assert (1, "Pune", day("2025-01-01"), day("2026-02-01"), False) in got
    assert (1, "Bengaluru", day("2026-02-01"), None, True) in got
    assert (4, None, day("2025-01-01"), day("2026-02-01"), False) in got
    assert M.scd2_validate(out, "customer_id").isEmpty()
    again = M.scd2_apply(out, incoming, "customer_id", ["city"], "2026-02-01", order=["seq"])
    assert rows(again) == rows(out)


def test_quality_report(spark):
    df = spark.createDataFrame([(1, "Asha", 100), (1, "Asha", 100), (2, None, 200), (None, "x", 1)], "id int, name string, amount int")
    got = {r["metric"]: r["value"] for r in Q.quality_report(df, ["id"]).collect()}
    assert got == {"total_rows": 4, "duplicate_keys": 1, "null:id": 1, "null:name": 1, "null:amount": 0}


def test_violations(spark):
    df = spark.createDataFrame([(1, 1, 100.0), (2, 1, -10.0), (3, None, 50.0), (4, 9, None)], "row int, order_id int, amount double")
    rules = {"missing id": F.col("order_id").isNull(), "negative amount": F.coalesce("amount", F.lit(0.0)) < 0}
    assert rows(Q.violations(df, ["row"], rules)) == [(2, "negative amount"), (3, "missing id")]
    assert rows(Q.duplicates(df, ["order_id"])) == [(1, 2)]


def test_watermark_is_strict(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, ts int")
    assert rows(I.newer_than(df, "ts", F.lit(20))) == [(3, 30)]
    assert rows(I.next_watermark(df, "ts", F.lit(30))) == [(30, 0)]


def test_idempotent_batch(spark):
    batch = spark.createDataFrame([(1, 100), (1, 100), (2, 200), (3, None)], "id int, amount int")
    nothing = spark.createDataFrame([], "record_hash string")
    first = I.unseen(batch, ["id", "amount"], nothing)
    assert first.count() == 3
    assert I.unseen(batch, ["id", "amount"], first).isEmpty()


def test_config_steps(spark):
    df = spark.createDataFrame([(1, 50), (2, 500), (3, 1500)], "id int, amount int")
    out = run_steps(df, [{"step": "filter_min_amount", "column": "amount", "value": 100}, {"step": "add_tier", "column": "amount", "high": 1000}])
    assert rows(out, "id", "tier") == [(2, "LOW"), (3, "HIGH")]
    with pytest.raises(KeyError):
        run_steps(df, [{"step": "nope"}])


def test_schema_drift_and_compat(spark):
    s = lambda ddl: T._parse_datatype_string(ddl)
    expected, actual = s("id int, name string, amount double"), s("id string, name string, country string")
    assert schema_drift(expected, actual) == [("id", "type string, expected int"), ("amount", "missing"), ("country", "unexpected")]
    df = spark.createDataFrame([("1", "a", "IN"), ("x", "b", "US")], actual)
    assert ("id", "type string, expected int", 1) in rows(drift_report(df, expected))
    assert schema_compat(s("a int"), s("a bigint, b string"), "BACKWARD") == []
    assert schema_compat(s("a int"), s("a bigint, b string"), "FORWARD") == ["a: bigint does not fit int"]
    assert schema_compat(s("a int"), s("a int, b string not null"), "FULL") == ["b: required but not written"]
    with pytest.raises(ValueError):
        schema_compat(expected, actual, "SIDEWAYS")


def test_strings(spark):
    df = spark.createDataFrame([("willows@mill.test", "+44-7700900123"), ("ab@x.com", "12345"), ("nobody", "12345678901234")], "e string, p string")
    got = df.select(S.mask_email("e"), S.valid_phone("p"), S.email_domain("e")).collect()
    assert [tuple(r) for r in got] == [("w*****s@mill.test", True, "mill.test"), ("**@x.com", False, "x.com"), ("n****y@", False, "")]
    assert S.clean_name("  Customer Name-2 ") == "customer_name_2"


def test_date_range_and_tax(spark):
    assert [r["d"] for r in D.date_span(spark, "2026-01-01", "2026-01-05").collect()] == [day(f"2026-01-0{i}") for i in range(1, 6)]
    df = spark.createDataFrame([(100.0,), (250.0,)], "amount double")
    assert [tuple(r) for r in df.select(U.add_tax("amount"), U.with_tax("amount")).collect()] == [(118.0, 118.0), (295.0, 295.0)]


def test_flatten_and_maps(spark):
    schema = "id int, address struct<city: string, zip: string>, orders array<struct<order_id: int, amount: int>>"
    df = spark.createDataFrame([(1, ("Pune", "411001"), [(100, 50), (101, 70)]), (2, None, [])], schema)
    assert rows(J.flatten(df), "id", "address_city", "orders_order_id") == [(1, "Pune", 100), (1, "Pune", 101), (2, None, None)]
    m = spark.range(1).select(J.merged(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(9))).alias("m")).first()["m"]
    assert m == {"a": 1, "b": 9}


def test_lineage(spark):
    edges = spark.createDataFrame([("raw.orders", "silver.orders"), ("silver.orders", "gold.sales"), ("raw.customers", "silver.customers"), ("gold.sales", "raw.orders")], "source string, target string")
    assert rows(G.upstream(edges, "gold.sales")) == [("silver.orders",)]
    everything = G.upstream_all(edges).where("target = 'gold.sales'")
    assert rows(everything, "source", "distance") == [("gold.sales", 3), ("raw.orders", 2), ("silver.orders", 1)]


def test_hierarchy_ignores_cycles_no_root_reaches(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (8, 9, "x"), (9, 8, "y")], "id int, parent int, name string")
    assert rows(P.hierarchy(df, "id", "parent", "name"), "node", "level", "path") == [(1, 1, "a"), (2, 2, "a > b"), (3, 3, "a > b > c")]
    assert rows(P.total_reports(df, "id", "parent", "name")) == [(1, 2), (2, 1), (3, 0)]
    looped = df.unionByName(spark.createDataFrame([(1, 3, "a")], df.schema))  # node 1 again, below its own descendant
    with pytest.raises(ValueError):
        P.hierarchy(looped, "id", "parent", "name")


def test_gaps_of_each_key(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-04"), ("a", "2024-01-04"), ("b", "2024-01-02"), (None, "2024-02-01"), (None, "2024-02-03"), ("c", None)], "k string, at string").select("k", F.to_date("at").alias("at"))
    days = lambda *names: lambda r: tuple(str(r[n]) for n in names)
    gaps = sorted(map(days("k", "previous_day", "order_day", "gap_days"), P.day_gaps(df, "at", ["k"]).collect()))
    assert gaps == [("None", "2024-02-01", "2024-02-03", "2"), ("a", "2024-01-01", "2024-01-04", "3")]
    missing = sorted(map(days("k", "d"), P.missing_dates(df, "at", ["k"]).collect()))
    assert missing == [("None", "2024-02-02"), ("a", "2024-01-02"), ("a", "2024-01-03")]
    ranges = sorted(map(days("k", "range_start", "range_end", "days"), I.backfill_ranges(df, "at", df, "at", ["k"]).collect()))
    assert ranges == [("None", "2024-02-02", "2024-02-02", "1"), ("a", "2024-01-02", "2024-01-03", "2")]


def test_delete_duplicates_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "A@x"), (2, "a@x"), (3, None), (4, None)], "id int, email string")
    assert rows(M.delete_duplicates(df, F.lower("email"), "id"), "id") == [(1,), (3,), (4,)]


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "id int, v string")
    assert rows(M.change_feed(old, new, "id")) == [(2, "update_post", "c"), (2, "update_pre", "b"), (3, "delete", None), (4, "insert", "d")]


def test_readers(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("id,name,age\n1,Asha,30\n2,Ravi,abc\n3,Meera,25\n")
    schema = "id int, name string, age int"
    assert rows(R.read_csv_marked(spark, str(bad), schema)) == [(1, "Asha", 30, None), (2, "Ravi", None, "2,Ravi,abc"), (3, "Meera", 25, None)]
    assert R.read_csv_marked(spark, str(bad), schema, "DROPMALFORMED").count() <= 3
    with pytest.raises((PySparkException, Py4JJavaError)):
        R.read_csv_marked(spark, str(bad), schema, "FAILFAST").collect()
    array = tmp_path / "array.json"
    array.write_text('[{"id": 1, "type": "a"},\n {"id": 2, "type": "b"}]')
    assert rows(R.read_json(spark, str(array), "id int, type string", array_files=True)) == [(1, "a"), (2, "b")]
    options = R.jdbc_options("jdbc:x", "SELECT 1", "d", "id", 0, 100, 4)
    assert options["dbtable"] == "(SELECT 1) q" and options["numPartitions"] == "4"


@pytest.mark.parametrize("pages", [[], [1], [2, 5], [1, 2, 3, 40, 41, 100]])
def test_pages_with_holes(tmp_path, pages):
    for n in [*pages, 7]:  # page 7 has no rows
        (tmp_path / f"page={n}").mkdir()
        (tmp_path / f"page={n}" / "rows.json").write_text("" if n == 7 else f'{{"n": {n}}}\n')
    reader = PagedReader(f"file://{tmp_path}", 2, ["n"])
    assert [row for part in reader.partitions() for row in reader.read(part)] == [(n,) for n in pages]


def test_variant_is_stable(spark):
    df = spark.range(1000).select("id", variant_of("id", 30).alias("v"))
    assert df.collect() == df.collect()
    assert 600 < df.where("v = 1").count() < 800
