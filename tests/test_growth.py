"""What keeps tasks small as tables grow: seen in the plans and counts of small tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import dates
from tidewater.operators import incremental, joins, parity
from tidewater.operators.control import plan_text
from tidewater.session import by_rows


def test_missing_ranges_make_no_day_that_is_present(spark):
    d = lambda m, n: dt.date(2024, m, n)
    due = spark.createDataFrame([("a", d(1, 1)), ("a", d(12, 31)), (None, d(3, 1)), (None, d(3, 4)), ("b", d(5, 5)), ("c", None), ("d", d(6, 1)), ("d", d(6, 3))], "k string, at date")
    done = spark.createDataFrame([("a", d(1, 1)), ("a", d(12, 31)), ("a", d(2, 10)), ("a", d(2, 10)), ("b", d(5, 4)), ("b", None), ("z", d(1, 1)), ("d", d(5, 20)), ("d", d(6, 2)), ("d", d(7, 1))], "k string, at date")
    got = incremental.backfill_ranges(due, "at", done, "at", ["k"])
    assert {tuple(r) for r in got.collect()} == {
        ("a", d(1, 2), d(2, 9), 39), ("a", d(2, 11), d(12, 30), 324), (None, d(3, 1), d(3, 4), 4), ("b", d(5, 5), d(5, 5), 1),
        ("d", d(6, 1), d(6, 1), 1), ("d", d(6, 3), d(6, 3), 1)}
    assert dict(got.dtypes) == {"k": "string", "range_start": "date", "range_end": "date", "days": "bigint"}
    assert "interval" not in plan_text(got, "simple").lower()  # no calendar
    days = dates.days_without(due, "at", done, "at", ["k"])
    assert days.count() == 39 + 324 + 4 + 1 + 2
    whole = incremental.backfill_ranges(due, "at", done, "at")
    assert {tuple(r) for r in whole.where("range_start < '2024-05-01'").collect()} == {(d(1, 2), d(2, 9), 39), (d(2, 11), d(5, 3), 83)}


def test_parts_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert by_rows(spark, 0) == cores
    assert by_rows(spark, 1000 * cores, 10) == 100 * cores


def test_rows_meet_before_they_are_counted(spark):
    """A task's groups are those of its part: rows are dealt by key in one exchange and counted after it."""
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    other = rows.where("k % 10 <> 3").withColumn("v", F.when(F.col("k") % 50 == 0, F.col("v") + 1).otherwise(F.col("v")))
    got = parity.differing_keys(rows, other, ["k"], ["v"])
    assert {r["k"]: r["status"] for r in got.collect()} == {**{k: "only_left" for k in range(3, 2000, 10)}, **{k: "differs" for k in range(0, 2000, 50)}}
    assert "REPARTITION_BY_NUM" in plan_text(got, "simple")


def test_groups_go_to_the_rows(spark, sf_dir):
    from tidewater.plans import QUERIES

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES["approx_percentile"](spark, sf_dir)
        assert "SortMergeJoin" not in plan_text(got, "simple")
        assert all(r["median_close"] and r["p95_close"] for r in got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_pairs_are_dealt_before_they_are_counted(spark):
    lines = spark.createDataFrame([(b, i) for b in range(30) for i in (b % 3, 10 + b % 2, 10 + b % 2, 99)] + [(None, 1), (1, None)], "b int, i int")
    got = joins.basket_pairs(lines, "b", "i", 3, seed_items=2)
    assert [tuple(r) for r in got.collect()] == [(10, 99, 15), (11, 99, 15), (0, 99, 10)]
    assert "REPARTITION_BY_NUM" in plan_text(got, "simple")


def test_compaction_shuffles_no_row(spark, tmp_path, monkeypatch):
    from tidewater.sources import sinks

    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000).repartition(9).write.parquet(source)

    def refused(*_):
        raise AssertionError("rows are shuffled")

    monkeypatch.setattr(type(spark.range(1)), "repartition", refused)
    sinks.compact(spark, source, target)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == list(range(1000))
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1


def test_state_is_written_once_a_batch():
    from collections import Counter

    import pandas as pd

    from tidewater.streaming.processors import Sessions

    calls = Counter()

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            calls["value"] += 1
            self.held = v

    class Map(dict):
        containsKey, getValue = dict.__contains__, dict.__getitem__

        def updateValue(self, k, v):
            calls["map"] += 1
            self[k] = v

    class Handle:
        def deleteTimer(self, at):
            calls["timer"] += 1

        registerTimer = deleteTimer

    p = Sessions("k", "at", "kind", 1000)
    p.handle, p.open, p.kinds = Handle(), Value(), Map()
    frame = lambda ms, kinds: pd.DataFrame({"at": pd.to_datetime(ms, unit="ms"), "kind": kinds})
    assert list(p.handleInputRows(("u",), iter([frame(range(500), ["a", "b"] * 250)]), None)) == []
    assert (calls["value"], calls["map"], calls["timer"]) == (1, 2, 1) and p.open.held == (0, 499_000, 500)
    first, = p.handleInputRows(("u",), iter([frame([600, 5000], [None, "a"]), frame([9000], ["a"])]), None)
    assert first[["events", "kinds"]].values.tolist() == [[501, 3], [1, 1]]
    assert p.open.held == (9_000_000, 9_000_000, 1) and dict(p.kinds) == {("a",): (1,)}


def test_words_are_packed_before_the_shuffle(spark, monkeypatch, tmp_path):
    from tidewater.operators import search_index

    rows = [(1, "a b a c " * 300), (2, None), (3, ""), (4, "b b"), (4, "b b"), (4, "a"), (None, "a"), (5, "z Ab ab")]
    dealt = []
    plain = type(spark.range(1)).repartition

    def noted(df, *by):
        if by == ("bucket", "cell"):
            dealt.append(df.count())
        return plain(df, *by)

    monkeypatch.setattr(type(spark.range(1)), "repartition", noted)
    index = search_index.build_index(spark.createDataFrame(rows, "id int, body string"), "id", "body", str(tmp_path / "i"))
    assert dealt and dealt[0] <= 3 + 1 + 1 + 1 + 2  # a document's words, not 1208
    got = {(r["term"], r["doc"], r["n_words"], r["tf"], tuple(r["positions"])) for r in index.postings(["a", "b", "ab"]).collect() if r["doc"] != 1}
    assert got == {("b", 4, 2, 4, (0, 0, 1, 1)), ("a", 4, 1, 1, (0,)), ("ab", 5, 3, 2, (1, 2))}
    long = {r["term"]: r["positions"] for r in index.postings(["a", "b", "c"]).where("doc = 1").collect()}
    assert long["b"] == list(range(1, 1200, 4)) and long["a"] == sorted([*range(0, 1200, 4), *range(2, 1200, 4)])
    assert (index.n_docs, index.n_words) == (7, 1208)


def test_records_of_one_template_are_not_compared_in_pairs(spark, monkeypatch):
    from tidewater.operators import near_duplicates

    compared = []
    plain = near_duplicates._similar

    def noted(pairs, sets, threshold):
        compared.append(pairs.count())
        return plain(pairs, sets, threshold)

    monkeypatch.setattr(near_duplicates, "_similar", noted)
    names = spark.range(400).select("id", F.format_string("automobile 15 %07d", F.col("id") * 7919).alias("name"))
    names = names.unionByName(names.where("id = 9").select(F.lit(900).cast("bigint").alias("id"), F.concat(F.expr("left(name, 20)"), F.lit("x")).alias("name")))
    sets = {r["id"]: {f"  {r['name']} "[i : i + 3] for i in range(len(r["name"]) + 1)} for r in names.collect()}
    want = {i: i for i in sorted(sets)}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and want[a] != want[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((want[a], want[b]))
                want = {k: low if v == high else v for k, v in want.items()}
    groups = {r["id"]: r["group_id"] for r in near_duplicates.near_duplicate_groups(names, "id", F.col("name")).collect()}
    assert groups == want and want[900] == 9
    assert sum(compared) < 2000  # of 80 000 pairs
