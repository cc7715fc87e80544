"""Busy keys, joins against brute force, and what the plans look like."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewater.operators import joins as J
from tidewater.operators import patterns as P
from tidewater.operators import skew as K
from tidewater.operators import vectors as V
from tidewater.operators.control import plan_text
from tidewater.operators.sketches import paged_arrays
from tidewater.operators.text import similar_names
from tidewater.plans import QUERIES


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to key 1."""
    rng = random.Random(5)
    data = [(i, 1 if i % 3 == 0 else rng.randrange(2, 30)) for i in range(600)]
    return data, spark.createDataFrame(data, "id long, k long").repartition(4)


def test_salted_and_split_joins_equal_the_plain_join(spark, skewed):
    data, big = skewed
    small = spark.createDataFrame([(k, f"n{k}") for k in range(1, 25)], "k long, name string")
    want = sorted((k, i, f"n{k}") for i, k in data if k < 25)
    assert rows(K.salted_join(big, small, ["k"], F.col("id"), hot_rows=50), "k", "id", "name") == want
    assert rows(K.split_hot_join(big, small, "k", hot_rows=50), "k", "id", "name") == want
    assert rows(K.split_hot_join(big, small, "k", hot_rows=50, max_rows=0), "k", "id", "name") == want
    assert rows(K.lookup_join(big, small, "k", max_rows=5), "k", "id", "name") == want
    left = rows(K.salted_join(big, small, ["k"], F.col("id"), how="left", hot_rows=50), "id")
    assert left == [(i,) for i in range(600)]


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_pairs_within(skewed, hot_rows):
    data, df = skewed
    got = {tuple(r) for r in K.pairs_within(df, ["k"], "id", hot_rows=hot_rows).select("a", "b").collect()}
    groups = {}
    for i, k in data:
        groups.setdefault(k, []).append(i)
    want = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    assert got == want


def test_bounded_cross(spark):
    a, b = spark.range(5), spark.createDataFrame([(1, "x"), (2, "y")], "n int, s string")
    assert K.bounded_cross(a, b).count() == K.bounded_cross(a, b, max_rows=1).count() == 10


def test_overlapping_against_brute_force(spark):
    rng = random.Random(1)
    data = [(i, 1 if i % 3 == 0 else rng.randrange(2, 6), s, s + rng.choice([0, 1, 5, 200])) for i in range(150) for s in [rng.randrange(0, 400)]]
    df = spark.createDataFrame(data, "id long, k long, s int, e int").select("id", "k", F.date_add(F.lit("2020-01-01"), F.col("s")).alias("s"), F.date_add(F.lit("2020-01-01"), F.col("e")).alias("e"))
    want = sorted((a[1], a[0], b[0]) for a in data for b in data if a[1] == b[1] and a[0] < b[0] and a[2] <= b[3] and b[2] <= a[3])
    assert rows(J.overlapping(df, ["k"], "id", "s", "e"), "k", "a", "b") == want


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_asof_against_brute_force(spark, hot_rows):
    rng = random.Random(2)
    left = [(i, 1 if i % 3 == 0 else rng.randrange(2, 9), rng.randrange(0, 300)) for i in range(120)]
    right = [(i, 1 if i % 3 == 0 else rng.randrange(2, 9), rng.randrange(0, 300)) for i in range(150)]
    l, r = spark.createDataFrame(left, "id long, k long, t long"), spark.createDataFrame(right, "rid long, k long, t long")
    got = {x["id"]: x["rid"] for x in J.asof_join(l, r, ["k"], F.col("t"), F.col("t"), "rid", ["rid"], tolerance=40, hot_rows=hot_rows).collect()}
    for i, k, t in left:
        before = [(rt, rid) for rid, rk, rt in right if rk == k and rt <= t]
        best = max(before) if before else None
        assert got[i] == (best[1] if best and t - best[0] <= 40 else None)


def test_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    listed = lambda *v: spark.createDataFrame([(i,) for i in v], "y int")
    assert rows(J.not_in(df, "x", listed(1), "y")) == [(2,)]
    assert rows(J.not_in(df, "x", listed(1, None), "y")) == []
    assert J.not_in(df, "x", listed(), "y").count() == 3


def test_basket_pairs_prunes_without_changing_the_answer(spark):
    rng = random.Random(4)
    data = {(b, min(int(rng.expovariate(0.15)), 60)) for b in range(200) for _ in range(8)} | {(999, i) for i in range(60)}
    df = spark.createDataFrame(list(data), "b long, i long")
    count = {}
    for b in {x[0] for x in data}:
        items = sorted(i for x, i in data if x == b)
        for n, a in enumerate(items):
            for c in items[n + 1 :]:
                count[a, c] = count.get((a, c), 0) + 1
    want = sorted(((a, b, n) for (a, b), n in count.items()), key=lambda r: (-r[2], r[0], r[1]))[:10]
    got = J.basket_pairs(df, "b", "i", 10, seed_items=6).collect()
    assert [tuple(r) for r in got] == want


def test_funnel_and_sequence_against_brute_force(spark):
    rng = random.Random(9)
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    data = [(i, 1 if i % 3 == 0 else rng.randrange(2, 6), start + dt.timedelta(seconds=rng.randrange(0, 4000)), rng.choice("abc")) for i in range(150)]
    df = spark.createDataFrame(data, "id long, u long, ts timestamp_ntz, e string")
    steps = [F.col("e") == x for x in "abc"]
    for hot_rows in (15, 10_000):
        level = {r["u"]: r["level"] for r in P.window_funnel(df, "u", "ts", "id", steps, 300, hot_rows=hot_rows).collect()}
        runs = {r["u"]: r["matches"] for r in P.sequence_match(df, "u", "ts", "id", steps, hot_rows=hot_rows).collect()}
        for u in {r[1] for r in data}:
            mine = sorted((r[2], r[0], r[3]) for r in data if r[1] == u)
            best = 0
            for i, (t0, _, e) in enumerate(mine):
                if e == "a":
                    depth = 1
                    for t, _, x in mine[i + 1 :]:
                        if depth < 3 and x == "abc"[depth] and (t - t0).total_seconds() <= 300:
                            depth += 1
                    best = max(best, depth)
            assert level[u] == best
            text = "".join(e for _, _, e in mine)
            assert runs.get(u, 0) == sum(text.startswith("abc", i) for i in range(len(text)))


def test_merge_intervals_and_paged_arrays(spark):
    df = spark.createDataFrame([(1, "k", 1, 5), (2, "k", 2, 3), (3, "k", 5, 9), (4, "k", 11, 12)], "id int, k string, s int, e int")
    for hot_rows in (2, 100):
        assert rows(P.merge_intervals(df, ["k"], "s", "e", "id", hot_rows=hot_rows), "s", "e", "merged") == [(1, 9, 3), (11, 12, 1)]
    pages = rows(paged_arrays(df, ["k"], ["s"], "id", page=3, hot_rows=2), "page", "items")
    assert [(p, list(i)) for p, i in pages] == [(0, [1, 2, 3]), (1, [4])]


def test_missing_numbers_over_a_wide_gap(spark):
    df = spark.createDataFrame([(1,), (3,), (30_003,)], "k long")
    got = P.missing_numbers(df, "k")
    assert got.count() == 30_000 and got.agg(F.min("missing"), F.max("missing")).first()[:] == (2, 30_002)


def test_similar_names_finds_every_pair(spark):
    rng = random.Random(8)
    names = sorted({"".join(rng.choice("abc ") for _ in range(rng.randrange(3, 9))).strip() or "a" for _ in range(60)})

    def grams(s):
        p = f"  {s} "
        return {p[i : i + 3] for i in range(len(p) - 2)}

    want = sorted((a, b) for a in names for b in names if a < b and len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= 0.5)
    assert rows(similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n", 0.5), "a", "b") == want


def test_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)
    queries = {7: x[0] + 0.05, 8: x[1]}
    sims = (x @ np.array(list(queries.values())).T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(list(queries.values()), axis=1)[None])
    got = rows(V.knn(df, "id", "v", queries, 5), "query", "rank", "id")
    want = [(q, r + 1, int(i)) for j, q in enumerate(queries) for r, i in enumerate(np.argsort(-sims[:, j])[:5])]
    assert got == want
    near = V.knn_lsh(df, "id", "v", queries, 1, bands=20, bits=3)
    assert rows(near, "query", "id") == [(7, 0), (8, 1)]
    with pytest.raises(ValueError):
        V.query_frame(df, {i: [0.0] for i in range(V.MAX_QUERIES + 1)})


# ---- plans ----

def plan(spark, sf_dir, name):
    return plan_text(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["filter_date_from", "filter_between"])
def test_date_filters_reach_the_scan(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(spark, sf_dir, "top_k_frequent")
    assert "ReadSchema: struct<l_partkey:bigint>" in text


@pytest.mark.parametrize("name", ["win_running_count", "win_ntile", "win_cume_dist", "win_running_total", "sessionize"])
def test_row_windows_never_share_one_partition(spark, sf_dir, name):
    import re

    text = plan(spark, sf_dir, name)
    # only tables of slice totals may be gathered; the rows themselves are partitioned
    for window in re.findall(r"Window\n(?:.*\n)*?Arguments: (.*)", text):
        if "windowspecdefinition(__slice" in window.replace("#", " ") or "__t_" in window:
            continue
        assert "], [], " not in window


def test_top_queries_do_not_sort_everything(spark, sf_dir):
    for name in ("top5_customers", "top_k_frequent", "keyset_page"):
        assert "TakeOrderedAndProject" in plan(spark, sf_dir, name)


def test_no_query_collects_or_crosses(spark, sf_dir):
    for name in ("join_asof", "join_interval_overlap", "join_cross", "basket_pairs", "knn_exact", "window_funnel"):
        text = plan(spark, sf_dir, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


# ---- the plain and the split path give the same rows ----

def test_ranks_do_not_depend_on_the_limit(spark):
    import math

    from tidewater.operators.ranking import numbered, ranked

    values = [None, float("nan"), math.inf, -math.inf, 0.0, 1.5, 1.5, -2.0] + [float(i % 37) for i in range(150)] + [None] * 40
    df = spark.createDataFrame([(i, i % 2, v) for i, v in enumerate(values)], "id int, k int, v double")
    kinds = {"r": "rank", "d": "dense_rank", "p": "percent_rank", "c": "cume_dist"}
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    for down in (True, False):
        want = None
        for limit in (7, 10**9):
            got = {r.id: tuple(r) for r in ranked(df, ["k"], "v", kinds, down, hot_rows=limit).select("id", *kinds).collect()}
            assert want is None or want == got
            want = got
        order = F.desc("v") if down else F.asc("v")
        plain = {r.id: (r.r, r.n) for r in df.select("id", F.rank().over(Window.orderBy(order)).alias("r"), F.row_number().over(Window.orderBy(order, "id")).alias("n")).collect()}
        for limit in (7, 10**9):
            ranks = {r.id: r.r for r in ranked(df, [], "v", {"r": "rank"}, down, hot_rows=limit).collect()}
            places = {r.id: r.n for r in numbered(df, "v", "id", "n", down, hot_rows=limit).collect()}
            assert {i: (ranks[i], places[i]) for i in plain} == plain


def test_crowded_frame_of_nulls_has_no_sum(spark):
    from pyspark.sql import functions as F

    from tidewater.operators.ordered import range_frame

    df = spark.createDataFrame([(i, 1, i, None if i < 30 else float(i)) for i in range(80)], "id int, k int, at int, v double")
    frames = [{r.id: (r.s, r.n) for r in range_frame(df, ["k"], F.col("at"), 5, {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))}, hot_rows=c).collect()} for c in (20, 10**6)]
    assert frames[0] == frames[1] and frames[0][10] == (None, 0)


# ---- no row gets lost ----

def test_rows_with_nulls_stay(spark):
    from pyspark.sql import functions as F

    from tidewater.operators import joins, merge

    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame([(1, "c", None, 1), (3, "d", None, 1)], "id int, v string, op string, seq int")
    assert sorted(map(tuple, merge.cdc_merge(target, changes, "id", "op", ["seq"]).collect())) == [(1, "c"), (2, "b"), (3, "d")]
    assert sorted(map(tuple, merge.merge_upsert(target, changes, "id", "op", ["seq"]).collect())) == [(1, "a"), (2, "b")]
    assert merge.latest_state(changes, "id", "op", ["seq"]).count() == 2
    dated = spark.createDataFrame([("x", None, 1.0), ("x", "2024-01-01", 2.0)], "k string, d string, v double").withColumn("d", F.to_date("d"))
    assert merge.retention(dated, "d", F.lit("2023-01-01").cast("date"), ["k"], "v").count() == 2
    spans = spark.createDataFrame([(1, 1, "2024-01-01", None), (1, 2, "2024-03-01", "2024-03-05"), (1, 3, "2023-01-01", "2023-02-01")], "k int, i int, s string, e string")
    spans = spans.withColumns({"s": F.to_date("s"), "e": F.to_date("e")})
    assert [tuple(r) for r in joins.overlapping(spans, ["k"], "i", "s", "e").collect()] == [(1, 1, 2)]
    signed = spark.createDataFrame([("k", 1, 1, "old"), ("k", 2, 1, "new"), ("k", 2, -1, "cancel")], "key string, ver int, sign int, v string")
    assert [tuple(r) for r in merge.collapse_sign(signed, ["key"], "sign", ["ver"], ["v"]).collect()] == [("k", "old")]
